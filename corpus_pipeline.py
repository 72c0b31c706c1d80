"""A corpus pipeline: raw documents to packed sequences, each stage one operator of ``ratebridge.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratebridge.llm.harmonic_packing import harmonic_packing
from ratebridge.llm.language_id import fit_languages, identify_languages
from ratebridge.llm.line_dedup import has_words, remove_aligned_lines
from ratebridge.llm.native import words_of
from ratebridge.llm.ngram_join import similar_components
from ratebridge.llm.queries import tokenizer_path, word_count
from ratebridge.llm.source_mixing import mix_sources
from ratebridge.session import ensure_checkpoint_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: SQL cannot express k-means, patience diff or a tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near some language; those the model rejects go. A null language takes the one found.

    A null text, or one without a letter, is rejected. Repeated rows stay repeated; an empty table gives none.
    """
    found = identify_languages(docs, fit_languages(docs), keep=COLUMNS[1:])
    return found.filter(~F.col("rejected")).withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without blocks of lines that an earlier one has; those left without a word by that go.

    Documents that lose nothing stay as they are, null and empty texts too. A repeated row counts as a later
    document of the same id. An empty table gives none.
    """
    cut = remove_aligned_lines(docs, keep=("lang", "source", "n_chars"))
    cut = cut.filter((F.col("n_removed") == 0) | has_words(F.col("kept_text")))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).withColumnRenamed("kept_text", "text").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; rows without an id stay.

    Of rows with one id and one text the first stays, by source, language and length; an
    id that stands for several texts keeps one row of each. Null and empty texts are in
    no group, so they stay. An empty table gives none.
    """
    groups = similar_components(docs).filter("doc_id = component_id").select("doc_id").distinct()
    rows = docs.select(*COLUMNS)
    kept = rows.join(groups, "doc_id", "left_semi")
    first = Window.partitionBy("doc_id", "text").orderBy("source", "lang", "n_chars")
    kept = kept.withColumn("_row", F.row_number().over(first)).filter("_row = 1").drop("_row")
    return kept.unionByName(rows.filter("doc_id IS NULL")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document once for each epoch that takes it, cut to the words taken where the mix ends in it.

    Documents without a word, null texts among them, are in no mix. Repeated rows take part one by one; a null
    source is a source of its own. An empty table gives none.
    """
    size = word_count("text").cast("long")
    _, sources, taken = mix_sources(docs, size)
    parts = taken.groupBy("place", "doc_id", "size", "copy", "epoch").agg(F.sum("n_words").alias("words"))
    parts = parts.join(sources.select("place", "source"), "place").drop("place", "epoch")
    parts = parts.select(*[F.col(c).alias(f"_{c}") for c in parts.columns])
    alike = Window.partitionBy("doc_id", "source", "size").orderBy("text", "lang", "n_chars")
    rows = docs.select(*COLUMNS, size.alias("size")).withColumn("copy", F.row_number().over(alike))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("doc_id", "source", "size", "copy")]
    mixed = rows.join(parts, same[0] & same[1] & same[2] & same[3])
    cut = F.col("_words") < F.col("size")
    text = F.when(cut, F.array_join(F.slice(words_of(F.col("text")), F.lit(1), F.col("_words").cast("int")), " ")).otherwise(F.col("text"))
    n_chars = F.when(cut, F.length(text).cast("long")).otherwise(F.col("n_chars"))
    return mixed.withColumn("n_chars", n_chars).withColumn("text", text).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with their token ids.

    A null or empty text is a document of the end id alone; repeated rows are packed as often as they stand. An
    empty table gives no piece.
    """
    return harmonic_packing(docs, tokenizer_path("byte_bpe_50k.json"), end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify),
    ("line_dedup", dedup_lines),
    ("ngram_join", one_of_each_group),
    ("source_mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; tables between stages lie in the session's shared folder."""
    shared = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs.write.parquet(f"{shared}/{number}-{name}")
            docs = spark.read.parquet(f"{shared}/{number}-{name}")
    return docs
