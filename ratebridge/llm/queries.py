"""Registered queries of the training-data operators: thin digests over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebridge.llm import oracle
from ratebridge.llm.decontamination import decontaminate
from ratebridge.llm.divergence_rules import divergence_rules
from ratebridge.llm.hard_negatives import mine_hard_negatives
from ratebridge.llm.harmonic_packing import harmonic_packing
from ratebridge.llm.language_id import crc_fold, fit_languages, identify_languages
from ratebridge.llm.line_dedup import remove_aligned_lines
from ratebridge.llm.ngram_join import similar_components
from ratebridge.llm.secret_scan import BASE, count_of, fit_markov, joined_spans, ordinary_samples, random_samples, secret_spans
from ratebridge.llm.source_mixing import mix_sources, words_taken
from ratebridge.llm.substring_dedup import remove_repeats
from ratebridge.llm.token_counts import prefix_token_table
from ratebridge.llm.topk_search import segment_topk
from ratebridge.llm.whitening import whiten
from ratebridge.llm.workers import WORD_PATTERN

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = divergence_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op2_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = harmonic_packing(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_fold("doc_id", 4) == 2, F.lit(False))
    model = fit_languages(docs.filter(~held_out))
    return identify_languages(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ordinary = ordinary_samples(docs, max_docs=2000, id_col="doc_id", text_col="text", least=8)
    ratios = fit_markov(random_samples(spark, 3000).unionByName(ordinary))
    found = secret_spans(docs, ratios)
    counts = [count_of(F.col("base"), number).alias(f"n_{kind}") for number, (kind, *_) in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"))


def word_count(text: str):
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0))


@query
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = words_taken(*mix_sources(table(spark, sf_dir, "documents"), word_count("text")))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_aligned_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op9_segment_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = segment_topk(vectors, is_query=F.col("vec_id") % 100 == 0, k=10, scale=1024.0)
    return found.select("query_id", "rank", "vec_id", "score")


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = prefix_token_table(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whiten(table(spark, sf_dir, "embeddings"), scale=64.0, shift=1_000_000, top=16)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "of")
    each = white.select("vec_id", "n", "deviation", "identity_error", each)
    component = (F.col("place") + 1).alias("component")
    return each.select("vec_id", component, "n", "deviation", "of.whitened", "of.explained", "identity_error")


@query
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), length=10)
    ids = F.array_join(F.array_sort("items"), ",")
    n_items = F.size("items").cast("long").alias("n_items")
    return found.select("doc_id", "n_words", "n_hit", n_items, F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label, scale=256.0)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
