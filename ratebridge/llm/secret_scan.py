"""Secret scans: base patterns, and character Markov models for strings no pattern names.

Two first-order models over one alphabet, one of random strings and one of
ordinary identifiers, are trained from labelled samples. A candidate, a run of
token characters outside the base spans, is a secret if the mean log-likelihood
ratio of its transitions is above a bound.

All of it is column expressions. The models are one table of
``len(ALPHABET) ** 2`` numbers; training counts transitions in Spark and brings
at most two counts for each pair of characters to the driver.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebridge.llm.native import let, occurrences, total

#: Base kinds in order: (kind, pattern, group of the secret, least length of that group); fixed patterns.
#: A run pattern with its least length inside finds the same spans as without, as a run is taken whole.
BASE = (
    ("assign", "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", "AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
)
#: Kinds by number; the last is that of the spans the models add.
KINDS = (*[kind for kind, *_ in BASE], "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-"
#: Characters of the alphabet inside a pattern's class.
TOKEN_CLASS = "[A-Za-z0-9+/_=.-]"


NO_SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


def spans_of(text: Column, number: int) -> Column:
    """Spans of one base kind."""
    _, pattern, group, least = BASE[number]
    kept = F.filter(occurrences(text, pattern, group), lambda m: F.length(m["part"]) >= least)
    rows = F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end")))
    return F.when(text.rlike(pattern), rows).otherwise(F.array().cast(NO_SPANS))


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end) of the base rules, by start, then kind."""
    return F.sort_array(F.concat(*[spans_of(text, number) for number in range(len(BASE))]))


def count_of(spans: Column, number: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")


def transitions(samples: DataFrame) -> DataFrame:
    """Counts of (label, pair): neighbouring characters of the samples (string, label), both in the alphabet."""
    place = F.explode(F.sequence(F.lit(1), F.length("string") - 1))
    pairs = samples.filter(F.length("string") > 1).select("label", F.col("string"), place.alias("i"))
    pairs = pairs.select("label", F.col("string").substr(F.col("i"), F.lit(2)).alias("pair"))
    return pairs.filter(F.col("pair").rlike(f"^{TOKEN_CLASS}{{2}}$")).groupBy("label", "pair").agg(F.count("*").alias("n"))


def fit_markov(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios of all pairs (first character * alphabet + second).

    A pair's probability is smoothed with that of its second character alone.
    ``samples``: string, label (1 random, 0 ordinary; rows with null are left out).
    Without samples of a kind its model is even.
    """
    rows = transitions(samples.filter("string IS NOT NULL AND label IN (0, 1)")).collect()  # at most 2 * alphabet^2
    size = len(ALPHABET)
    counts = [[[0] * size for _ in range(size)] for _ in range(2)]
    for r in rows:
        counts[r["label"]][ALPHABET.index(r["pair"][0])][ALPHABET.index(r["pair"][1])] += r["n"]
    models = []
    for table in counts:
        after = [1 + sum(row[b] for row in table) for b in range(size)]  # single characters, one added to each
        shares = [n / sum(after) for n in after]
        models.append([(row[b] + size * shares[b]) / (sum(row) + size) for row in table for b in range(size)])
    return [math.log(x) - math.log(y) for x, y in zip(models[1], models[0], strict=True)]


def random_samples(spark: SparkSession, n: int) -> DataFrame:
    """Strings that are random by construction, labelled 1: digests in base 64, hexadecimal and upper case."""
    digest = F.unhex(F.sha2(F.concat(F.lit("sample "), F.col("id").cast("string")), 256))
    hexadecimal = F.lower(F.hex(digest))
    base_64 = F.regexp_replace(F.base64(digest), "[\r\n]", "")
    upper = F.upper(F.regexp_replace(base_64, "[^A-Za-z0-9]", ""))
    one = F.element_at(F.array(base_64, hexadecimal, upper), (F.col("id") % 3 + 1).cast("int"))
    return spark.range(n).select(one.alias("string"), F.lit(1).alias("label"))


def ordinary_samples(docs: DataFrame, max_docs: int, id_col: str, text_col: str, least: int) -> DataFrame:
    """Identifier-like words outside the base spans, labelled 0, from at most ``max_docs`` documents.

    They are the documents whose ids have the smallest digests.
    """
    order = F.md5(F.col("_id").cast("string"))
    ids = docs.select(docs[id_col].alias("_id")).filter("_id IS NOT NULL").select(order.alias("order")).distinct().orderBy("order").limit(max_docs)
    last = ids.agg(F.max("order")).first()[0]
    chosen = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("text")).filter(order <= F.lit(last or ""))
    text = F.coalesce(F.col("text"), F.lit(""))
    for _, pattern, _, _ in BASE:
        text = F.regexp_replace(text, pattern, " ")
    words = F.regexp_extract_all(text, F.lit(f"[A-Za-z_][A-Za-z0-9_]{{{least - 1},}}"), F.lit(0))
    return chosen.select(F.explode(words).alias("string"), F.lit(0).alias("label"))


def mean_ratio(string: Column, ratios: Column) -> Column:
    """Mean log-likelihood ratio of the string's transitions."""
    number = lambda i: F.instr(F.lit(ALPHABET), F.substring(string, i, F.lit(1)))
    pair = lambda i: F.get(ratios, (number(i) - 1) * len(ALPHABET) + number(i + 1) - 1)
    return total(F.transform(F.sequence(F.lit(1), F.length(string) - 1), pair), "double") / (F.length(string) - 1)


def secret_spans(
    docs: DataFrame,
    ratios: list[float],
    min_length: int = 20,
    min_mean_ratio: float = 2.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, base, spans: arrays of (start, kind, end), the kind as its place in KINDS.

    Both by start, then kind; offsets in code points, end exclusive. ``spans``
    holds the base spans and those the models add, which overlap none of them. A
    null or empty text has no spans; null ids stay null; repeated rows give
    repeated rows; an empty table gives no rows; other columns are not read.
    """
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    pattern = f"{TOKEN_CLASS}{{{min_length},}}"
    long_runs = F.when(F.col("text").rlike(pattern), occurrences(F.col("text"), pattern)).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,part:string>>"))
    rows = rows.select("doc_id", "base", long_runs.alias("runs"))
    apart = F.filter("runs", lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    rows = rows.withColumn("runs", F.filter(apart, lambda r: let(r["part"], lambda p: mean_ratio(p, table) >= min_mean_ratio)))
    added = F.transform("runs", lambda r: F.struct(r["start"].alias("start"), F.lit(len(BASE)).alias("kind"), r["end"].alias("end")))
    return rows.select("doc_id", "base", F.sort_array(F.concat("base", added)).alias("spans"))


def joined_spans(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
