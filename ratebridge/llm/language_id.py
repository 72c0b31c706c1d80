"""Language identification: nearest of several clustered centroids per language.

A text is a vector of hashed character 1- to 3-grams of its letters, with
sublinear term frequency and inverse document frequency, of length one. Each
language keeps a few centroids, found by spherical k-means on a bounded sample
of its labelled rows; a text gets the language of the centroid with the largest
cosine, and is rejected if that cosine is below the language's bound. The bound
is a share of a low quantile of the cosines that rows of the sample have to
centroids of other rows of their language.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratebridge.llm.tables import small_batches, written
from ratebridge.llm.workers import per_worker

#: The language of a text without letters.
UNDETERMINED = "und"
#: Characters whose n-grams are counted at a time.
SLICE = 1 << 20
#: Odd multipliers of the n-gram hash (fixed values).
MIX = (2654435761, 2246822519, 3266489917)


@dataclass(frozen=True)
class LanguageModel:
    """``languages[owner[i]]`` is the language of centroid i; ``idf`` weighs the features; a text
    with a cosine below ``bounds[owner[i]]`` is not of that language."""

    languages: tuple[str, ...]
    owner: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    bounds: np.ndarray


def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str, bits: int) -> np.ndarray | None:
    """Counts of hashed n-grams of the letters, other runs as one blank; None without a letter."""
    is_letter = per_worker("letters", letter_table)
    counts, seen = np.zeros(1 << bits, np.float32), False
    for at in range(0, len(text), SLICE):
        part = text[max(at - 2, 0):at + SLICE].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = is_letter[codes]
        if not letters.any():
            continue
        seen = True
        codes = np.where(letters, codes, np.uint32(32))
        codes = codes[letters | np.concatenate([[True], letters[:-1]])]  # one blank for a run
        codes = np.concatenate([[32], codes, [32]]).astype(np.uint32)
        shift = np.uint32(32 - bits)
        hashed = codes * np.uint32(MIX[0])
        for n in range(3):
            if n:
                hashed = (hashed[:-1] ^ (codes[n:] * np.uint32(MIX[n]))) * np.uint32(MIX[0])
            counts += np.bincount(hashed >> shift, minlength=1 << bits)
    return counts if seen else None


def unit_rows(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def packed(counts: np.ndarray) -> bytes:
    """Counts in a fraction of their bytes, as most are zero."""
    return zlib.compress(counts.tobytes(), 1)


def unit_features(counts: Iterable[bytes], idf: np.ndarray) -> np.ndarray:
    """Weighted rows of length one of packed counts, ordered by the counts; made in place, little more is held."""
    counts = sorted(counts, key=zlib.decompress)
    rows = np.empty((len(counts), len(idf)), np.float32)
    for i, x in enumerate(counts):
        rows[i] = np.frombuffer(zlib.decompress(x), np.float32)
    for at in range(0, len(rows), 64):
        rows[at:at + 64] = unit_rows(np.log1p(rows[at:at + 64]) * idf)
    return rows


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """At most k unit centroids; seeds are the row nearest the mean, then ever the farthest row."""
    seeds = [int(np.argmax(rows @ rows.mean(axis=0)))]
    nearest = rows @ rows[seeds[0]]
    while len(seeds) < min(k, len(rows)):
        far = int(np.argmin(nearest))
        if nearest[far] > 1 - 1e-6:
            break
        seeds.append(far)
        nearest = np.maximum(nearest, rows @ rows[far])
    centroids = rows[seeds]
    for _ in range(rounds):
        own = np.argmax(rows @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, rows)
        keep = np.bincount(own, minlength=len(centroids)) > 0
        centroids = unit_rows(sums[keep])
    return centroids


def unseen_cosines(rows: np.ndarray, k: int, folds: int = 5) -> np.ndarray:
    """Each row's cosine to the nearest of the centroids of the other folds; none for a single row."""
    folds, fold = min(folds, len(rows)), np.arange(len(rows)) % folds
    if folds < 2:
        return np.zeros(0, rows.dtype)
    return np.concatenate([(rows[fold == f] @ spherical_kmeans(rows[fold != f], k).T).max(axis=1) for f in range(folds)])


def literal_map(values: dict[str, int]) -> Column:
    """The value of the row's language; null for others."""
    if not values:
        return F.lit(None).cast("long")
    return F.element_at(F.create_map(*[F.lit(x) for k, v in values.items() for x in (k, v)]), F.col("_lang"))


def fit_languages(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_per_language: int = 1500,
    max_languages: int = 500,
    centroids_per_language: int = 4,
    bits: int = 12,
    bound_quantile: float = 0.05,
    bound_share: float = 0.5,
) -> LanguageModel:
    """Centroids from at most ``sample_per_language`` rows of each language, those with the smallest
    hashes of their id; that bound and ``max_languages`` (the most frequent) bound the fit.

    A language's bound is ``bound_share`` of the ``bound_quantile`` of its rows'
    cosines to centroids fitted without them; a language of one row has none.
    Rows with a null id, text or language or without a letter teach nothing.
    With no row left the model is empty, and every text is undetermined.
    """
    small_batches(labelled.sparkSession)
    has_letter = F.col("_text").rlike(r"\p{L}")
    rows = labelled.select(labelled[id_col].alias("_id"), labelled[text_col].alias("_text"), labelled[lang_col].alias("_lang"))
    rows = rows.filter(F.col("_id").isNotNull() & F.col("_lang").isNotNull() & has_letter)
    rows = rows.withColumn("_order", F.xxhash64(F.col("_id").cast("string")))
    often = rows.groupBy("_lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "_lang").limit(max_languages).collect()
    # Ids with hashes below a bound that about twice the sample reaches; of these the first, exactly.
    bounds = {r["_lang"]: -(2**63) + min(2**64 - 1, 2**65 * sample_per_language // r["n"]) for r in often}
    by_order = Window.partitionBy("_lang").orderBy("_order")
    few = rows.select("_lang", "_order").filter(F.col("_order") <= literal_map(bounds))
    ranked = few.withColumn("_rank", F.row_number().over(by_order)).filter(F.col("_rank") <= sample_per_language)
    cutoffs = {r["_lang"]: r["last"] for r in ranked.groupBy("_lang").agg(F.max("_order").alias("last")).collect()}
    if not cutoffs:
        return LanguageModel((), np.zeros(0, int), np.zeros((0, 1 << bits), np.float32), np.ones(1 << bits, np.float32), np.zeros(0))
    sample = rows.filter(F.col("_order") <= literal_map(cutoffs)).select("_lang", "_text")

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = ngram_counts(text.as_py(), bits)
                if counts is None:  # letters of a newer Unicode version
                    continue
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([packed(counts)], pa.binary())], names=["_lang", "counts"])

    # Written, as a task that also made them would need a second Python worker, which stays.
    featured = written(sample.mapInArrow(featurize, "_lang string, counts binary"))

    def document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, np.zeros(1 << bits, np.int64)
        for batch in batches:
            for x in batch.column(0):
                n += 1
                seen += np.frombuffer(zlib.decompress(x.as_py()), np.float32) > 0
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([seen.tolist()], pa.list_(pa.int64()))], names=["n", "seen"])

    parts = featured.select("counts").coalesce(8).mapInArrow(document_frequency, "n long, seen array<long>").collect()
    n, seen = sum(p["n"] for p in parts), np.sum([p["seen"] for p in parts], axis=0)
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)

    def cluster(part: pd.DataFrame) -> pd.DataFrame:
        rows = unit_features(part["counts"], idf)
        found, unseen = spherical_kmeans(rows, centroids_per_language), unseen_cosines(rows, centroids_per_language)
        bound = bound_share * float(np.quantile(unseen, bound_quantile)) if len(unseen) else 0.0
        return pd.DataFrame({"_lang": part["_lang"].iloc[0], "centroid": [c.astype(np.float32).tobytes() for c in found], "bound": bound})

    clustered = featured.groupBy("_lang").applyInPandas(cluster, "_lang string, centroid binary, bound double").collect()
    bound_of = {r["_lang"]: r["bound"] for r in clustered}
    clustered = sorted((r["_lang"], bytes(r["centroid"])) for r in clustered)
    languages = tuple(sorted({x for x, _ in clustered}))
    owner = np.array([languages.index(x) for x, _ in clustered])
    return LanguageModel(languages, owner, np.stack([np.frombuffer(c, np.float32) for _, c in clustered]), idf, np.array([bound_of[x] for x in languages]))


def identify_languages(
    docs: DataFrame,
    model: LanguageModel,
    min_similarity: float = 0.1,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, the ``keep`` columns, lang_pred, score (cosine, 0 to 1), rejected.

    Reads whole texts and nothing else of a row. A null text, a text without a
    letter, or any text under an empty model: ``und``, score 0, rejected. Also
    rejected are scores below ``min_similarity`` or the language's bound. Equal
    cosines go to the language first in order. Repeated rows give repeated rows,
    an empty table none; other columns are not read.
    """
    small_batches(docs.sparkSession)
    fields = [T.StructField("doc_id", docs.schema[id_col].dataType), *(docs.schema[c] for c in keep)]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    # Plain values: a broadcast is read on workers that may lack this package. Bounded by the parameters of the fit.
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.owner, model.centroids, model.idf, model.bounds))
    bits = model.centroids.shape[1].bit_length() - 1
    n_keep = len(fields)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, owner, centroids, idf, bounds = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(n_keep).to_pylist()
                lang, score, least = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.full(len(texts), min_similarity)
                counts = [None if not t or not languages else ngram_counts(t, bits) for t in texts]
                known = [i for i, c in enumerate(counts) if c is not None]
                if known:
                    rows = unit_rows(np.log1p(np.stack([counts[i] for i in known])) * idf)
                    near = rows @ centroids.T
                    best = np.argmax(near, axis=1)
                    score[known] = np.clip(near[np.arange(len(known)), best], 0, 1)
                    least[known] = np.maximum(bounds[owner[best]], min_similarity)
                    for i, b in zip(known, best.tolist(), strict=True):
                        lang[i] = languages[owner[b]]
                rejected = [x == UNDETERMINED or s < m for x, s, m in zip(lang, score.tolist(), least.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:n_keep], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], names=schema.fieldNames())

    return docs.select(docs[id_col], *[docs[c] for c in keep], docs[text_col]).mapInArrow(predict, schema)


def crc_fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % folds
