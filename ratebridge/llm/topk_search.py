"""Exact top-k search by inner product, pruned with multi-resolution segment statistics.

A vector cut into segments is known, at a resolution, by the mean and the
deviation of each. By Cauchy-Schwarz on the centred segments

    q . v <= sum over segments of length * (mean_q * mean_v + dev_q * dev_v)

which is the segment lower bound of the distance, |q|^2 + |v|^2 - 2 q.v, written
for the inner product. Bounds go from coarse to fine; each level drops the rows
whose bound is below the k-th exact score found so far, and only the survivors'
exact scores are computed, in integers.

Queries and rows are dealt into blocks of bounded size; every pair of blocks is
one cogroup, so neither side is broadcast and no task holds more than two blocks.
Each pair of blocks returns at most k rows a query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratebridge.llm.tables import written

#: Up to this size integer sums are exact in double precision.
EXACT = 2.0**53


def integer_vectors(vectors: DataFrame, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """(row, vec_id, v): floor(scale * x) of each component; ``row`` numbers the rows.

    Null vectors, vectors with a null or non-finite component and rows without
    an id are left out.
    """
    finite = ~F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform(vector_col, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    kept = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
    return written(kept.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("vec_id"), scaled.alias("v")))


def segment_statistics(block: np.ndarray, segments: int) -> np.ndarray:
    """Rows of sqrt(length) * (means, deviations); inner products of two such rows are the bound."""
    edges = np.linspace(0, block.shape[1], min(segments, block.shape[1]) + 1).astype(int)
    parts = [block[:, a:b] for a, b in zip(edges, edges[1:], strict=False)]
    means = np.stack([p.mean(axis=1) for p in parts], axis=1)
    devs = np.stack([p.std(axis=1) for p in parts], axis=1)
    root = np.sqrt(np.diff(edges))
    return np.hstack([means * root, devs * root])


def block_topk(query_ids, queries, row_ids, rows, k: int, levels: tuple[int, ...]) -> list[tuple]:
    """(place of the query, row id, score) of each query's best k rows of the block, those of its id left out."""
    q_int, r_int = np.asarray(queries, dtype=object), np.asarray(rows, dtype=object)
    top = lambda m: max((abs(int(x)) for x in (m.max(), m.min())), default=0) if m.size else 0
    bound = top(q_int) * top(r_int) * max(1, q_int.shape[1])
    if bound >= EXACT:  # beyond double precision: Python's integers, no pruning
        scores = [[max(-(2**63), min(2**63 - 1, sum(int(a) * int(b) for a, b in zip(q, r, strict=True)))) for r in r_int] for q in q_int]
        found = []
        for i, (qid, line) in enumerate(zip(query_ids, scores, strict=True)):
            best = sorted(((-s, rid) for s, rid in zip(line, row_ids, strict=True) if rid != qid))[:k]
            found += [(i, rid, -s) for s, rid in best]
        return found
    q, r = q_int.astype(np.float64), r_int.astype(np.float64)
    row_ids = np.asarray(row_ids)
    if not q.shape[1]:
        levels = ()
    stats = [(segment_statistics(q, n), segment_statistics(r, n)) for n in levels]
    found = []
    for i, qid in enumerate(query_ids):
        alive = np.flatnonzero(row_ids != qid)
        floor = -math.inf
        for level, (sq, sr) in enumerate(stats):
            bounds = (sr if level == 0 else sr[alive]) @ sq[i]
            bounds = bounds[alive] if level == 0 else bounds
            if len(alive) > k:
                likely = alive[np.argpartition(-bounds, k - 1)[:k]]
                floor = max(floor, float(np.min(r[likely] @ q[i])))
                slack = 1e-9 * (1.0 + abs(floor) + float(np.abs(bounds).max()))
                alive = alive[bounds >= floor - slack]
        scores = r[alive] @ q[i]
        best = np.lexsort((row_ids[alive], -scores))[:k]
        found += [(i, row_ids[alive[j]], int(scores[j])) for j in best]
    return found


def segment_topk(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: float = 1.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    levels: tuple[int, ...] = (4, 16),
    query_block: int = 256,
    row_block: int = 8192,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best rows, ties to the smaller id.

    ``is_query`` is a condition on ``vec_id``. Vectors are compared with those of
    the same dimension, never with rows of their own id; a query with fewer
    than k such rows returns all. Rows that share an id all take part, and a query
    id that stands in several rows returns the best rows of each. Which rows take part: see ``integer_vectors``;
    an empty table or no query gives no rows; other columns are not read.
    Integer scores beyond a long are held at its limits.
    """
    whole = integer_vectors(vectors.select(vectors[id_col], vectors[vector_col]), scale, id_col, vector_col)
    whole = whole.withColumn("dim", F.size("v"))
    n_rows, n_queries = whole.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    row_blocks, query_blocks = max(1, math.ceil(n_rows / row_block)), max(1, math.ceil(n_queries / query_block))
    id_type = whole.schema["vec_id"].dataType

    def dealt(blocks: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    # Own names on this side: a cogroup of two readings of one table must not share columns, or one side loses them.
    rows = whole.select(F.col("dim").alias("dim"), dealt(row_blocks).alias("row_block"), every(query_blocks).alias("query_block"), F.col("vec_id").alias("among_id"), F.col("v").alias("among"))
    queries = whole.filter(is_query).select("dim", dealt(query_blocks).alias("query_block"), every(row_blocks).alias("row_block"), "row", "vec_id", "v")
    schema = T.StructType([T.StructField("query", T.LongType()), T.StructField("query_id", id_type), T.StructField("vec_id", id_type), T.StructField("score", T.LongType())])

    def search(asked: pd.DataFrame, among: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or among.empty:
            return pd.DataFrame({f.name: [] for f in schema})
        matrix = lambda part: np.array([list(x) for x in part], dtype=np.int64).reshape(len(part), -1)
        found = block_topk(asked["vec_id"].tolist(), matrix(asked["v"]), among["among_id"].tolist(), matrix(among["among"]), k, levels)
        rows_of, ids_of = asked["row"].tolist(), asked["vec_id"].tolist()
        return pd.DataFrame([(rows_of[i], ids_of[i], rid, score) for i, rid, score in found], columns=[f.name for f in schema])

    key = ["dim", "query_block", "row_block"]
    found = queries.groupBy(*key).cogroup(rows.groupBy(*key)).applyInPandas(search, schema)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
