"""Whitening and hard negatives against plain Python and exact arithmetic."""

import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratebridge.llm.hard_negatives import best_in_windows, index_depth, mine_hard_negatives, norms_left
from ratebridge.llm.whitening import one_sided_jacobi, pivoted_cholesky, squared_deviations, whiten

NAN, INF = float("nan"), float("inf")


def vector_rows(n=260, dim=20, seed=5):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    rows = [(i, [x + rng.gauss(0, 0.7) for x in centres[i % 4]], i % 4) for i in range(n)]
    rows += [(n + i, rows[0][1], 1) for i in range(12)]  # copies: ties
    rows += [rows[3], rows[100], rows[100]]  # repeated rows, an anchor among them
    rows += [(100, rows[7][1], 0), (5, [0.0] * dim, 2)]  # one id, other vectors
    rows += [(400, None, 1), (401, [None, *rows[0][1][1:]], 1), (402, [NAN, *rows[0][1][1:]], 1), (403, [INF, *rows[0][1][1:]], 1),
             (404, rows[1][1], None), (None, rows[2][1], 2), (500, [1.0, 2.0], 1), (600, [2.0, 1.0], 1), (601, [2.0, 1.5], 2), (700, [], 1)]
    return rows


def frame(spark, rows, kind="float"):
    got = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    for name in ("x", "v", "n", "dim", "row", "anchor", "slot", "score", "rank", "spread", "whitened", "floor"):
        got = got.withColumn(name, F.lit("clash"))
    return got.repartition(3)


def taking_part(rows):
    return [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]


def test_whitening_matches_exact_arithmetic(spark, checkpoints):
    rows = vector_rows()
    got = whiten(frame(spark, rows, "double"), scale=64.0, shift=1_000_000, top=6).collect()
    kept = [r for r in taking_part(rows) if r[1]]
    assert Counter(r["vec_id"] for r in got) == Counter(i for i, *_ in kept)
    scaled = {}
    for i, v, _ in kept:
        scaled.setdefault(len(v), []).append((i, tuple(math.floor(64 * x) + 1_000_000 for x in v)))
    for dim, same in scaled.items():
        distinct = sorted({x for _, x in same})
        n, sums = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
        centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums, strict=True)] for x in distinct])
        values = np.linalg.eigvalsh(centred.T @ centred / n)[::-1]
        mine = [r for r in got if r["dim"] == dim]
        expected = Counter((i, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))) for i, x in same)
        assert Counter((r["vec_id"], r["deviation"]) for r in mine) == expected
        assert all(r["n"] == n and r["identity_error"] < 1e-9 for r in mine)
        k = min(6, dim, n - 1)
        assert all(len(r["whitened"]) == k == len(r["explained"]) for r in mine)
        assert np.allclose(mine[0]["explained"], values[:k] / values.sum(), rtol=1e-9)
        white = np.array([w for w in {tuple(r["whitened"]) for r in mine}])
        assert np.allclose(white.T @ white / n, np.eye(k), atol=1e-9) and np.allclose(white.mean(axis=0), 0, atol=1e-9)
        for i, x in same:  # Mahalanobis length within the components: independent of signs
            row = next(r for r in mine if r["vec_id"] == i and r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)))
            vectors = np.linalg.eigh(centred.T @ centred / n)[1][:, ::-1][:, :k]
            y = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums, strict=True)])
            assert np.allclose(np.abs(row["whitened"]), np.abs(y @ vectors / np.sqrt(values[:k])), atol=1e-6)


def test_whitening_of_no_and_of_equal_vectors(spark, checkpoints):
    empty = frame(spark, vector_rows()).limit(0)
    assert whiten(empty).collect() == []
    one = whiten(frame(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (None, None, None)])).collect()
    assert [(r["vec_id"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in sorted(one)] == [(1, 1, 0, [], []), (2, 1, 0, [], [])]
    flat = whiten(frame(spark, [(1, [1.0, 5.0], 0), (2, [3.0, 5.0], 0)])).collect()
    assert {(r["vec_id"], abs(r["whitened"][0]), *r["explained"]) for r in flat} == {(1, 1.0, 1.0), (2, 1.0, 1.0)}
    far = whiten(frame(spark, [(1, [1e300], 0), (2, [-1e300], 0), (3, [0.0], 0)], "double")).collect()
    assert all(r["identity_error"] < 1e-9 and len(r["whitened"]) == 1 for r in far)


@pytest.mark.parametrize("rank", [1, 7, 12])
def test_cholesky_and_jacobi(rank):
    rng = np.random.default_rng(rank)
    base = rng.normal(size=(40, rank)) @ rng.normal(size=(rank, 12)) * 10.0 ** -np.arange(12)
    scatter = base.T @ base
    factor = pivoted_cholesky(scatter)
    assert factor.shape[1] <= rank and np.allclose(factor @ factor.T, scatter, rtol=1e-9, atol=1e-12 * scatter.max())
    rotated = one_sided_jacobi(factor)
    product = rotated.T @ rotated
    assert np.allclose(product, np.diag(np.diag(product)), atol=1e-12 * scatter.max())
    assert np.allclose(np.diag(product), np.linalg.eigvalsh(scatter)[::-1][:factor.shape[1]], rtol=1e-6, atol=1e-12 * scatter.max())


def test_deviation_beyond_a_long():
    assert squared_deviations(np.array([[2**31, 0], [1, 1]]), 2, np.array([0, 0], object)) == [None, 8]


def brute_negatives(rows, label_of, scale, positives, negatives, low, high):
    whole = [(i, label_of(i, label), [math.floor(scale * x) for x in v]) for i, v, label in taking_part(rows) if i is not None and label is not None and v]
    out = []
    for i, label, v in whole:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, other) for j, other, w in whole if j != i and len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [(t, j) for t, j, other in scored if other != label and low * -s <= 100 * -t <= high * -s]
            out += [(i, p, rank, j, -s, -t) for rank, (t, j) in enumerate(fits[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize(("positives", "negatives", "low", "high", "block"), [(5, 10, 30, 90, 64), (2, 60, 0, 100, 16), (3, 1, 80, 95, 1000)])
def test_negatives_match_brute_force(spark, checkpoints, positives, negatives, low, high, block):
    rows = vector_rows()
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 4).otherwise(F.col("label"))
    got = mine_hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0, label, positives, negatives, low, high, scale=64.0, anchor_block=4, row_block=block)
    as_float = [(i, v and [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    expected = brute_negatives(as_float, lambda i, x: x if i % 7 else (x + 1) % 4, 64.0, positives, negatives, low, high)
    assert expected and sorted(map(tuple, got.collect())) == expected


def test_negatives_of_no_rows(spark, checkpoints):
    rows = frame(spark, vector_rows())
    assert mine_hard_negatives(rows.limit(0), F.col("vec_id") % 100 == 0, F.col("label")).collect() == []
    assert mine_hard_negatives(rows, F.lit(False), F.col("label")).collect() == []


def test_omitted_dimensions_lose_no_pair():
    rng = np.random.default_rng(1)
    rows = np.floor(rng.normal(size=(300, 40)) * np.linspace(60, 1, 40)).astype(np.int64)
    asked, labels = rows[:9], rng.integers(0, 2, 300)
    depth = index_depth(norms_left(rows.astype(float)), norms_left(asked.astype(float)), 9000.0)
    assert depth.min() < 3 and depth.max() > 0  # some dimensions are not indexed
    windows = (np.repeat(np.arange(9), 2), np.tile([0, 1], 9), np.tile([9000, 500], 9), np.tile([10**9, 8000], 9))
    got = best_in_windows(np.arange(300), rows, labels, np.arange(9), asked, labels[:9], windows, 7, same=False)
    expected = set()
    for a, s, low, high in zip(*windows, strict=True):
        fits = sorted((-int(rows[j] @ asked[a]), j) for j in range(300) if labels[j] != labels[a] and low <= rows[j] @ asked[a] <= high)
        expected |= {(a, s, j, -t) for t, j in fits[:7]}
    assert expected == set(zip(*(x.tolist() for x in got), strict=True))


def test_registered_embedding_queries(spark, checkpoints):
    from ratebridge.llm import queries
    from ratebridge.testing import SF_SMALL, diff_results, duckdb_connection

    white = queries.queries()["op11_embedding_whitening"](spark, SF_SMALL)
    assert white.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert white.groupBy("vec_id").count().filter("count <> 16").count() == 0
    got = queries.queries()["op13_hard_negatives"](spark, SF_SMALL)
    expected = duckdb_connection(SF_SMALL).sql(queries.oracle_sql()["op13_hard_negatives"])
    assert not diff_results(got.columns, [tuple(r) for r in got.collect()], expected.columns, expected.fetchall())
