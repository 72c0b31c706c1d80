"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on its factor.

Components become integers, so the scatter of the distinct vectors is summed
exactly, in any order, with the same result on every run. Its pivoted Cholesky
factor L (scatter = L L') is rotated from the right by one-sided Jacobi until its
columns are orthogonal: their squared norms are the eigenvalues, the columns
divided by their norms the components. Only the scatter, whose size is the square
of the dimension, reaches the driver; vectors stay in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratebridge.llm.tables import written
from ratebridge.llm.vectors import finite, integer_components, matrix_of

#: Scaled components are held within this distance of zero, so that exact sums fit a decimal.
HELD = float(1 << 40)
#: Up to this size sums of integers are exact in double precision.
EXACT = 2**53
#: Rows of a block of vectors in a task.
BLOCK = 4096


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """L (rows in the matrix's order, a column for each rank) with matrix = L L' up to rounding.

    The next pivot is ever the largest diagonal left; what is left at the size of
    rounding is taken as zero.
    """
    d = len(matrix)
    left = np.diag(matrix).astype(float).copy()
    least = left.max(initial=0.0) * d * np.finfo(float).eps
    columns: list[np.ndarray] = []
    while len(columns) < d and left.max() > least:
        pivot = int(np.argmax(left))
        column = matrix[:, pivot] - sum((c * c[pivot] for c in columns), np.zeros(d))
        column = column / np.sqrt(left[pivot])
        column[np.isinf(left)] = 0.0  # rows of earlier pivots
        column[pivot] = np.sqrt(left[pivot])
        left = left - column**2
        left[pivot] = -np.inf  # never again
        columns.append(column)
    return np.array(columns).T.reshape(d, len(columns))


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor with its columns rotated, pair by pair, until all are orthogonal; longest first.

    The pairs of a round are disjoint, as in a tournament, so a round is one step on arrays.
    """
    columns = np.array(factor, float)
    r = columns.shape[1]
    if r < 2:
        return columns
    seats = [*range(r), *([-1] if r % 2 else [])]
    tolerance = np.finfo(float).eps * np.sqrt(len(columns))
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            pairs = np.array([(a, b) for a, b in zip(seats[:half], reversed(seats[half:]), strict=True) if a >= 0 and b >= 0])
            p, q = columns[:, pairs[:, 0]], columns[:, pairs[:, 1]]
            alpha, beta, gamma = (p * p).sum(0), (q * q).sum(0), (p * q).sum(0)
            size = np.sqrt(alpha * beta)
            off = np.divide(np.abs(gamma), size, out=np.zeros_like(size), where=size > 0)
            worst = max(worst, float(off.max()))
            turn = off > tolerance
            zeta = np.divide(beta - alpha, 2 * gamma, out=np.zeros_like(gamma), where=turn)
            tangent = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta)), 0.0)
            cosine = 1 / np.hypot(1, tangent)
            sine = cosine * tangent
            columns[:, pairs[:, 0]], columns[:, pairs[:, 1]] = cosine * p - sine * q, sine * p + cosine * q
            seats = [seats[0], seats[-1], *seats[1:-1]]
        if worst <= tolerance:
            break
    return columns[:, np.argsort(-(columns**2).sum(0), kind="stable")]


@dataclass(frozen=True)
class Whitening:
    """Of the ``n`` distinct vectors: ``sums`` by dimension, the ``eigenvalues`` of their covariance,
    falling, its ``trace`` and the unit ``components`` (a column each)."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    trace: float
    components: np.ndarray


def exact_scatter(block: np.ndarray) -> np.ndarray | None:
    """block' block as longs, or None where a sum might not fit."""
    top = int(np.abs(block).max(initial=0))
    if top * top * len(block) < EXACT:
        return (block.T.astype(float) @ block.astype(float)).astype(np.int64)
    return block.T @ block if top * top * len(block) < 2**62 else None


def scatter_parts(centred: DataFrame, dim: int) -> DataFrame:
    """(i, j, part): parts of the sum of x_i * x_j over the vectors ``x``, j not below i; exact."""
    upper = np.triu_indices(dim)
    schema = "i int, j int, part decimal(38,0)"

    def rows(parts: list[int]) -> pa.RecordBatch:
        import decimal

        held = pa.array([decimal.Decimal(int(x)) for x in parts], pa.decimal128(38, 0))
        return pa.RecordBatch.from_arrays([pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), held], names=["i", "j", "part"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, top = np.zeros((dim, dim), np.int64), 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = matrix_of(batch.column(0).slice(at, BLOCK))
                part = exact_scatter(block)
                if part is None:
                    block = block.astype(object)
                    yield rows((block.T @ block)[upper].tolist())
                    continue
                most = int(np.abs(part).max(initial=0))
                if top + most >= 2**62:
                    yield rows(total[upper].tolist())
                    total, top = np.zeros((dim, dim), np.int64), 0
                total, top = total + part, top + most
        if top:
            yield rows(total[upper].tolist())

    return centred.mapInArrow(summed, schema)


def fit_whitening(distinct: DataFrame, dim: int) -> Whitening:
    """The whitening of the vectors ``x`` (longs, all of that dimension), each a row once."""
    wide = T.DecimalType(38, 0)
    got = distinct.select(F.posexplode("x")).groupBy("pos").agg(F.count("*").alias("n"), F.sum(F.col("col").cast(wide)).alias("s")).collect()
    if not got or not dim:
        return Whitening(0, (0,) * dim, np.zeros(0), 0.0, np.zeros((dim, 0)))
    n = got[0]["n"]
    sums = [int(r["s"]) for r in sorted(got, key=lambda r: r["pos"])]
    centre = [(2 * s + n) // (2 * n) for s in sums]  # nearest whole number to the mean
    near = F.array(*[F.lit(c).cast("long") for c in centre])
    parts = scatter_parts(distinct.select(F.zip_with("x", near, lambda x, c: x - c).alias("x")), dim)
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    covariance = np.zeros((dim, dim))
    for r in parts.groupBy("i", "j").agg(F.sum("part").alias("part")).collect():
        i, j = r["i"], r["j"]
        covariance[i, j] = covariance[j, i] = float(Fraction(n * int(r["part"]) - rest[i] * rest[j], n * n))
    rotated = one_sided_jacobi(pivoted_cholesky(covariance))
    values = (rotated**2).sum(0)
    components = np.divide(rotated, np.sqrt(values), out=np.zeros_like(rotated), where=values > 0)
    return Whitening(n, tuple(sums), values, float(np.trace(covariance)), components)


def centred_rows(block: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exactly."""
    wide = int(np.abs(block).max(initial=0)) * n + int(max(map(abs, sums.tolist()), default=0)) >= 2**62
    return block.astype(object) * n - sums.astype(object) if wide else block * np.int64(n) - sums.astype(np.int64)


def projected(block: np.ndarray, n: int, sums: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Whitened rows; ``axes`` are the components divided by the roots of their eigenvalues.

    Each row is summed in the same order whatever stands beside it, so equal vectors have equal results.
    """
    return np.einsum("ij,jk->ik", centred_rows(block, n, sums).astype(float) / n, axes)


def squared_deviations(block: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum of (n * x - sums)^2 of each row, exactly; None beyond a long."""
    far = centred_rows(block, n, sums)
    if far.dtype != object and int(np.abs(far).max(initial=0)) ** 2 * far.shape[1] < 2**63:
        return (far * far).sum(1).tolist()
    whole = (sum(int(x) ** 2 for x in row) for row in far.tolist())
    return [x if x < 2**63 else None for x in whole]


def identity_error(distinct: DataFrame, model: Whitening, top: int) -> float:
    """Largest entry, as to size, of the covariance of the whitened vectors minus the identity; one pass."""
    n, sums, axes = model.n, np.array(model.sums, object), whitening_axes(model, top)
    k = axes.shape[1]
    if not k:
        return 0.0

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                white = projected(matrix_of(batch.column(0).slice(at, BLOCK)), n, sums, axes)
                total += white.T @ white
        i, j = np.indices((k, k)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], names=["i", "j", "part"])

    entries = distinct.select("x").mapInArrow(summed, "i int, j int, part double").groupBy("i", "j").agg((F.sum("part") / n).alias("c"))
    return float(entries.agg(F.max(F.abs(F.col("c") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)))).first()[0])


def whitening_axes(model: Whitening, top: int) -> np.ndarray:
    """Components by which vectors are projected, each divided by the root of its eigenvalue."""
    return model.components[:, :top] / np.sqrt(model.eigenvalues[:top])


def whiten(
    vectors: DataFrame,
    scale: float = 1.0,
    shift: int = 0,
    top: int = 16,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, dim, n, deviation, whitened, explained, identity_error; the last three for each of the first ``top`` components.

    ``whitened`` is an array by component, ``explained`` the shares of the trace.
    Rows whose vector is null or has a null or non-finite component are left out; a
    null id is kept as it is. The fit counts each distinct vector once, so repeated
    rows change nothing but give repeated results. Vectors of different lengths are
    whitened apart, a model a length (``dim``). Directions without variance have no
    component: the arrays are then shorter, for a single distinct vector empty. An
    empty table gives no rows; other columns are not read. Scaled components are
    held at 2^40; a deviation beyond a long is null.
    """
    x = integer_components(vectors[vector_col], scale, shift, most=HELD)
    whole = vectors.filter(finite(vectors[vector_col]) & (F.size(vectors[vector_col]) > 0))
    rows = whole.select(vectors[id_col].alias("vec_id"), x.alias("x"))
    distinct = written(rows.select("x").distinct())
    schema = T.StructType([
        T.StructField("vec_id", vectors.schema[id_col].dataType), T.StructField("dim", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType())),
        T.StructField("explained", T.ArrayType(T.DoubleType())), T.StructField("identity_error", T.DoubleType()),
    ])
    out = vectors.sparkSession.createDataFrame([], schema)
    for (dim,) in distinct.select(F.size("x")).distinct().orderBy(F.size("x")).collect():
        same = distinct.filter(F.size("x") == dim)
        model = fit_whitening(same, dim)
        error = identity_error(same, model, top)
        out = out.unionByName(apply_whitening(rows.filter(F.size("x") == dim), model, error, top, schema))
    return out


def apply_whitening(rows: DataFrame, model: Whitening, error: float, top: int, schema: T.StructType) -> DataFrame:
    """The rows (vec_id, x) whitened; one narrow pass."""
    n, sums, axes, dim = model.n, np.array(model.sums, object), whitening_axes(model, top), len(model.sums)
    shares = (model.eigenvalues[:top] / model.trace).tolist() if model.trace else []
    names = schema.fieldNames()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                block, size = matrix_of(part.column(1)), part.num_rows
                whitened = projected(block, n, sums, axes)
                lists = lambda a: pa.ListArray.from_arrays(pa.array(np.arange(size + 1) * axes.shape[1], pa.int32()), pa.array(a, pa.float64()))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([dim] * size, pa.int32()), pa.array([n] * size, pa.int64()), pa.array(squared_deviations(block, n, sums), pa.int64()),
                    lists(whitened.ravel()), lists(np.tile(shares, size)), pa.array([error] * size)], names=names)

    return rows.mapInArrow(apply, schema)
