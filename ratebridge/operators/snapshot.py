"""Latest complete snapshot and attaching a one-row snapshot to every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_complete(df: DataFrame, date_col: str, required: Sequence[str]) -> DataFrame:
    """Rows of ``df`` on the latest ``date_col`` where every ``required`` column is non-NULL.

    No forward fill: a date with one missing column does not qualify. When no
    date qualifies the result is empty (not a row of NULLs).

    The max is a global partial/final aggregate that always yields exactly one
    row, so broadcasting it is bounded by construction; the equality join then
    keeps the matching rows without a shuffle of ``df``.
    """
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    target = df.where(complete).agg(F.max(date_col).alias("__snapshot_date"))
    return (
        df.join(F.broadcast(target), F.col(date_col) == F.col("__snapshot_date"), "inner")
        .drop("__snapshot_date")
    )


def attach_snapshot(df: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Append the columns of a 0-or-1-row ``snapshot`` to every row of ``df``.

    Callers guarantee the bound (e.g. ``latest_complete_row`` over a relation
    unique on its date). Written as an equi-join on a constant key; Catalyst
    folds the key and runs a broadcast nested-loop join against the single
    snapshot row, so each row of ``df`` yields at most one output row, ``df`` is
    never shuffled, and an empty snapshot empties the result.
    """
    key = "__snapshot_key"
    one = F.lit(1).cast("int")
    joined = df.withColumn(key, one).join(F.broadcast(snapshot.withColumn(key, one)), key, "inner")
    return joined.drop(key)


def latest_complete_row(df: DataFrame, date_col: str, required: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``latest_complete`` for a relation unique on ``date_col``, in one pass.

    A single global ``max_by(struct(columns), date)`` over the complete rows
    (partial aggregate per task, one row per task shuffled) - no self-join, so
    ``df`` is computed once instead of once per join side. 0 or 1 row.
    """
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    row = F.struct(*[F.col(c) for c in columns])
    latest = df.where(complete).agg(F.max_by(row, F.col(date_col)).alias("__row"))
    return latest.where(F.col("__row").isNotNull()).select("__row.*")
