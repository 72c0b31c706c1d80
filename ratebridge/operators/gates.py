"""Batch gates: required members present, batch not empty."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class GateError(RuntimeError):
    """A batch failed a completeness gate and must not be published."""


def missing_members(df: DataFrame, col: str, required: Sequence[str]) -> DataFrame:
    """Required values of ``col`` that do not occur in ``df`` (one row each).

    ``present`` is filtered to the required set before the distinct, so it is
    bounded by ``len(required)`` rows whatever the size of ``df``; the distinct
    is partially aggregated on the map side.
    """
    spark: SparkSession = df.sparkSession
    wanted = spark.createDataFrame([(m,) for m in required], [col])
    present = df.where(F.col(col).isin(list(required))).select(col).distinct()
    return wanted.join(F.broadcast(present), on=col, how="left_anti")


def require_members(df: DataFrame, col: str, required: Sequence[str]) -> DataFrame:
    """Raise ``GateError`` naming the missing members; return ``df`` unchanged otherwise."""
    missing = sorted(r[0] for r in missing_members(df, col, required).collect())
    if missing:
        raise GateError(f"missing required {col} values: {', '.join(missing)}")
    return df


def require_rows(df: DataFrame, what: str = "batch") -> DataFrame:
    """Raise ``GateError`` when ``df`` is empty (reads at most one row)."""
    if df.isEmpty():
        raise GateError(f"no rows in {what}")
    return df
