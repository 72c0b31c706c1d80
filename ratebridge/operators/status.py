"""Freshness columns and worst-of status roll-ups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratebridge import schemas as S
from ratebridge.functions.dates import age_days, freshness_level


def with_freshness(
    df: DataFrame,
    date_col: str,
    as_of: str | dt.date | None,
    warn_after: int,
    stale_after: int,
    age_col: str,
    level_col: str,
) -> DataFrame:
    """Add ``age_col`` (days from ``date_col`` to ``as_of``) and a fresh/aging/stale level."""
    return df.withColumn(age_col, age_days(date_col, as_of)).withColumn(
        level_col, freshness_level(F.col(age_col), warn_after, stale_after)
    )


def severity(status: Column | str, levels: Sequence[str] = S.FRESHNESS_LEVELS) -> Column:
    """0 for the best level (and for NULL or unknown values), rising with each worse level."""
    s = F.col(status) if isinstance(status, str) else status
    expr = F.lit(0)
    for rank, level in enumerate(levels[1:], start=1):
        expr = F.when(s == level, F.lit(rank)).otherwise(expr)
    return expr


def level_of(rank: Column, levels: Sequence[str] = S.FRESHNESS_LEVELS) -> Column:
    expr = F.lit(levels[0])
    for r, level in enumerate(levels[1:], start=1):
        expr = F.when(rank == r, F.lit(level)).otherwise(expr)
    return expr


def worst_status(status: Column | str, levels: Sequence[str] = S.FRESHNESS_LEVELS) -> Column:
    """Aggregate: the worst level present in the group (best level when none is worse).

    One integer ``max`` instead of an indicator per level, so it stays a
    fixed-width hash aggregate with map-side partial aggregation.
    """
    return level_of(F.max(severity(status, levels)), levels)
