"""Top-1 per key (deduplication and latest-row selection).

Both operators are ``row_number() over (partition by keys order by ...) = 1``.
Catalyst turns that into ``WindowGroupLimit`` Partial -> Exchange -> Final:
every map task keeps only its first row per key *before* the shuffle, so a
key holding a third of all rows sends at most one row per map task across
the network and the final task for it sees a handful of rows.

Callers pass a *total* order (ties broken down to the last output column) so
the survivor never depends on input row order; the reference leaves several of
these orders partial, which makes its result arbitrary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK_COL = "__rn"


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key group under ``order`` (sort expressions with
    explicit null placement, e.g. ``F.col('ts').asc_nulls_last()``)."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn(RANK_COL, F.row_number().over(w)).where(F.col(RANK_COL) == 1).drop(RANK_COL)


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Deduplicate on ``keys``, keeping the earliest row by ``order``."""
    return first_per_key(df, keys, order)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_desc: Sequence[Column]) -> DataFrame:
    """Latest row per key; ``order_desc`` lists the recency columns (descending, nulls last)
    followed by any tie-break columns."""
    return first_per_key(df, keys, order_desc)


def asc(*names: str) -> list[Column]:
    """Ascending, NULLs last (the SQL-standard default the reference relies on)."""
    return [F.col(n).asc_nulls_last() for n in names]


def desc(*names: str) -> list[Column]:
    """Descending, NULLs last."""
    return [F.col(n).desc_nulls_last() for n in names]


def dedup_by_min(
    df: DataFrame,
    keys: Sequence[str],
    first: str,
    rest: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Top-1 per key under the order (``first``, *``rest``), all NULLs last, for
    relations whose columns are exactly ``keys`` + ``first`` + ``rest``.

    Built for heavily duplicated input (overlapping reloads): a hash aggregate
    first reduces every (key, rest) group to min (or max) of the fixed-width
    ``first`` column - map-side, with no sort of the input - and the top-1
    window then runs on those few survivors. Exact: the lexicographic minimum
    over rows equals the minimum over (rest)-groups of (min first, rest).
    """
    agg = F.max if descending else F.min
    reduced = df.groupBy(*keys, *rest).agg(agg(first).alias(first))
    order = (desc if descending else asc)(first) + asc(*rest)
    return first_per_key(reduced, keys, order).select(*df.columns)
