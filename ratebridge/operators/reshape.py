"""Reshaping operators: long-to-wide pivot and forward fill."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pivot_series(
    df: DataFrame,
    key: str | Sequence[str],
    code: str,
    value: str,
    mapping: Mapping[str, str],
) -> DataFrame:
    """One row per key with one column per mapped code: ``max(case when code = k then value end)``.

    Written as conditional aggregates rather than ``groupBy().pivot()``: the
    latter plans an extra aggregation; this is one partial (map-side) hash
    aggregate, one exchange of at most (#keys x #map tasks) rows, and one final
    aggregate. Codes outside ``mapping`` add nothing, but their keys still get a
    row (all NULL), as in the SQL form.
    """
    keys = [key] if isinstance(key, str) else list(key)
    c = F.col(code)
    aggs = [F.max(F.when(c == k, F.col(value))).alias(name) for k, name in mapping.items()]
    return df.groupBy(*keys).agg(*aggs)


def ffill(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    chunk: Column | str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Forward fill: ``out`` = last non-NULL ``value`` so far within ``by`` in ``order``.

    Without ``chunk`` this is one running window per group. With ``chunk`` (a
    coarse, monotone function of the order, e.g. the day of a timestamp) the
    scan is split so no single group has to fit in one task:

    1. running fill inside each (group, chunk) (the one shuffle of the rows);
    2. per (group, chunk), the fill of its last row (same partitioning, no shuffle);
    3. a running fill over those chunk summaries (one row per chunk) gives the
       value carried into each chunk;
    4. the carry is joined back on (group, chunk); step 1's output is persisted
       (memory, spilling to disk), so the rows are shuffled and windowed once.

    ``chunk="range"`` bounds every chunk whatever the skew: the rows are
    range-partitioned by (group, order) into ``partitions`` ranges (sampled
    bounds, as ``repartitionByRange`` does) and the range id becomes the chunk.
    Range ids grow along the fill order inside a group, so one very large group
    is cut into many bounded chunks. This costs one extra shuffle.

    ``order`` must be a total order inside a group (end it with a unique id).
    """
    by = list(by)
    order_cols = [F.col(o).asc_nulls_last() for o in order]
    v = F.col(value)
    frame = (Window.unboundedPreceding, Window.currentRow)
    if chunk is None:
        w = Window.partitionBy(*by).orderBy(*order_cols).rowsBetween(*frame)
        return df.withColumn(out, F.last(v, ignorenulls=True).over(w))

    chunk_col = "__chunk"
    carry_col = "__carry"
    if isinstance(chunk, str):
        if chunk != "range":
            raise ValueError(f"unknown chunk mode {chunk}")
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # Same null placement as the fill order, so range ids are monotone in it.
        ranged = df.repartitionByRange(n, *[F.col(b).asc_nulls_first() for b in by], *order_cols)
        staged = ranged.withColumn(chunk_col, F.spark_partition_id())
    else:
        staged = df.withColumn(chunk_col, chunk)
    w_local = Window.partitionBy(*by, chunk_col).orderBy(*order_cols).rowsBetween(*frame)
    # `local` feeds both the carry summary and the final join; persisting it
    # shuffles and windows the rows once (self-join branches would otherwise
    # be pruned differently and computed twice).
    local = staged.withColumn(out, F.last(v, ignorenulls=True).over(w_local)).persist(StorageLevel.MEMORY_AND_DISK)

    order_key = F.struct(*[F.col(o) for o in order])
    # The chunk's carry-out is the running fill of its last row. `local` is
    # already hash-partitioned by (group, chunk) and sorted by the fill order,
    # so this aggregate needs no new shuffle and no second scan of the input.
    # Every chunk gets a row (NULL when it has no value), so the carry passes
    # through all-NULL chunks.
    summary = local.groupBy(*by, chunk_col).agg(F.max_by(F.col(out), order_key).alias("__last"))
    w_carry = Window.partitionBy(*by).orderBy(F.col(chunk_col)).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*by, chunk_col, F.last("__last", ignorenulls=True).over(w_carry).alias(carry_col))
    # Null-safe keys: a NULL group is one window group too, and `<=>` infers no
    # IS NOT NULL filter, so both sides keep the same plan for `local` and its
    # shuffle is computed once and reused.
    keys = [*by, chunk_col]
    carry = carry.select(*[F.col(k).alias(f"__c_{k}") for k in keys], carry_col)
    cond = [F.col(k).eqNullSafe(F.col(f"__c_{k}")) for k in keys]
    return (
        local.join(carry, cond, how="left")
        .withColumn(out, F.coalesce(F.col(out), F.col(carry_col)))
        .drop(chunk_col, carry_col, *[f"__c_{k}" for k in keys])
    )
