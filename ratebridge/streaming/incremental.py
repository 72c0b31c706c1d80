"""Incremental ingestion with Structured Streaming.

The collectors keep a high-water mark and re-fetch an overlapping look-back
window, so the same observation lands several times. Here the landing folder
is a streaming file source (``trigger(availableNow=True)`` processes what has
landed and stops, with progress in the checkpoint), and overlaps are resolved
in one of four ways:

* ``dedup_stream`` - drop repeats of a key within a watermark
  (``dropDuplicatesWithinWatermark``; state kept for the look-back window);
* ``first_copies`` - per micro-batch, keep the first copy of every key in a
  period-partitioned table, late ones too, marked as such;
* ``merge_by_key`` - per micro-batch, merge the batch into a period-partitioned
  table by key (replace-on-overlap per key, never per whole period, so a
  re-delivery missing one series does not erase it);
* ``latest_state`` - per micro-batch, keep one latest row per key in a
  bucketed state table, rewriting only the buckets the batch touches.

A micro-batch that merges is written to a folder of its own and published by
partition location under its batch id (``sources/published.py``), so a batch that is
retried after an executor or driver failure, wherever it stopped, gives the same table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ratebridge.operators.topk import first_per_key
from ratebridge.sources.published import PublishedTable

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Large dedup state belongs off-heap; set the RocksDB provider unless the
    session already chose one (must happen before a query first starts)."""
    if not spark.conf.get("spark.sql.streaming.stateStore.providerClass", None):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def landed_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "json",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming scan of a landing folder (recursive, declared schema); a malformed line stops the query,
    as it stops the batch scan."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format(fmt).load(path)


def dedup_stream(stream: DataFrame, keys: Sequence[str], event_time: Column, delay: str = "10 days") -> DataFrame:
    """Drop repeated keys that arrive within ``delay`` of each other (event time).

    Rows older than the watermark are dropped as late; the delay must cover the
    re-delivery window (the collectors' look-back) so that no first copy is late.
    """
    return (
        stream.withColumn("__event_time", event_time)
        .withWatermark("__event_time", delay)
        .dropDuplicatesWithinWatermark(list(keys))
        .drop("__event_time")
    )


def run_available(
    df: DataFrame,
    checkpoint: str,
    sink_path: str | None = None,
    fmt: str = "parquet",
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Process everything landed so far, then stop (blocks until done)."""
    w = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt).option("path", sink_path).outputMode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    return q


def merge_by_key(target: PublishedTable, keys: Sequence[str], order: Sequence[Column], writer: str = "stream") -> Callable[[DataFrame, int], None]:
    """foreachBatch function: merge each batch into ``target`` by ``keys``.

    For the periods the batch touches, old rows and batch are reduced to the first
    row per key under ``order``, written once to the batch's folder and published by
    partition location (``PublishedTable.merge``): a batch that stops anywhere and is
    replayed under its id gives the same table.
    """

    def fn(batch: DataFrame, batch_id: int) -> None:
        target.merge(batch, batch_id, keys, order, writer=writer)

    return fn


def first_copies(target: PublishedTable, keys: Sequence[str], event_time: str, delay_days: int, writer: str = "stream") -> Callable[[DataFrame, int], None]:
    """foreachBatch function: the first copy of every key, however late it comes.

    A watermark drops what is older than it, unseen first copies too. Here the table
    itself is the state: a batch is compared with the periods it touches and no others,
    so a late first copy costs one old period and is kept, with ``late`` true where it
    is more than ``delay_days`` older than the newest row of earlier batches. Kept rows
    and repeats add up to what came in; late ones are counted by their column.

    The period of a row must hang on its event time alone. The newest event time is
    noted with the staged batch, so a batch that is replayed finds the same rows late.
    """

    def fn(batch: DataFrame, batch_id: int) -> None:
        order = [F.col(c).asc_nulls_last() for c in (event_time, *sorted(set(batch.columns) - {event_time, *keys}))]
        reduced = first_per_key(batch, keys, order).persist()
        newest = target.journal("newest", writer)

        def rows() -> DataFrame:
            old = target.touched(reduced)
            late = F.lit(False) if newest is None else F.unix_seconds(event_time) < newest - delay_days * 86400
            new = (reduced if old is None else reduced.join(old.select(*keys), list(keys), "left_anti")).withColumn("late", late)
            return new if old is None else old.unionByName(new)

        def last() -> dict:
            seen = reduced.agg(F.max(F.unix_seconds(event_time))).first()[0]
            return {"newest": max(x for x in (seen, newest) if x is not None)} if seen is not None or newest is not None else {}

        try:
            target.apply(rows, batch_id, writer=writer, more=last)
        finally:
            reduced.unpersist()

    return fn


def state_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a state table, by hash of the keys."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def latest_state(target: PublishedTable, keys: Sequence[str], order_desc: Sequence[Column], buckets: int = 64, writer: str = "stream") -> Callable[[DataFrame, int], None]:
    """foreachBatch function: keep the latest row per key in a table partitioned by
    ``state_bucket``; only the buckets a batch touches are read and written, so a batch
    costs O(batch + touched buckets), not O(state). ``buckets`` is fixed for the table's
    life: choose it so that a bucket of the full state is about one file."""
    if target.by != ("state_bucket",):
        raise ValueError("the state table must be partitioned by state_bucket")

    def fn(batch: DataFrame, batch_id: int) -> None:
        target.merge(batch.withColumn("state_bucket", state_bucket(keys, buckets)), batch_id, keys, order_desc, writer=writer)

    return fn


# ---- batch form of the high-water mark ---------------------------------------------------


def incremental_range(
    target: DataFrame | None,
    date_col: str,
    default_start: str,
    as_of: str | dt.date,
) -> tuple[str, str] | None:
    """(from, to) of the next fetch: from the newest date already stored
    (inclusive restart, so a partial last day is fetched again) or
    ``default_start`` when nothing is stored; None when already caught up.
    Reads one aggregate row."""
    to = as_of if isinstance(as_of, str) else as_of.isoformat()
    start = None
    if target is not None:
        start = target.agg(F.max(F.col(date_col).cast("string"))).first()[0]
    start = start or default_start
    return None if start >= to else (start, to)
