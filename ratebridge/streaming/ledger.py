"""A ledger of ingested batches: the high-water mark moves only past complete ones.

The ledger is a table of files, one row a batch: (source, batch, from_date, to_date,
status, missing). The next range of a source starts where its last complete batch
ended, that day included, so what an incomplete batch lacked is fetched again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebridge.operators.gates import missing_members

LEDGER = "source string, batch long, from_date string, to_date string, status string, missing array<string>"
COMPLETE, INCOMPLETE, EMPTY = "complete", "incomplete", "empty"


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    path: str

    def read(self) -> DataFrame:
        """One row a batch; a batch noted twice (a replay) counts as noted last."""
        try:
            rows = self.spark.read.schema(LEDGER + ", noted timestamp").parquet(self.path)
        except Exception as exc:  # no batch yet
            if getattr(exc, "getCondition", lambda: "")() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LEDGER)
        last = rows.groupBy("source", "batch").agg(F.max_by(F.struct("from_date", "to_date", "status", "missing"), F.struct("noted", "status")).alias("r"))
        return last.select("source", "batch", "r.*")

    def note(self, source: str, batch: int, span: tuple[str, str], status: str, missing: Sequence[str] = ()) -> None:
        row = self.spark.createDataFrame([(source, batch, *span, status, list(missing))], LEDGER)
        row.withColumn("noted", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self.path)

    def mark(self, source: str) -> str | None:
        """Where the last complete batch of the source ended; one row is read."""
        done = self.read().where((F.col("source") == source) & (F.col("status") == COMPLETE))
        return done.agg(F.max("to_date")).first()[0]

    def next_range(self, source: str, default_start: str, as_of: str) -> tuple[str, str] | None:
        """(from, to) of the next batch, None when the mark is at ``as_of``."""
        start = self.mark(source) or default_start
        return None if start >= as_of else (start, as_of)

    def next_batch(self, source: str) -> int:
        return (self.read().where(F.col("source") == source).agg(F.max("batch")).first()[0] or 0) + 1


def ingest_range(
    ledger: Ledger,
    source: str,
    default_start: str,
    as_of: str,
    fetch: Callable[[str, str], DataFrame],
    publish: Callable[[DataFrame, int], object],
    required: Sequence[str],
    member: str,
) -> str | None:
    """One run of a source: the rows of the next range are published, and the batch is noted.

    A batch that lacks a required ``member`` is published (rows merge by key, so
    nothing is lost) but noted as incomplete, and the mark stays. Returns the status,
    None when there is nothing to fetch. A run that stops before the note is run again
    with the same range and number.
    """
    span = ledger.next_range(source, default_start, as_of)
    if span is None:
        return None
    batch = ledger.next_batch(source)
    rows = fetch(*span)
    missing = sorted(r[0] for r in missing_members(rows, member, required).collect())
    status = COMPLETE if not missing else EMPTY if rows.isEmpty() else INCOMPLETE
    if status != EMPTY:
        publish(rows, batch)
    ledger.note(source, batch, span, status, missing)
    return status
