"""Tables whose batches are written first, audited, and then published by partition location.

A batch is written to a folder of its own and never changed afterwards. Publishing
points the catalog's partitions at that folder, one metadata command a partition,
so readers see a period either as it was or as the batch made it, and a batch that
fails an audit leaves the table as it was.

The table's properties are the journal: ``staged.<writer>`` is the last batch that is
written as a whole, ``published.<writer>`` the last whose partitions all point at it.
A batch that is run again after a stop

* is skipped where it is published,
* is not merged or written again where it is staged (its input may already be
  partly published); its partitions are pointed at it again,
* is written anew, over what a stopped write left, otherwise.

One writer at a time publishes to a table. A writer's batch ids rise.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratebridge.operators.gates import GateError
from ratebridge.operators.topk import first_per_key
from ratebridge.sources.sinks import rebalanced

#: Periods of a batch that a partition filter lists; beyond, the old rows are found by a join.
MOST_LISTED = 1000
#: Partitions added to the catalog by one command.
ADDED_AT_ONCE = 200

#: Looks at a written batch; raises ``GateError`` where it must not be published.
Audit = Callable[[DataFrame], object]


@dataclass(frozen=True)
class PublishedTable:
    """``name`` (qualified as the catalog needs), ``columns`` in DDL with those of ``by``, which name the period."""

    spark: SparkSession
    name: str
    path: str
    columns: str
    by: tuple[str, ...]

    def create(self) -> PublishedTable:
        by = ", ".join(f"`{c}`" for c in self.by)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({self.columns}) USING parquet PARTITIONED BY ({by}) LOCATION '{self.path}/none'")
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def batch_folder(self, writer: str, batch_id: int) -> str:
        return f"{self.path}/batch={writer}-{batch_id}"

    # --- journal ---------------------------------------------------------------------

    def journal(self, step: str, writer: str) -> int | None:
        """The last batch of the writer that reached ``staged`` or ``published``."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").where(F.col("key") == f"{step}.{writer}").collect()
        return int(rows[0]["value"]) if rows else None

    def _note(self, step: str, writer: str, batch_id: int, **more: object) -> None:
        """Notes a step, and what else the writer must know, by one command."""
        noted = ", ".join(f"'{name}.{writer}' = '{value}'" for name, value in {step: batch_id, **more}.items())
        self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ({noted})")

    def is_published(self, writer: str, batch_id: int) -> bool:
        last = self.journal("published", writer)
        return last is not None and batch_id <= last

    # --- steps -----------------------------------------------------------------------

    def stage(self, rows: Callable[[], DataFrame], batch_id: int, writer: str, more: Callable[[], dict] = dict) -> DataFrame:
        """The batch, written to its folder unless that is done; ``rows`` makes what is to be written,
        ``more`` what is noted with it."""
        folder = self.batch_folder(writer, batch_id)
        if self.journal("staged", writer) != batch_id:
            frame = rows().select(*[F.col(f"`{c}`") for c in self.read().columns])
            rebalanced(frame, self.by).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*self.by).parquet(folder)
            self._note("staged", writer, batch_id, **more())
        types = {f.name: f for f in self.read().schema.fields}
        order = [*[c for c in types if c not in self.by], *self.by]
        return self.spark.read.schema(T.StructType([types[c] for c in order])).parquet(folder)

    def audit(self, staged: DataFrame, audits: Sequence[Audit], writer: str) -> None:
        """Runs the audits over a written batch. One that refuses lets a repaired batch take the id."""
        try:
            for check in audits:
                check(staged)
        except GateError:
            self.spark.sql(f"ALTER TABLE {self.name} UNSET TBLPROPERTIES IF EXISTS ('staged.{writer}')")
            raise

    def publish(self, staged: DataFrame, batch_id: int, writer: str) -> None:
        """Points the periods of a written batch at it, then notes the batch."""
        folder = self.batch_folder(writer, batch_id)
        there = {r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").toLocalIterator()}
        periods = staged.select(*self.by).distinct().toLocalIterator()
        while part := list(islice(periods, ADDED_AT_ONCE)):
            named = [self._period(r) for r in part]
            for at in named:
                if at in there:
                    self.spark.sql(f"ALTER TABLE {self.name} PARTITION ({_spec(at)}) SET LOCATION '{folder}/{at}'")
            new = " ".join(f"PARTITION ({_spec(at)}) LOCATION '{folder}/{at}'" for at in named if at not in there)
            if new:
                self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {new}")
        self._note("published", writer, batch_id)
        self.spark.catalog.refreshTable(self.name)

    def _period(self, row) -> str:
        values = [str(row[c]) for c in self.by]
        if any(row[c] is None or not re.fullmatch(r"[\w.-]+", v) for c, v in zip(self.by, values, strict=True)):
            raise ValueError(f"{values} is not a period: letters, digits, '_', '.' and '-' only, and no null")
        return "/".join(f"{c}={v}" for c, v in zip(self.by, values, strict=True))

    # --- batches ---------------------------------------------------------------------

    def replace(self, batch: DataFrame, batch_id: int, audits: Sequence[Audit] = (), writer: str = "batch") -> bool:
        """The periods in ``batch`` become its rows, others stay. False where the batch was published before."""
        return self.apply(lambda: batch, batch_id, audits, writer)

    def merge(self, batch: DataFrame, batch_id: int, keys: Sequence[str], order: Sequence[Column], audits: Sequence[Audit] = (), writer: str = "stream") -> bool:
        """Of the batch and the rows of the periods it touches, the first of each key under ``order``.

        The batch is reduced before it meets the old rows. False where it was published before.
        """
        reduced = first_per_key(batch, keys, order).persist()  # read for its periods, then for its rows

        def merged() -> DataFrame:
            old = self.touched(reduced)
            return reduced if old is None else first_per_key(old.unionByName(reduced), keys, order)

        try:
            return self.apply(merged, batch_id, audits, writer)
        finally:
            reduced.unpersist()

    def touched(self, batch: DataFrame) -> DataFrame | None:
        """Rows of the table in the periods of a batch, None for an empty table; up to ``MOST_LISTED``
        periods are a partition filter."""
        if not self.spark.sql(f"SHOW PARTITIONS {self.name}").head(1):
            return None
        periods = batch.select(*self.by).distinct()
        some = periods.limit(MOST_LISTED + 1).collect()
        if len(some) > MOST_LISTED:
            return self.read().join(periods, list(self.by), "left_semi")
        listed = F.lit(False)
        if some and len(self.by) == 1:
            listed = F.col(self.by[0]).isin([r[0] for r in some])
        elif some:
            listed = F.struct(*self.by).isin([F.struct(*[F.lit(r[c]).alias(c) for c in self.by]) for r in some])
        return self.read().where(listed)

    def apply(self, rows: Callable[[], DataFrame], batch_id: int, audits: Sequence[Audit] = (), writer: str = "batch", more: Callable[[], dict] = dict) -> bool:
        """Written, audited, published: the periods in ``rows()`` become those rows. False where it was published before."""
        if self.is_published(writer, batch_id):
            return False
        staged = self.stage(rows, batch_id, writer, more)
        self.audit(staged, audits, writer)
        self.publish(staged, batch_id, writer)
        return True


def _spec(at: str) -> str:
    return ", ".join("`{}`='{}'".format(*part.split("=", 1)) for part in at.split("/"))


def batches(table: PublishedTable) -> Iterator[str]:
    """Folders that partitions of the table point at; others under its path are superseded or refused."""
    files = table.read().select(F.regexp_extract(F.col("_metadata.file_path"), r"/(batch=[^/]+)/", 1).alias("folder")).distinct()
    yield from (r["folder"] for r in files.orderBy("folder").toLocalIterator())
