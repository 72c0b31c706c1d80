"""Raw JSON Lines relations: declared-schema scans and their external tables.

Two folder layouts are read:

* ``nested`` - ``prefix/YYYY/MM/DD/rates.jsonl`` (or ``YYYY/MM``), as the
  collectors land objects. Spark does not infer partitions from bare folder
  names and without ``recursiveFileLookup`` reads **no** rows, so the scan is
  recursive; ``between`` names the folders of a date range instead, so that
  those outside are neither listed nor opened.
* ``hive`` - ``prefix/year=YYYY/month=MM/day=DD/`` as ``sinks.write_periods``
  writes it: partition columns are discovered and filters on them prune
  folders before any file is opened.

The schema is always declared (no inference pass over the data). Malformed
lines fail the read by default; ``mode="PERMISSIVE"`` keeps them in a
``_corrupt_record`` column for quarantine instead.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ratebridge.schemas import RAW_SCHEMAS
from ratebridge.sources.sinks import DAY, MONTH

CORRUPT_COL = "_corrupt_record"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT_COL, T.StringType())])


def read_raw(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    layout: str = "nested",
    mode: str = "FAILFAST",
    between: tuple[str, str] | None = None,
    by: Sequence[str] = DAY,
) -> DataFrame:
    """Scan landed JSON Lines with a declared schema.

    ``between`` (nested layout) are the first and last period to read, both
    included: dates for folders by day, ``yyyy-MM`` or dates for folders by month.
    """
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"unknown mode {mode}")
    reader = spark.read.option("mode", mode)
    if mode == "PERMISSIVE":
        schema = _with_corrupt(schema)
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    if layout == "nested":
        reader = reader.option("recursiveFileLookup", "true")
    elif layout != "hive":
        raise ValueError(f"unknown layout {layout}")
    if between is None:
        return reader.schema(schema).json(path)
    if layout != "nested":
        raise ValueError("a range of folders is for the nested layout; filter the columns of the other")
    folders = period_folders(*between, by)
    try:
        return reader.schema(schema).json(f"{path}/{{{','.join(folders)}}}") if folders else spark.createDataFrame([], schema)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)  # nothing has landed in that range


def period_folders(first: str, last: str, by: Sequence[str] = DAY) -> list[str]:
    """Folders under a nested landing path that cover the periods from first to last, by pattern: whole
    years, else whole months, else days."""
    monthly = "day" not in by
    start = dt.date.fromisoformat(f"{first}-01" if len(first) == 7 else first)
    end = dt.date.fromisoformat(last) if len(last) > 7 else month_after(dt.date.fromisoformat(f"{last}-01")) - dt.timedelta(days=1)
    if monthly:
        start, end = start.replace(day=1), month_after(end.replace(day=1)) - dt.timedelta(days=1)
    out: list[str] = []
    while start <= end:
        year, month = dt.date(start.year + 1, 1, 1), month_after(start.replace(day=1))
        if start.month == start.day == 1 and year - dt.timedelta(days=1) <= end:
            out.append(f"{start:%Y}/*")
            start = year
        elif start.day == 1 and month - dt.timedelta(days=1) <= end:
            out.append(f"{start:%Y/%m}")
            start = month
        else:
            out.append(f"{start:%Y/%m/%d}")
            start += dt.timedelta(days=1)
    return out


def month_after(first: dt.date) -> dt.date:
    return (first + dt.timedelta(days=31)).replace(day=1)


def read_source(spark: SparkSession, name: str, path: str, layout: str = "nested", mode: str = "FAILFAST", between: tuple[str, str] | None = None) -> DataFrame:
    """One of the three raw relations by name (se_rates_raw, bank_listed_rates_raw, scb_mortgage_rates_raw)."""
    return read_raw(spark, path, RAW_SCHEMAS[name], layout, mode, between, MONTH if name == "scb_mortgage_rates_raw" else DAY)


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a PERMISSIVE scan into (good rows, malformed lines)."""
    from pyspark.sql import functions as F

    bad = df.where(F.col(CORRUPT_COL).isNotNull()).select(CORRUPT_COL)
    good = df.where(F.col(CORRUPT_COL).isNull()).drop(CORRUPT_COL)
    return good, bad


def ddl_columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)


def ensure_raw_tables(spark: SparkSession, database: str, locations: dict[str, str]) -> None:
    """Create the database and the external JSON tables over the landing folders
    if they do not exist yet (re-running is a no-op)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, location in locations.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({ddl_columns(RAW_SCHEMAS[name])}) "
            f"USING json OPTIONS (recursiveFileLookup 'true', mode 'FAILFAST') LOCATION '{location}'"
        )
