"""Period-partitioned sinks: one folder per day or month, replaced as a whole on re-run."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = ("year", "month", "day")
MONTH = ("year", "month")


def period_columns(date_text: Column, by: Sequence[str] = DAY) -> dict[str, Column]:
    """Partition columns from ISO date text (``yyyy-MM-dd...`` or ``yyyy-MM``)."""
    parts = {"year": F.substring(date_text, 1, 4), "month": F.substring(date_text, 6, 2),
             "day": F.substring(date_text, 9, 2)}
    return {k: parts[k] for k in by}


def rebalanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows clustered by columns into partitions of even size; AQE splits large keys and joins small ones."""
    keys = ", ".join(f"`{k}`" for k in by)
    return df.sparkSession.sql(f"SELECT /*+ REBALANCE({keys}) */ * FROM {{rows}}", rows=df)


def write_periods(
    df: DataFrame,
    path: str,
    date_text: Column,
    by: Sequence[str] = DAY,
    fmt: str = "json",
    salt: int = 1,
    max_records_per_file: int = 1_000_000,
) -> None:
    """Write ``df`` under ``path/year=/month=[/day=]``, replacing exactly the
    periods present in ``df`` (dynamic partition overwrite) and keeping all
    other periods.

    Rows are rebalanced by period before the write: small periods share tasks,
    and one larger than the advisory partition size is split over several.
    ``salt`` > 1 instead spreads every period over that many tasks with a
    deterministic hash of the row; files are capped at ``max_records_per_file`` rows.
    """
    cols = period_columns(date_text, by)
    staged = df.withColumns(cols)
    keys = [*by, F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt))]
    (
        (staged.repartition(*keys) if salt > 1 else rebalanced(staged, by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*by)
        .format(fmt)
        .save(path)
    )


def nest_periods(df: DataFrame, path: str, date_text: Column, by: Sequence[str] = DAY, fmt: str = "json") -> None:
    """Write ``df`` as the collectors land it: ``path/YYYY/MM[/DD]``, each period in ``df`` replaced as a whole.

    The periods are written beside the landing folder first; then each folder takes
    its place, a metadata operation a period. A write that stops before that changes
    nothing; one that stops in between has replaced some periods and not the others,
    and running it again ends the work.
    """
    spark = df.sparkSession
    beside = f"{path.rstrip('/')}__{uuid.uuid4().hex}"
    write_periods(df, beside, date_text, by, fmt)
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for at in files.globStatus(hadoop.Path(beside + "/" + "/".join(f"{c}=*" for c in by))):
        names = str(at.getPath()).rsplit("/", len(by))[1:]
        target = hadoop.Path("/".join([path, *(n.split("=", 1)[1] for n in names)]))
        files.mkdirs(target.getParent())
        files.delete(target, True)
        if not files.rename(at.getPath(), target):
            raise OSError(f"{target} could not be replaced")
    files.delete(hadoop.Path(beside), True)
