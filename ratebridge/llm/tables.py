"""Tables between the steps of an operator, in the session's shared folder, and the size of what goes to Python workers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ratebridge.session import ensure_checkpoint_dir

#: Session setting for the bytes of a batch of rows that goes to a Python worker, and its largest value here.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def written(frame: DataFrame) -> DataFrame:
    """The frame, written to the shared folder (compressed, by column) and read again: its lineage ends there."""
    spark = frame.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/step-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From now on the session sends rows to Python workers in batches of a few MB, whatever the length of texts.

    Both sides hold a batch more than once, in each running task, and what they held then stays theirs. A
    setting of the user stays.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
