"""The bound on what a Python worker is given at once."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Bytes of rows that a Python worker is given at a time, and Spark's setting for that.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bounds what goes to a Python worker at once by bytes, unless the session has a bound of its own."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
