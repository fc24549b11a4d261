"""Arrow batches fit for long texts."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Have Spark hand texts to Python ROWS at a time, unless the session asks for fewer.

    Ten thousand documents, the default, are tens of megabytes that the JVM and the worker hold several times over.
    """
    held = int(spark.conf.get(SETTING, "0"))
    if held <= 0 or held > ROWS:
        spark.conf.set(SETTING, str(ROWS))
