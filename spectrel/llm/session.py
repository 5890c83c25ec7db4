"""Session settings that the operators of this package need."""

from __future__ import annotations

from pyspark.sql import SparkSession

from catalog.core import ship

# Rows of an Arrow batch. Rows are whole texts or sets, so batches of Spark's default size would hold much memory on both
# sides of a Python worker.
ROWS_OF_A_BATCH = "1000"


def ready(spark: SparkSession) -> None:
    """Make the package importable in Python workers and keep their batches small."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_OF_A_BATCH)
