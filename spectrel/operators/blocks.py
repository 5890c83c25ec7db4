"""Running values along a file, computed block by block.

A file may be far larger than one task should hold, so nothing here opens a
window over a whole file. Rows carry ``(file, block, place)``: the split of the
file they come from and their order inside it. One value per block is summed
(or carried) across blocks, and windows over rows stay inside a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 10_000


def by_row_number(df: DataFrame, file: str, position: str, rows: int = ROWS_PER_BLOCK) -> DataFrame:
    """Blocks of a table that knows each row's position in its file."""
    return df.withColumn("block", F.floor(F.col(position) / rows)).withColumn("place", F.col(position))


def running_sum(df: DataFrame, file: str, value: Column, name: str) -> DataFrame:
    """Sum of ``value`` over all earlier rows of the file."""
    df = df.withColumn("_value", value.cast("bigint"))
    totals = df.groupBy(file, "block").agg(F.sum("_value").alias("_total"))
    earlier_blocks = Window.partitionBy(file).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(file, "block", F.coalesce(F.sum("_total").over(earlier_blocks), F.lit(0)).alias("_start"))
    earlier_rows = Window.partitionBy(file, "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(starts, [file, "block"])
        .withColumn(name, F.col("_start") + F.coalesce(F.sum("_value").over(earlier_rows), F.lit(0)))
        .drop("_value", "_start")
    )


def previous_value(df: DataFrame, file: str, value: Column, name: str) -> DataFrame:
    """Last non-null ``value`` before each row of the file."""
    df = df.withColumn("_value", value)
    ends = df.groupBy(file, "block").agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("place"))).alias("_end")
    )
    earlier_blocks = Window.partitionBy(file).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(file, "block", F.last("_end", ignorenulls=True).over(earlier_blocks).alias("_start"))
    earlier_rows = Window.partitionBy(file, "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(starts, [file, "block"])
        .withColumn(name, F.coalesce(F.last("_value", ignorenulls=True).over(earlier_rows), F.col("_start")))
        .drop("_value", "_start")
    )
