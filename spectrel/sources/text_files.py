"""Text scans: delimited, whole files, keyed lines, small tables in text form."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F


Paths = str | list[str]


def text_reader(spark: SparkSession, separator: str, glob: str | None = None) -> DataFrameReader:
    reader = spark.read.option("lineSep", separator)
    return reader.option("pathGlobFilter", glob) if glob else reader


def _numbered(opening: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = None, 0  # the split at hand, and its records so far
        for batch in batches:
            n = batch.num_rows
            file, block = batch.column("source_file"), batch.column("block")
            if not n:
                continue
            fresh = np.ones(n, bool)
            fresh[1:] = pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False) | (np.diff(block.to_numpy()) != 0)
            fresh[0] = (file[0].as_py(), block[0].as_py()) != last
            last = (file[n - 1].as_py(), block[n - 1].as_py())
            starts = np.flatnonzero(fresh)
            place = np.arange(n) - np.repeat(starts if fresh[0] else [0, *starts], np.diff([*(starts if fresh[0] else [0, *starts]), n]))
            if not fresh[0]:
                place[: starts[0] if len(starts) else n] += count
            count = int(place[-1]) + 1
            keep = (place > 0) | (block.to_numpy() > 0)
            if opening:
                keep |= pc.starts_with(batch.column("value"), opening).to_numpy(zero_copy_only=False)
            out = pa.RecordBatch.from_arrays([batch.column("value"), file, block, pa.array(place)], names=["value", "source_file", "block", "place"])
            yield out.filter(pa.array(keep))

    return run


def read_records(spark: SparkSession, path: Paths, separator: str, glob: str | None = None, opening: str = "") -> DataFrame:
    """Records that a separator opens: what stands before the first one in a file is left out.

    A file may begin with a record at once; it then begins with ``opening``, the part of the separator after its line end.
    ``place`` counts the records of a split from 0.
    """
    kinds = "value string, source_file string, block bigint, place bigint"
    return read_delimited(spark, path, separator, glob).select("value", "source_file", "block").mapInArrow(_numbered(opening), kinds)


def read_delimited(spark: SparkSession, path: Paths, separator: str, glob: str | None = None) -> DataFrame:
    """Records cut at a separator, which may span lines; files are split across tasks.

    ``glob`` picks files of a folder by name.

    ``source_file``, ``block`` and ``place`` give the order of the records in their file.
    """
    return (
        text_reader(spark, separator, glob)
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
        )
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, "\n").withColumn("value", F.regexp_replace("value", "\r$", ""))


def read_whole_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One row per file. For files that fit a task; larger ones are read as records."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    return reader.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"))


def read_size_table(spark: SparkSession, path: str) -> DataFrame:
    """``mass<TAB>count`` lines; lines of another shape are skipped."""
    items = F.split("value", "\t")
    return (
        spark.read.text(path)
        .select(items.alias("i"))
        .where(F.size("i") == 2)
        .select(F.col("i")[0].try_cast("int").alias("mass_bin"), F.col("i")[1].try_cast("bigint").alias("n"))
        .where("mass_bin is not null and n is not null")
    )


def write_size_table(sizes: DataFrame, path: str) -> None:
    lines = sizes.orderBy("mass_bin").select(F.concat_ws("\t", "mass_bin", "n").alias("value"))
    lines.write.mode("overwrite").text(path)


def read_bin_counters(spark: SparkSession, path: str) -> DataFrame:
    """``Binning:MZ<mz>=<count>`` lines; other counters are ignored."""
    pattern = r"^Binning:MZ\s*(\d+)\s*=\s*(\d+)\s*$"
    return (
        spark.read.text(path)
        .where(F.col("value").rlike(pattern))
        .select(
            F.regexp_extract("value", pattern, 1).cast("int").alias("mz"),
            F.regexp_extract("value", pattern, 2).cast("bigint").alias("n"),
        )
    )


def write_counters(counters: DataFrame, path: str) -> None:
    """Sorted ``name=value`` lines."""
    lines = counters.orderBy("name").select(F.concat_ws("=", "name", "value").alias("value"))
    lines.write.mode("overwrite").text(path)


def framed(body: DataFrame, order: list[str], text: str, header: str, footer: str) -> DataFrame:
    """Header, body rows in order, footer, as one sorted table of lines."""
    spark = body.sparkSession
    keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(order)]
    rows = body.select(F.lit(1).alias("_frame"), *keys, F.col(text).alias("value"))
    ends = spark.createDataFrame([(0, header), (2, footer)], "_frame int, value string")
    return (
        rows.unionByName(ends, allowMissingColumns=True)
        .orderBy("_frame", *[f"_k{i}" for i in range(len(order))])
        .select("value")
    )


def write_framed_text(body: DataFrame, path: str, order: list[str], text: str, header: str, footer: str) -> None:
    """A folder of part files whose concatenation in name order is the framed text."""
    framed(body, order, text, header, footer).write.mode("overwrite").text(path)


def write_store(df: DataFrame, path: str, by: str = "mass_bin", then: list[str] | None = None) -> None:
    """Binary rows in one folder per mass bin; a reader of some bins opens only those.

    Rows are dealt by ranges of the bin and of ``then`` (all other columns if not
    given), so a task writes few folders and a busy bin is written by many tasks.
    """
    order = [by, *(then or [c for c in df.columns if c != by])]
    df.repartitionByRange(*order).write.mode("overwrite").partitionBy(by).parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
