"""Counts and run statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import DEFAULT_COUNTER_GROUPS, PROTEINS_PER_BATCH, SPECTRA_PER_BATCH


def top_counts(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """Most frequent keys with their counts."""
    return df.groupBy(key).agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), F.col(key)).limit(n)


def key_skew(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows that each of ``n`` partitions would get from an integer key."""
    return df.groupBy(F.pmod(F.col(key), F.lit(n)).alias("bucket")).agg(
        F.count("*").alias("n_rows"), F.countDistinct(key).alias("n_keys")
    )


def row_count(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).select(F.lit(label).alias("label"), "n_rows")


def bin_size_stats(sizes: DataFrame, count: str = "n") -> DataFrame:
    return sizes.agg(
        F.coalesce(F.sum(count), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.max(count), F.lit(0)).alias("largest"),
    )


def run_statistics(
    proteins: DataFrame,
    spectra: DataFrame,
    proteins_per_batch: int = PROTEINS_PER_BATCH,
    spectra_per_batch: int = SPECTRA_PER_BATCH,
) -> DataFrame:
    """Rows, batches, scoring calls and comparisons of a run over all batch pairs."""
    protein_rows = proteins.select(F.lit(1).alias("p"), F.lit(0).alias("s"))
    spectrum_rows = spectra.select(F.lit(0).alias("p"), F.lit(1).alias("s"))
    return (
        protein_rows.unionAll(spectrum_rows)
        .agg(F.sum("p").alias("n_proteins"), F.sum("s").alias("n_spectra"))
        .withColumn("protein_batches", 1 + F.floor(F.col("n_proteins") / proteins_per_batch))
        .withColumn("spectra_batches", 1 + F.floor(F.col("n_spectra") / spectra_per_batch))
        .withColumn("calls", F.col("protein_batches") * F.col("spectra_batches"))
        .withColumn("comparisons_millions", F.floor(F.col("n_proteins") * F.col("n_spectra") / 1_000_000))
    )


def marker_counts(spark: SparkSession, path: str, markers: dict[str, str]) -> DataFrame:
    """Lines per file that hold each marker; a marker ``^x`` must begin the line."""
    lines = spark.read.text(path)

    def test(mark: str):
        return F.col("value").startswith(mark[1:]) if mark.startswith("^") else F.col("value").contains(mark)

    counts = [F.count_if(test(mark)).alias(name) for name, mark in markers.items()]
    return lines.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count("*").alias("n_lines"), *counts)


def tag_histogram(df: DataFrame, xml: str) -> DataFrame:
    """Occurrences of every opening element name."""
    names = F.regexp_extract_all(F.col(xml), F.lit(r"<([A-Za-z][A-Za-z0-9_:.-]*)"), F.lit(1))
    return df.select(F.explode(names).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


def log_sequences(lines: DataFrame, value: str = "value") -> DataFrame:
    """Distinct sequences of ``add Sequence`` and ``set Sequence`` lines, longer than four letters."""
    found = F.regexp_extract(F.trim(F.col(value)), "^(?:add|set) Sequence (.*)$", 1)
    return lines.select(found.alias("sequence")).where(F.length("sequence") > 4).distinct().orderBy("sequence")


def counter_rollup(counters: DataFrame, group: str, name: str, value: str) -> DataFrame:
    """Sum of counters under ``group:name``; default groups leave their name out."""
    key = F.when(F.col(group).isin(*DEFAULT_COUNTER_GROUPS), F.col(name)).otherwise(
        F.concat_ws(":", F.col(group), F.col(name))
    )
    return counters.groupBy(key.alias("counter")).agg(F.sum(value).alias("total"))
