"""FASTA source and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fasta_record
from .text_files import read_records


def read_proteins(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One row per FASTA record; large files are split, a record is read exactly once.

    A ``>`` inside a header or a record without sequence does not end anything. Text
    before the first record of a file is left out.
    Sequences are upper-cased (lower case marks masked regions in files and
    modifications here); signs other than letters are left out and counted in
    ``left_out``.
    """
    return (
        read_records(spark, path, "\n>", glob, opening=">")
        .select(F.regexp_replace("value", "^>", "").alias("record"), "source_file")
        .select(
            F.regexp_extract("record", r"^([^\r\n]*)", 1).alias("header"),
            F.upper(F.regexp_replace(F.regexp_replace("record", r"^[^\r\n]*", ""), r"\s", "")).alias("raw"),
            "source_file",
        )
        .where(F.trim("header") != "")
        .select(
            F.regexp_extract("header", r"^(\S+)", 1).alias("accession"),
            F.regexp_extract("header", r"^\S+\s+(.*)$", 1).alias("description"),
            F.regexp_replace("raw", "[^A-Z]", "").alias("sequence"),
            "source_file",
            (F.length("raw") - F.length(F.regexp_replace("raw", "[^A-Z]", ""))).alias("left_out"),
        )
    )


def write_proteins(proteins: DataFrame, path: str, per_file: int | None = None) -> None:
    """FASTA part files; ``per_file`` limits the records of one file."""
    writer = proteins.select(fasta_record("accession", "description", "sequence").alias("value")).write.mode("overwrite")
    if per_file:
        writer = writer.option("maxRecordsPerFile", per_file)
    writer.text(path)
