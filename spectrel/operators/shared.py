"""Where intermediate tables go, and how a job cuts its lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only for local runs."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    local = tempfile.mkdtemp(prefix="spectrel-")
    spark.sparkContext.setCheckpointDir(local)
    return local


# Paths given out inside each open ``scratch`` block, innermost last.
_OPEN: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables of a job at its end; results must be written inside the block.

    Checkpoints of sorted rows go with the ``spark.cleaner.referenceTracking.cleanCheckpoints`` setting.
    """
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions, kept in the shared folder.

    A lost executor costs a re-read, not a recomputation with other partition edges.
    """
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder.

    Readers open only the columns they use, and the optimizer sees the real size.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)
