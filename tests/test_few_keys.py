"""A table of few large files or keys is never gathered by file or key, whatever the session broadcasts by itself."""

import pytest
from pyspark.sql import functions as F

from spectrel.operators.batching import index_within
from spectrel.operators.scans import repair_scan_tags


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def joins(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]


def test_repair_is_not_dealt_by_file(spark, no_broadcast):
    rows = [("f", 0, i, v) for i, v in enumerate(['<mzXML xsi:schemaLocation="u" v="1">', "<scan 1>", "<scan 2>", "</scan>", "</scan>"])]
    out = repair_scan_tags(spark.createDataFrame(rows, "source_file string, block bigint, place bigint, value string"))
    assert not [j for j in joins(out) if "SortMergeJoin [source_file" in j and "block" not in j.split("]")[0]]
    assert [r.value for r in out.orderBy("place", "sub_place").collect()] == ['<mzXML  v="1">', "<scan 1>", "</scan>", "<scan 2>", "</scan>"]


def test_numbers_within_few_keys(spark, no_broadcast):
    rows = spark.createDataFrame([("a" if i % 3 else "b", i) for i in range(30)], "k string, v int")
    out = index_within(rows, ["k"], [F.col("v")], "i")
    assert not [j for j in joins(out) if "SortMergeJoin" in j]
    got = sorted((r.k, r.i, r.v) for r in out.collect())
    assert got == [("a", n, v) for n, v in enumerate(x for x in range(30) if x % 3)] + [("b", n, v) for n, v in enumerate(range(0, 30, 3))]
