"""Plans that must not change: pruning, no needless shuffle, no nested loops."""

from catalog import QUERIES
from catalog.core import document_proteins
from spectrel.plans import digest as dg

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_digest_needs_no_shuffle(spark):
    proteins = spark.createDataFrame([("P", "MKRPAAK")], "accession string, sequence string")
    assert "Exchange" not in plan(dg.digest(proteins))


def test_store_reads_only_asked_bins(spark):
    text = plan(QUERIES["scan_store_read"](spark, SF))
    assert "PartitionFilters: [isnotnull(mass_bin" in text


def test_hits_read_only_their_columns(spark):
    text = plan(QUERIES["top_hits"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_extendedprice:double>" in text
    assert text.count("WindowGroupLimit") == 2


def test_filter_reaches_the_scan(spark):
    proteins = document_proteins(spark, SF)
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in plan(dg.digest(proteins, places=False)).replace(
        "struct<doc_id:bigint,lang:string,text:string>", "struct<doc_id:bigint,text:string,lang:string>"
    )


def test_search_has_no_nested_loop(spark):
    for name in ("search_top_hits", "mass_range_join", "broadcast_search", "run_statistics", "prefix_lookup"):
        text = plan(QUERIES[name](spark, SF))
        assert "NestedLoop" not in text and "Cartesian" not in text, name


def test_hits_of_a_spectrum_are_merged_across_tasks(spark):
    # the shuffle that removes copies is on the whole hit, not on the spectrum
    text = plan(QUERIES["merge_hits"](spark, SF))
    assert "hashpartitioning(spectrum_id" in text and "xcorr" in text.split("hashpartitioning(", 1)[1].split(")")[0]
