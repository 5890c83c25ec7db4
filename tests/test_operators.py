"""Operators against plain Python on small input, with hot keys and several partition counts."""

import random

import pytest
from pyspark.sql import functions as F

from spectrel.functions import binning as bn
from spectrel.functions import masses as ms
from spectrel.functions import text as tx
from spectrel.operators import batching as ba
from spectrel.operators import hits as hi
from spectrel.operators import joins as jo
from spectrel.operators import scans as sc
from spectrel.operators.shared import written


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_index_rows_with_copies(spark, partitions, monkeypatch):
    monkeypatch.setattr(ba, "COPIES_PER_TASK", 7)
    values = [5] * 50 + list(range(30)) + [9] * 20
    table = spark.createDataFrame([(v,) for v in values], "v int").repartition(partitions)
    rows = sorted((r.row_index, r.v) for r in ba.index_rows(table, [F.col("v")]).collect())
    assert [v for _, v in rows] == sorted(values)
    assert [i for i, _ in rows] == list(range(len(values)))


def test_index_unique_and_within(spark):
    table = spark.range(0, 1000, numPartitions=7).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    rows = ba.index_rows(table, [F.desc("v")], unique=True).collect()
    assert all(r.row_index == 999 - r.v for r in rows)
    rows = ba.index_within(table, ["k"], [F.col("v")]).collect()
    assert all(r.row_index == r.v // 3 for r in rows) and len(rows) == 1000


@pytest.mark.parametrize("size", [1, 7, 100])
def test_batches_are_exact(spark, size):
    table = spark.range(0, 95, numPartitions=5).select("id", F.col("id").cast("string").alias("t"))
    rows = ba.batch_rows(table, [F.col("id")], size, "t", ",").orderBy("batch_id").collect()
    assert ",".join(r.text for r in rows) == ",".join(map(str, range(95)))
    assert all(r.n_rows == size for r in rows[:-1])


def test_lists_are_flat_and_bounded(spark):
    pairs = [("hot", i % 5) for i in range(1000)] + [("cold", 3), ("cold", 1)]
    random.Random(1).shuffle(pairs)
    lists = ba.group_to_lists(spark.createDataFrame(pairs, "k string, v int"), "k", "v", 64)
    rows = lists.orderBy("k", "part_no").collect()
    assert max(len(r["items"]) for r in rows) <= 64
    for key in ("hot", "cold"):
        joined = [v for r in rows if r.k == key for v in r["items"]]
        assert joined == sorted(v for k, v in pairs if k == key)
        assert [r.part_no for r in rows if r.k == key] == list(range(len([r for r in rows if r.k == key])))


def window_rows(spark, seed=3):
    """A third of the points and ranges lie in one bin."""
    rng = random.Random(seed)
    values = [1000 + rng.randrange(10) for _ in range(150)] + [rng.randrange(5000) for _ in range(300)]
    lows = [998 + rng.randrange(10) for _ in range(60)] + [rng.randrange(5000) for _ in range(120)]
    windows = [(i, v, v + rng.randrange(-2, 40)) for i, v in enumerate(lows)]
    points = spark.createDataFrame(list(enumerate(values)), "p int, value bigint")
    ranges = spark.createDataFrame(windows, "r int, low bigint, high bigint")
    expected = sorted((p, r) for p, v in enumerate(values) for r, low, high in windows if low <= v <= high)
    return points, ranges, expected


@pytest.mark.parametrize("domain", [None, (0, 5000)])
@pytest.mark.parametrize("limits", [{}, {"ranges_per_cell": 7, "pairs_per_cell": 50}, {"broadcast_ranges": True}])
@pytest.mark.parametrize("partitions", [1, 16])
def test_range_join(spark, domain, limits, partitions):
    points, ranges, expected = window_rows(spark)
    joined = jo.range_join(
        points.repartition(partitions), ranges.repartition(partitions), "value", "low", "high", 25, domain, **limits
    )
    assert sorted((r.p, r.r) for r in joined.collect()) == expected


def test_busy_bin_is_cut(spark):
    points = spark.range(1000).select(F.lit(1).alias("_bin"))
    ranges = spark.range(5000).select(F.lit(1).alias("_bin"))
    grid = jo.bin_grid(points, ranges, 2000, 4_000).first()
    assert (grid._point_parts, grid._range_parts) == (500, 3)


def test_size_check(spark):
    table = spark.range(1000).select("id", F.repeat(F.lit("x"), 100).alias("t"), F.array(F.lit(1), F.lit(2)).alias("a"))
    assert jo.small_enough(table, 1000 * 200) and not jo.small_enough(table, 1000 * 100)


@pytest.mark.parametrize("max_bytes", [1 << 20, 10])
def test_shared_table_join(spark, max_bytes):
    points, ranges, expected = window_rows(spark)
    points = written(points, "points")
    joined = jo.shared_table_join(points, ranges, "value", "low", "high", 25, max_bytes=max_bytes)
    assert sorted((r.p, r.r) for r in joined.collect()) == expected
    assert ("_cell_p" in joined._jdf.queryExecution().toString()) == (max_bytes == 10)


def test_window_join_plans_no_nested_loop(spark):
    points, ranges, _ = window_rows(spark)
    plan = jo.range_join(points, ranges, "value", "low", "high", 25, (0, 5000))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_top_hits_cut_before_shuffle(spark):
    hits = spark.createDataFrame([("s", f"p{i}", float(i % 4)) for i in range(40)], "s string, p string, x double")
    best = hi.top_hits(hits, ["s"], "x", ["p"], 5)
    assert [(r.p, r.hit_rank) for r in best.orderBy("hit_rank").collect()] == [(f"p{i}", k) for k, i in enumerate([11, 15, 19, 23, 27], 1)]
    assert best._jdf.queryExecution().toString().count("WindowGroupLimit") >= 2


def test_renumber(spark):
    rows = [("f", 1, i) for i in range(4)] + [("f", 10001, 4), ("g", 1, 0)]
    scans = spark.createDataFrame(rows, "source_file string, scan_num int, place int")
    out = {(r.source_file, r.place): r.new_num for r in sc.renumber_scans(scans, ["place"]).collect()}
    assert out == {("f", 0): 1, ("f", 1): 10002, ("f", 2): 10003, ("f", 3): 10004, ("f", 4): 10001, ("g", 0): 1}


def test_bins_at_the_edges(spark):
    def bins(value, **kwargs):
        return one(spark, bn.linear_bin(F.lit(value), 10.0, 2.0, **kwargs))

    assert [bins(v) for v in (-1.0, 0.0, 1.99, 2.0, 10.0, 11.0)] == [0, 0, 0, 1, 4, 4]
    assert bins(11.0, overflow=False) == -1 and bins(-0.1, overflow=False) == -1
    assert bins(10.0, min_bin=3) == 7
    assert one(spark, bn.bin_midpoint(F.lit(1), 10.0, 2.0)) == 3.0
    with pytest.raises(Exception, match="illegal bin"):
        one(spark, bn.bin_midpoint(F.lit(5), 10.0, 2.0))
    with pytest.raises(ValueError):
        bn.bin_count(1.0, 1.0, 1.0)
    assert one(spark, bn.bin_label(F.lit(3.5), 10.0, 2.0)) == "2.000-4.000"


def test_text_functions(spark):
    assert one(spark, tx.escape_xml(F.lit("a<b&'\"éœ\U0001F600\n"))) == "a&lt;b&amp;&apos;&quot;é&#x153;&#x1f600;&#xa;"
    assert one(spark, tx.extract_attr(F.lit('<x NAME="Ab" y="1"/>'), "name")) == "Ab"  # the value keeps its case
    assert one(spark, tx.extract_attr(F.lit("<x/>"), "name")) is None
    with pytest.raises(Exception, match="not found"):
        one(spark, tx.extract_attr(F.lit("<x/>"), "name", required=True))
    with pytest.raises(Exception, match="not closed"):
        one(spark, tx.require_closed(F.lit("<a><a></a>"), "a"))
    assert one(spark, tx.substitute_attr(F.lit('<h hit_rank="9" x="hit_rank"/>'), "hit_rank", "$1")) == '<h hit_rank="$1" x="hit_rank"/>'
    assert one(spark, tx.condition_label(F.lit("a|b;c:d\té'"))) == "a_b c d "
    assert one(spark, tx.decoy_label(F.lit("REV1_P1"))) == "DECOY_P1"
    assert one(spark, tx.decoy_label(F.lit("P1"))) is None
    with pytest.raises(Exception, match="only a decoy prefix"):
        one(spark, tx.decoy_label(F.lit("RND_")))
    assert one(spark, tx.alphabetical_id(F.lit("123"))) == "00000123"
    assert one(spark, tx.wrap_sequence(F.lit("A" * 161))) == "A" * 80 + "\n" + "A" * 80 + "\nA"
    assert one(spark, tx.wrap_sequence(F.lit("A" * 160))) == "A" * 80 + "\n" + "A" * 80
    assert one(spark, tx.pep_mass(F.lit("PEPMASS=459.17000000000002 8795.7"))) == 459.17
    pairs = one(spark, tx.comment_map(F.lit('Comment: A=1 B="x y=\\"z" A=2')))
    assert pairs == {"A": "2", "B": '"x y=\\"z"'}


def test_tolerances(spark):
    assert one(spark, ms.near_integer(F.lit(3.000001))) and not one(spark, ms.near_integer(F.lit(3.1)))
    assert one(spark, ms.close_to(F.lit(300.0), F.lit(300.9))) and not one(spark, ms.close_to(F.lit(300.0), F.lit(301.1)))


def test_prefix_lookup(spark):
    words = spark.createDataFrame([("PEPTIDE",), ("PEP",), ("TIDE",)], "w string")
    queries = spark.createDataFrame([("PEP",), ("TI",), ("X",)], "q string")
    assert sorted(map(tuple, jo.prefix_lookup(words, queries, "w", "q").collect())) == [("PEP", "PEP"), ("PEPTIDE", "PEP"), ("TIDE", "TI")]


def test_sample_is_repeatable(spark):
    a = ba.sample_fraction(spark.range(10000, numPartitions=3), "id", 0.2)
    b = ba.sample_fraction(spark.range(10000, numPartitions=11), "id", 0.2)
    assert a.exceptAll(b).isEmpty() and 1800 < a.count() < 2200 and a.count() == b.count()


def test_partition_counts(spark):
    table = spark.range(100, numPartitions=10)
    assert ba.partition_count(ba.guarantee_partitions(table, 11)) == 10  # within the tolerance
    assert ba.partition_count(ba.guarantee_partitions(table, 20)) == 20
    assert ba.partition_count(ba.at_most_partitions(table, 3)) == 3
    assert ba.partition_count(ba.at_least_partitions(table, 3)) == 10


def test_partition_counts_run_nothing(spark):
    context = spark.sparkContext
    context.setJobGroup("counting", "")
    table = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    assert ba.partition_count(table) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert not context.statusTracker().getJobIdsForGroup("counting")
    context.setJobGroup("", "")


def test_renumber_rows_that_share_a_place(spark):
    rows = [("f", 5, 5), ("f", 5, 5), ("f", 5, 5), ("f", 5, 9), ("f", 6, 5), ("f", None, 1), ("g", 20_000, 1), ("g", 20_000, 1)]
    scans = spark.createDataFrame(rows, "source_file string, scan_num int, place int")
    got = [(r.source_file, r.scan_num, r.new_num) for r in sc.renumber_scans(scans, ["place"]).collect()]
    assert sorted(got, key=str) == sorted([("f", 5, 5), ("f", 5, 10_000), ("f", 5, 10_001), ("f", 5, 10_002), ("f", 6, 6), ("f", None, None), ("g", 20_000, 20_000), ("g", 20_000, 20_001)], key=str)


def test_rows_are_renumbered_where_they_lie(spark):
    """Many files, a busy number: the rows move by parts of the sorted table, never by their number."""
    draw = random.Random(4)
    rows = [(f"f{draw.choice('aaaaaabcd')}", draw.choice([7, 7, 7, *range(40), 12_000, None]), i, draw.choice("xy")) for i in range(3000)]
    rows += rows[:200]
    scans = spark.createDataFrame(rows, "source_file string, scan_num int, place int, text string").repartition(7)
    out = sc.renumber_scans(scans, ["place"])
    want, used = [], {}
    for file in sorted({r[0] for r in rows}):
        own = sorted((r for r in rows if r[0] == file and r[1] is not None), key=lambda r: (r[2], r[3]))
        free = max(9_999, *(r[1] for r in own))
        for r in own:
            if used.setdefault((file, r[1]), r) is r and (file, r[1], "kept") not in used:
                used[file, r[1], "kept"] = True
                want.append((*r, r[1]))
            else:
                free += 1
                want.append((*r, free))
    want += [(*r, None) for r in rows if r[1] is None]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    plan = out._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert moved and all("hashpartitioning(_part" in line for line in moved)
