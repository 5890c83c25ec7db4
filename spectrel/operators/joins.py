"""Joins: mass windows, key sets, prefixes and batch pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import written

# A cell of the grid that a busy bin is cut into: at most this many ranges, and this many pairs.
RANGES_PER_CELL = 2_000
PAIRS_PER_CELL = 4_000_000
# Most bins whose grid table is broadcast: three numbers per bin, so a few megabytes.
BROADCAST_BINS = 100_000


def bin_grid(points: DataFrame, ranges: DataFrame, ranges_per_cell: int, pairs_per_cell: int) -> DataFrame:
    """Per bin, the number of parts that its points and its ranges are cut into."""
    n_points = points.groupBy("_bin").agg(F.count("*").alias("_p"))
    n_ranges = ranges.groupBy("_bin").agg(F.count("*").alias("_r"))
    in_cell = F.least(F.col("_r"), F.lit(ranges_per_cell)).cast("double")
    return n_points.join(n_ranges, "_bin").select(
        "_bin",
        F.ceil(F.col("_p") * in_cell / F.lit(float(pairs_per_cell))).cast("int").alias("_point_parts"),
        F.ceil(F.col("_r") / F.lit(float(ranges_per_cell))).cast("int").alias("_range_parts"),
    )


def check_width(width: int) -> None:
    if width < 1:
        raise ValueError("bins are at least one unit wide")


def range_join(
    points: DataFrame,
    ranges: DataFrame,
    value: str,
    low: str,
    high: str,
    width: int,
    domain: tuple[int, int] | None = None,
    points_by: list[str] | None = None,
    ranges_by: list[str] | None = None,
    broadcast_ranges: bool = False,
    ranges_per_cell: int = RANGES_PER_CELL,
    pairs_per_cell: int = PAIRS_PER_CELL,
    prepare_points: Callable[[DataFrame], DataFrame] | None = None,
    prepare_ranges: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows of ``points`` and ``ranges`` with ``low <= value <= high``.

    Points fall in one bin of ``width``; ranges are repeated for each bin they
    cover, so the join is an equi-join followed by the exact test.

    A bin that holds many rows is cut into a grid: its points in some parts, its
    ranges in others, by a hash of ``points_by`` and ``ranges_by`` (all columns
    if not given). Every pair meets in exactly one cell, and no task gets a whole
    busy bin. ``domain`` limits the values, which bounds the number of bins and so
    the size of the table of grids. With ``broadcast_ranges`` the ranges go to
    every task and no point is moved; only for ranges that ``small_enough`` passed.

    ``prepare_points`` and ``prepare_ranges`` add columns to the sides of the join;
    counting the bins does not pay for them.
    """
    check_width(width)
    low_bin = F.floor(F.col(low) / F.lit(width)).cast("bigint")
    high_bin = F.floor(F.col(high) / F.lit(width)).cast("bigint")
    points = points.where(F.col(value).isNotNull())
    ranges = ranges.where(F.col(low) <= F.col(high))
    point_columns, range_columns = points_by or points.columns, ranges_by or ranges.columns
    bounded = False
    if domain is not None:
        first, last = domain[0] // width, domain[1] // width
        points = points.where(F.col(value).between(domain[0], domain[1]))
        low_bin, high_bin = F.greatest(low_bin, F.lit(first)), F.least(high_bin, F.lit(last))
        ranges = ranges.where((F.col(high) >= domain[0]) & (F.col(low) <= domain[1]))
        bounded = last - first < BROADCAST_BINS
    point_bin = F.floor(F.col(value) / F.lit(width)).cast("bigint")
    range_bin = F.explode(F.sequence(low_bin, high_bin))
    inside = F.col(value).between(F.col(low), F.col(high))
    full_points = (prepare_points(points) if prepare_points else points).withColumn("_bin", point_bin)
    full_ranges = (prepare_ranges(ranges) if prepare_ranges else ranges).withColumn("_bin", range_bin)
    if broadcast_ranges:
        return full_points.join(F.broadcast(full_ranges), "_bin").where(inside).drop("_bin")

    # three numbers per bin, kept once for both sides
    grid = bin_grid(points.select(point_bin.alias("_bin")), ranges.select(range_bin.alias("_bin")), ranges_per_cell, pairs_per_cell)
    grid = written(grid, "grid")
    if bounded or grid.count() < BROADCAST_BINS:
        grid = F.broadcast(grid)
    points, ranges = full_points.join(grid, "_bin"), full_ranges.join(grid, "_bin")

    def part(columns: list[str], parts: str) -> Column:
        return F.pmod(F.xxhash64(*columns), F.col(parts)).cast("int")

    def all_parts(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

    points = points.withColumn("_cell_p", part(point_columns, "_point_parts")).withColumn("_cell_r", all_parts("_range_parts"))
    ranges = ranges.withColumn("_cell_r", part(range_columns, "_range_parts")).withColumn("_cell_p", all_parts("_point_parts"))
    points, ranges = (side.drop("_point_parts", "_range_parts") for side in (points, ranges))
    keys = ["_bin", "_cell_p", "_cell_r"]
    return points.join(ranges.hint("merge"), keys).where(inside).drop(*keys)


def _bytes(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        size = F.octet_length(column)
    elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.NumericType):
        size = F.size(column) * F.lit(8)
    elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        size = F.octet_length(F.to_json(F.struct(column))) * F.lit(2)
    else:
        size = F.lit(8)
    return F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("bigint") + F.lit(8)


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size of a table: for a plain file scan, the size of its files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def small_enough(df: DataFrame, max_bytes: int) -> bool:
    """Whether the rows fit in ``max_bytes``.

    A table whose files alone are larger is not read. A smaller one is measured:
    text lengths, array sizes and eight bytes for every other value.
    """
    if planned_bytes(df) > max_bytes:
        return False
    row = sum((_bytes(f) for f in df.schema.fields), F.lit(16).cast("bigint"))
    return (df.agg(F.sum(row).alias("b")).first()["b"] or 0) <= max_bytes


def shared_table_join(
    points: DataFrame,
    ranges: DataFrame,
    value: str,
    low: str,
    high: str,
    width: int,
    max_bytes: int = 64 << 20,
    **kwargs,
) -> DataFrame:
    """Window join where every task sees the whole point table, if its measured size allows it.

    Above the limit the shuffle join gives the same rows.
    """
    check_width(width)
    if not small_enough(points, max_bytes):
        return range_join(points, ranges, value, low, high, width, **kwargs)
    points = points.withColumn("_bin", F.floor(F.col(value) / F.lit(width)).cast("bigint"))
    covered = F.sequence(
        F.floor(F.col(low) / F.lit(width)).cast("bigint"), F.floor(F.col(high) / F.lit(width)).cast("bigint")
    )
    ranges = ranges.where(F.col(low) <= F.col(high)).withColumn("_bin", F.explode(covered))
    joined = ranges.join(F.broadcast(points), "_bin")
    return joined.where(F.col(value).between(F.col(low), F.col(high))).drop("_bin")


def key_difference(mine: DataFrame, theirs: DataFrame, key: str) -> DataFrame:
    """Rows of ``theirs`` whose key is not in ``mine``."""
    return theirs.join(mine.select(key).distinct(), key, "left_anti")


def key_common(a: DataFrame, b: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both tables restricted to the keys they share."""
    return a.join(b.select(key).distinct(), key, "left_semi"), b.join(a.select(key).distinct(), key, "left_semi")


def prefix_lookup(words: DataFrame, queries: DataFrame, word: str, prefix: str) -> DataFrame:
    """Words that begin with one of the prefixes.

    Each word is cut at the prefix lengths in use, which makes the test an
    equi-join. Only that list of lengths, no longer than the longest prefix, is
    fetched.
    """
    lengths = queries.agg(F.sort_array(F.collect_set(F.length(prefix))).alias("n")).first()["n"]
    used = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(word))
    cut = words.withColumn("_len", F.explode(used))
    cut = cut.withColumn("_start", F.substring(F.col(word), F.lit(1), F.col("_len"))).drop("_len")
    return cut.join(queries.withColumn("_start", F.col(prefix)), "_start").drop("_start")


def pair_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows on both sides of every key and their product, largest first; no pair is formed."""
    left = a.groupBy(key).agg(F.count("*").alias("n_left"))
    right = b.groupBy(key).agg(F.count("*").alias("n_right"))
    return (
        left.join(right, key)
        .withColumn("n_pairs", F.col("n_left") * F.col("n_right"))
        .orderBy(F.desc("n_pairs"), F.col(key))
    )


def unequal_rows(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose value differs between two tables, or that only one has."""
    left = a.select(key, F.col(value).alias("left_value"), F.lit(True).alias("_l"))
    right = b.select(key, F.col(value).alias("right_value"), F.lit(True).alias("_r"))
    both = left.join(right, key, "full_outer")
    same = F.col("_l").isNotNull() & F.col("_r").isNotNull() & F.col("left_value").eqNullSafe(F.col("right_value"))
    return both.where(~same).drop("_l", "_r")


def tables_equal(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """One row: number of unequal keys, and whether the tables are the same map."""
    return unequal_rows(a, b, key, value).agg(F.count("*").alias("n_unequal")).withColumn(
        "is_equal", F.col("n_unequal") == 0
    )


def pair_batches(left: DataFrame, right: DataFrame, width: int) -> DataFrame:
    """Pairs of batches whose mass intervals meet; batches that cannot match are never paired.

    Both sides have ``low`` and ``high``, and come in mass order, so a batch spans
    few bins of ``width`` and meets few others. A pair that shares several bins is
    formed in the first of them.
    """
    check_width(width)

    def binned(side: DataFrame, name: str) -> DataFrame:
        first, last = (F.floor(F.col(c) / F.lit(width)).cast("bigint") for c in ("low", "high"))
        side = side.withColumn(f"_first_{name}", first).withColumn("_bin", F.explode(F.sequence(first, last)))
        return side.withColumnRenamed("low", f"_low_{name}").withColumnRenamed("high", f"_high_{name}")

    pairs = binned(left, "l").join(binned(right, "r"), "_bin")
    pairs = pairs.where("_low_l <= _high_r AND _low_r <= _high_l AND _bin = greatest(_first_l, _first_r)")
    return pairs.drop("_bin", *[f"_{c}_{s}" for c in ("first", "low", "high") for s in "lr"])
