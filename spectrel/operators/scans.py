"""Scan tables: duplicate numbers, first N per file, offsets, tag repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .batching import BROADCAST_KEYS_BYTES
from .blocks import previous_value, running_sum
from .joins import small_enough
from .shared import written

FIRST_FREE_SCAN = 10_000


def last_of_each_scan(scans: DataFrame) -> DataFrame:
    """One row per scan number of a file; the last in file order wins."""
    others = [c for c in scans.columns if c not in ("source_file", "scan_num")]
    return (
        scans.groupBy("source_file", "scan_num")
        .agg(F.max_by(F.struct(*others), F.struct("block", "place")).alias("_row"))
        .select("source_file", "scan_num", "_row.*")
    )


def renumber_scans(scans: DataFrame, position: list[str], file: str = "source_file") -> DataFrame:
    """First use of a number keeps it; later uses get free numbers from 10000 on, in file order.

    Rows that share a number and a position too are uses of their own: one of them is the first. A row without a number
    keeps none. The rows are sorted once and kept with their places; the place of the first use of each number, a whole
    number, goes back to the part of the sorted rows that it lies in, so neither a busy file nor a busy number is gathered.
    """
    numbered = scans.where(F.col("scan_num").isNotNull() & F.col(file).isNotNull())
    # rows that share a place in the file go by all their other columns
    ties = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in numbered.columns if c not in (file, "scan_num", *position)]
    ordered = numbered.orderBy(file, *position, *ties, F.xxhash64(*numbered.columns))
    # the id is the partition number in the upper bits and the row's place in the lower 33
    ordered = written(ordered.withColumn("_id", F.monotonically_increasing_id()), "ordered").withColumn("_part", F.shiftright("_id", 33))
    first = ordered.groupBy(file, "scan_num").agg(F.min("_id").alias("_id")).select(file, "_id")
    first = written(first, "first").withColumn("_part", F.shiftright("_id", 33))
    # a row for each file in each part: later uses in the parts before, and the number after which free ones begin
    sizes = ordered.groupBy("_part", file).agg(F.count("*").alias("_n"), F.max("scan_num").alias("_top"))
    kept = first.groupBy("_part", file).agg(F.count("*").alias("_kept"))
    sizes = sizes.join(kept, ["_part", file], "left").withColumn("_n", F.col("_n") - F.coalesce("_kept", F.lit(0)))
    whole = Window.partitionBy(file)
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_part", file, (F.greatest(F.max("_top").over(whole), F.lit(FIRST_FREE_SCAN - 1)) + before).alias("_start"))
    starts = written(starts, "starts")
    starts = F.broadcast(starts) if small_enough(starts, BROADCAST_KEYS_BYTES) else starts
    # a first use stands behind its mark, and as many marks as first uses lie before each row
    rows = ordered.withColumn("_row", F.lit(1)).unionByName(first.withColumn("_row", F.lit(0)), allowMissingColumns=True)
    upto = Window.partitionBy("_part", file).orderBy("_id", "_row")
    marks = F.sum(1 - F.col("_row")).over(upto)
    rows = rows.withColumn("_is_first", F.coalesce(F.lag("_row").over(upto) == 0, F.lit(False))).withColumn("_later", F.row_number().over(upto) - marks * 2)
    new_num = F.when(F.col("_is_first"), F.col("scan_num").cast("bigint")).otherwise(F.col("_start") + F.col("_later"))
    out = rows.where("_row = 1").join(starts, ["_part", file]).select(*scans.columns, new_num.alias("new_num"))
    return out.unionByName(scans.where("scan_num IS NULL").withColumn("new_num", F.lit(None).cast("bigint")))


def head_scans(scans: DataFrame, n: int, position: list[str], file: str = "source_file") -> DataFrame:
    """First ``n`` rows of every file; each task cuts its own rows before the shuffle."""
    window = Window.partitionBy(file).orderBy(*[F.col(c).asc() for c in position])
    return scans.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")


def chunk_offsets(chunks: DataFrame, separator_bytes: int, file: str = "source_file") -> DataFrame:
    """Byte offset of each chunk of a file that was cut at a separator."""
    size = F.octet_length("value") + F.lit(separator_bytes)
    return running_sum(chunks, file, size, "byte_offset")


def repair_scan_tags(lines: DataFrame, file: str = "source_file", value: str = "value") -> DataFrame:
    """Balance scan elements line by line and drop the first schema location of a file.

    A second closing line in a row goes; an opening line while a scan is open
    gets a closing line before it.
    """
    line = F.col(value)
    kind = F.when(line.contains("<scan "), "open").when(line.contains("</scan>"), "close")
    with_prev = previous_value(lines.withColumn("_kind", kind), file, F.col("_kind"), "_prev")
    location = r'xsi:schemaLocation="[^"]*"'
    first = lines.where(line.rlike(location)).groupBy(file).agg(F.min(F.struct("block", "place")).alias("_loc"))
    # one row a file: sent to every task, as a shuffle by file would gather a file in one
    marked = with_prev.join(F.broadcast(first), file, "left")
    here = F.coalesce(F.struct("block", "place") == F.col("_loc"), F.lit(False))
    text = F.when(here, F.regexp_replace(line, f"^(.*?){location}", "$1")).otherwise(line)
    out = (
        F.when((F.col("_kind") == "close") & (F.col("_prev") == "close"), F.array().cast("array<string>"))
        .when((F.col("_kind") == "open") & (F.col("_prev") == "open"), F.array(F.lit("</scan>"), text))
        .otherwise(F.array(text))
    )
    return marked.select(file, "block", "place", F.posexplode(out).alias("sub_place", value))


def index_block(numbers_and_offsets: Column, index_offset: Column, before: Column | None = None) -> Column:
    """Index of scan offsets, in scan-number order, and the document's end.

    The digest is the SHA-1 of all bytes up to and with the opening tag of the
    digest itself; ``before`` is the document's text up to the index.
    """
    rows = F.transform(
        F.array_sort(numbers_and_offsets),
        lambda e: F.concat(
            F.lit('        <offset id="'), e["scan_num"].cast("string"), F.lit('">'), e["byte_offset"].cast("string"), F.lit("</offset>\n")
        ),
    )
    index = F.concat(
        F.lit('    <index name="scan">\n'),
        F.array_join(rows, ""),
        F.lit("    </index>\n    <indexOffset>"),
        index_offset.cast("string"),
        F.lit("</indexOffset>\n    <sha1>"),
    )
    whole = index if before is None else F.concat(before, index)
    return F.concat(index, F.sha1(whole), F.lit("</sha1>\n</mzXML>\n"))


def parse_index(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Scan offsets and the index position read back from indexed files."""
    numbers = F.regexp_extract_all(F.col(text), F.lit(r'<offset id="(\d+)">(\d+)<'), F.lit(1))
    offsets = F.regexp_extract_all(F.col(text), F.lit(r'<offset id="(\d+)">(\d+)<'), F.lit(2))
    pairs = F.arrays_zip(numbers.alias("n"), offsets.alias("o"))
    start = F.regexp_extract(F.col(text), r"<indexOffset>(\d+)</indexOffset>", 1).try_cast("bigint")
    return df.select(*keep, start.alias("index_offset"), F.explode(pairs).alias("_p")).select(
        *keep,
        F.col("_p.n").cast("int").alias("scan_num"),
        F.col("_p.o").cast("bigint").alias("byte_offset"),
        "index_offset",
    )
