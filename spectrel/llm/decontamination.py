"""Test items inside documents: size-partitioned min-hash containment, checked on the shingles themselves.

Items are partitioned by the size of their shingle sets (powers of two). The sketch of an item holds its shingles with the
least hashes, in a number that its partition fixes: more than the shingles that may be missing at the threshold, so a
document over the threshold holds at least ``least`` of them. Documents are probed with all their shingles, whatever
their length; pairs with that many hits are checked word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spectrel.operators.shared import written

from .columns import LOWER, SPACE, combined, flat, shingle_sets, slices, word_hashes
from .hashfilter import key_filter, passes

SPARE = 8  # shingles of a sketch beyond those that may be missing
_TABLE = bytes(LOWER.tolist())
_BREAKS = bytes(np.flatnonzero(SPACE).tolist())


def words_of(text: str | None) -> list[bytes]:
    data = (text or "").encode().translate(_TABLE)
    return data.translate(bytes(32 if b in _BREAKS else b for b in range(256))).split(b" ")


def shingles_of(text: str | None, size: int) -> tuple[int, set[tuple[bytes, ...]]]:
    """The shingle length (fewer than ``size`` for a shorter text) and the distinct shingles."""
    words = [w for w in words_of(text) if w]
    length = min(size, len(words))
    return length, {tuple(words[i : i + length]) for i in range(len(words) - length + 1)} if length else set()


def _sketches(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, starts = flat(batch.column("text"))
            rows, keys = [], []
            for item, own in zip(batch.column("item").to_pylist(), shingle_sets(text, starts, size)):
                n = len(own)
                if n:
                    largest = (1 << n.bit_length()) - 1  # of its partition
                    missing = n - -(-n * percent // 100)
                    chosen = own[: min(n, largest - -(-largest * percent // 100) + SPARE)]
                    rows += [(item, len(chosen) - missing)] * len(chosen)
                    keys.append(chosen)
            cells = np.array(rows, np.int64).reshape(-1, 2)
            key = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            yield pa.record_batch({"key": pa.array(key), "item": pa.array(cells[:, 0]), "least": pa.array(cells[:, 1])})

    return run


def _hits(lengths: list[int], wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            text, starts = flat(batch.column("text"))
            for a, b in slices(starts):
                words, first = word_hashes(text[starts[a] : starts[b]], starts[a : b + 1] - starts[a])
                owner = np.repeat(np.arange(b - a), np.diff(first))
                for length in lengths:
                    key = combined(words, length)
                    spot = np.flatnonzero(passes(wanted.value, key) & (owner[: len(key)] == owner[length - 1 :]))
                    if len(spot):
                        pair = np.unique(np.stack([rows[a:b][owner[spot]], key[spot].view(np.int64)], axis=1), axis=0)
                        yield pa.record_batch({"row": pa.array(pair[:, 0]), "key": pa.array(pair[:, 1])})

    return run


def _lengths(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, starts = flat(batch.column("text"))
            first = word_hashes(text, starts)[1]
            yield pa.record_batch({"length": pa.array(np.unique(np.minimum(np.diff(first), size)).astype(np.int32))})

    return run


def _candidates_only(wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(wanted.value, batch.column("row").to_numpy())))

    return run


def _confirm(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            last, parts = None, {}
            for row, text, item_text in zip(batch.column("row").to_pylist(), batch.column("text"), batch.column("item_text").to_pylist()):
                length, own = shingles_of(item_text, size)
                if row != last:
                    last, words, parts = row, [w for w in words_of(text.as_py()) if w], {}
                if length not in parts:
                    parts[length] = {tuple(words[i : i + length]) for i in range(len(words) - length + 1)}
                found = len(own & parts[length])
                out.append((len(own), found, 100 * found >= percent * len(own)))
            cells = np.array(out, np.int64).reshape(-1, 3)
            rows = pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "row", "item_id")), pa.array(cells[:, 0]), pa.array(cells[:, 1])],
                names=["doc_id", "row", "item_id", "n_shingles", "n_found"],
            )
            yield rows.filter(pa.array(cells[:, 2] == 1))

    return run


def contaminations(docs: DataFrame, items: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found) where a document holds ``percent`` hundredths of an item's shingles.

    ``docs`` has doc_id and text, ``items`` has item_id and text. Words are runs of bytes other than space, tab, line and
    page feeds, A-Z lower-cased; a set holds the distinct runs of ``size`` words, or the whole sequence of a shorter item.

    Null, empty or blank texts hold nothing and are held by nothing. Null ids are reported as null. Repeated rows and equal
    items under one id are reported once; equal items under several ids once for each. Other columns are ignored. An empty
    table gives no row.
    """
    return contaminated_rows(docs, items, percent, size).drop("row").distinct()


def full_items(items: DataFrame, size: int = 5) -> DataFrame:
    """The items with at least one full shingle, that is ``size`` words or more."""
    return items.where(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) >= size)


def row_name() -> Column:
    """The hash of doc_id and text by which ``contaminated_rows`` names a row."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), "text")


def contaminated_rows(docs: DataFrame, items: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """As ``contaminations``, with the name of the row (``row_name``): texts that share an id are told apart."""
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").alias("item_text")).where("item_text IS NOT NULL")
    items = items.withColumn("item", F.xxhash64("item_text")).distinct()
    texts = items.select("item", F.col("item_text").alias("text")).distinct()
    sketches = written(texts.mapInArrow(_sketches(size, percent), "key bigint, item bigint, least bigint"), "sketches")
    lengths = [r[0] for r in texts.select("text").mapInArrow(_lengths(size), "length int").where("length > 0").distinct().collect()]
    wanted = spark.sparkContext.broadcast(key_filter(sketches, "key"))

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text IS NOT NULL")
    docs = docs.withColumn("row", row_name())
    hits = docs.select("row", "text").mapInArrow(_hits(sorted(lengths), wanted), "row bigint, key bigint")
    candidates = (
        hits.join(sketches, "key")
        .groupBy("row", "item", "least")
        .agg(F.countDistinct("key").alias("n"))
        .where("n >= least")
        .select("row", "item")
    )
    candidates = written(candidates, "candidates")
    chosen = spark.sparkContext.broadcast(key_filter(candidates, "row"))
    kinds = "doc_id bigint, text string, row bigint"
    pairs = docs.mapInArrow(_candidates_only(chosen), kinds).join(candidates.join(items, "item"), "row")
    kinds = "doc_id bigint, row bigint, item_id bigint, n_shingles bigint, n_found bigint"
    return pairs.select("doc_id", "text", "row", "item_id", "item_text").mapInArrow(_confirm(size, percent), kinds)
