"""Near-duplicate documents: min-hash signatures, a multi-index Hamming join, and a check on the full shingle sets.

A signature holds ``SYMBOLS`` symbols of 16 bits, the low bits of as many min-hashes. It is split into ``m`` chunks. Two
signatures that differ in at most ``2 m - 1`` symbols differ in at most one symbol of some chunk (pigeonhole), so each
chunk is indexed once for each place that may be wrong, with that place left out. Every pair under the distance shares
a key. ``m`` is the least number of chunks for which a pair at the similarity threshold is beyond that distance with a
chance below ``MISS`` (a binomial tail); pairs above the threshold are safer still.

Equal shingle sets are one node from the start. How the nodes of a key are compared, and links confirmed on full sets, is
in ``linking``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from spectrel.operators.shared import written

from .columns import flat, joined, mix, shingle_sets, slices
from .hashfilter import key_filter, passes
from .linking import classes_of, linked_groups, one_set_each, set_ids

SYMBOLS = 120
MISS = 1e-6
FILTER_BITS = 26
_U = np.uint64
_A = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64)) | _U(1)
_B = mix(np.arange(5001, 5001 + SYMBOLS, dtype=np.uint64))
_PLACE = mix(np.arange(9001, 9001 + SYMBOLS, dtype=np.uint64))


def chunk_starts(percent: int) -> np.ndarray:
    """First symbol of each chunk, for a similarity of ``percent`` hundredths."""
    p = 1 - percent / 100
    for m in range(1, SYMBOLS // 2 + 1):
        tail = sum(math.comb(SYMBOLS, k) * p**k * (1 - p) ** (SYMBOLS - k) for k in range(2 * m, SYMBOLS + 1))
        if tail <= MISS:
            return np.arange(m) * SYMBOLS // m
    raise ValueError("no number of chunks is safe for so low a similarity")


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of symbols for each non-empty set."""
    out = np.empty((len(sets), SYMBOLS), np.uint16)
    bounds = np.cumsum([0] + [len(s) for s in sets])
    for a, b in slices(bounds, 1 << 16):
        every = joined(sets[a:b], np.uint64)
        first = bounds[a:b] - bounds[a]
        work = np.empty_like(every)
        for j in range(SYMBOLS):
            np.multiply(every, _A[j], out=work)
            work += _B[j]
            out[a:b, j] = mix(np.minimum.reduceat(work, first)).astype(np.uint16)
    return out


def chunk_keys(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each signature and each symbol: a key of its chunk with that symbol left out."""
    terms = mix(symbols.astype(np.uint64) * _U(0x10001) + _PLACE)
    totals = np.add.reduceat(terms, starts, axis=1)
    chunk = np.searchsorted(starts, np.arange(symbols.shape[1]), side="right") - 1
    return mix(totals[:, chunk] - terms + _PLACE).view(np.int64)


def _describe(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, starts = flat(batch.column("text"))
            for a, b in slices(starts):
                sets = shingle_sets(text[starts[a] : starts[b]], starts[a : b + 1] - starts[a], size)
                some = np.array([len(s) > 0 for s in sets])
                node, marks = np.zeros(b - a, np.int64), np.zeros((b - a, SYMBOLS), np.uint16)
                if some.any():
                    full = [s for s in sets if len(s)]
                    node[some], marks[some] = set_ids(full), signatures(full)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(a, b - a),
                        "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                        "node": pa.array(node, mask=~some),
                        "marks": pa.array([m.tobytes() for m in marks], pa.binary()),
                    }
                )

    return run


def _node_column(size: int, text_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, starts = flat(batch.column(text_column))
            for a, b in slices(starts):
                sets = shingle_sets(text[starts[a] : starts[b]], starts[a : b + 1] - starts[a], size)
                some, node = np.array([len(s) > 0 for s in sets]), np.zeros(b - a, np.int64)
                if some.any():
                    node[some] = set_ids([s for s in sets if len(s)])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(node, mask=~some)], names=[*part.schema.names, "node"])

    return run


def with_nodes(docs: DataFrame, size: int = 5, text_column: str = "text") -> DataFrame:
    """The rows with the node (a bigint) of their text, as ``duplicate_classes`` names it; null for a text without shingle."""
    schema = docs.limit(0).withColumn("node", F.lit(None).cast(LongType())).schema
    return docs.mapInArrow(_node_column(size, text_column), schema)


def _keys(starts: np.ndarray, kept=None):
    """Rows (key, node), or with a filter (key, place, node): place is the symbol left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2000):
                part = batch.slice(a, 2000)
                symbols = flat(part.column("marks"))[0].view(np.uint16).reshape(-1, SYMBOLS)
                node = np.repeat(part.column("node").to_numpy(), SYMBOLS)
                key = chunk_keys(symbols, starts).ravel()
                if kept is None:
                    yield pa.record_batch({"key": pa.array(key), "node": pa.array(node)})
                    continue
                hit = np.flatnonzero(passes(kept.value, key))
                place = (hit % SYMBOLS).astype(np.int32)
                yield pa.record_batch({"key": pa.array(key[hit]), "place": pa.array(place), "node": pa.array(node[hit])})

    return run


def _near(starts: np.ndarray):
    most = 2 * len(starts) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one = flat(batch.column("marks_a"))[0].view(np.uint16).reshape(-1, SYMBOLS)
            two = flat(batch.column("marks_b"))[0].view(np.uint16).reshape(-1, SYMBOLS)
            near = np.count_nonzero(one != two, axis=1) <= most
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return run


def near_duplicates(docs: DataFrame, percent: int = 80, size: int = 5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Classes of documents whose shingle sets are linked by a Jaccard similarity of ``percent`` hundredths or more.

    Words are runs of bytes other than space, tab, line and page feeds, A-Z lower-cased; a set holds the distinct runs of
    ``size`` words of the whole text, or the whole sequence where it is shorter. Returns a row for each input row: doc_id,
    n_shingles, component_id (smallest id of its class), kept (doc_id = component_id).

    Null or empty text, or no word: no shingle, linked with nothing, kept. Repeated rows: one class, each kept if it bears
    the smallest id. Null id: linked like others but never the smallest id; kept only in a class without any id. Other
    columns are ignored. An empty table gives no row.
    """
    out = duplicate_classes(docs, percent, size, id_column, text_column)
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def duplicate_classes(docs: DataFrame, percent: int = 80, size: int = 5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """As ``near_duplicates``: a row for each input row with doc_id, n_shingles, node, root, component_id.

    ``node`` names the shingle set and ``root`` the class; several classes may have one smallest id where an id is
    repeated. Both are null, as is component_id, for a text without shingle.
    """
    spark = docs.sparkSession
    starts = chunk_starts(percent)
    docs = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))

    described = written(docs.mapInArrow(_describe(size), "doc_id bigint, n_shingles bigint, node bigint, marks binary"), "described")
    nodes = written(
        described.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min("doc_id").alias("label"), F.first("n_shingles").alias("n"), F.first("marks").alias("marks")),
        "nodes",
    )
    marks = nodes.select("node", "marks")
    shared = written(
        marks.mapInArrow(_keys(starts), "key bigint, node bigint")
        .groupBy("key")
        .agg(F.count("*").alias("c"))
        .where("c > 1"),
        "shared_keys",
    )
    kept = spark.sparkContext.broadcast(key_filter(shared, "key", FILTER_BITS))
    members = written(marks.mapInArrow(_keys(starts, kept), "key bigint, place int, node bigint").join(shared, "key"), "members")

    need = members.select("node").distinct().join(nodes, "node").select("node", "label")
    full = written(one_set_each(docs, need, size), "full_sets")

    def near(pairs: DataFrame) -> DataFrame:
        one = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("marks").alias("marks_a"))
        two = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("marks").alias("marks_b"))
        sized = pairs.join(one, "a").join(two, "b").where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        return sized.select("a", "b", "marks_a", "marks_b").mapInArrow(_near(starts), "a bigint, b bigint")

    groups = linked_groups(members, full, percent, likely=near)
    out = described.select("doc_id", "n_shingles", "node").join(classes_of(nodes, groups), "node", "left")
    return out.select("doc_id", "n_shingles", "node", "root", "component_id")
