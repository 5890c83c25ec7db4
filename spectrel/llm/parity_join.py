"""Jaccard join of word n-grams by parity sketches.

A sketch has ``m`` chunks of ``PLACES`` bits; each shingle flips one bit, so the sketch holds the parities. A bit can
differ between two sketches only if some shingle is in one set alone: the Hamming distance of two sketches is at most
the size of the symmetric difference of the sets. Linked sets differ in at most (100 - P) * (a + b) / (100 + P) shingles,
where a and b are their sizes and P the similarity in hundredths.

Sizes fall into bands such that linked sets are in one band or in neighbours. A set takes part in the sketches of its own
band and of the next one, where it stands for the smaller side. At most d differing bits leave all but d of the m chunks
equal (pigeonhole), so of any d + 1 chunks one is equal. Which d + 1 chunks a set offers as keys is free as long as all
sets choose by one order of the chunk values; it takes those with the most bits set, which are the least common. Thus
every linked pair shares a key, without chance. Sets that share keys are compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spectrel.operators.shared import written

from .columns import flat, joined, mix, shingle_sets, slices
from .hashfilter import key_filter, passes
from .linking import Step, classes_of, linked_groups, one_set_each, set_ids, sets_of

PLACE_BITS = 16
FILTER_BITS = 26
_U = np.uint64


def band_ends(percent: int, most: int) -> np.ndarray:
    """The largest size of each band, up to a band that holds ``most``. A size linked with one of a band is at most in the next."""
    ends = [0]
    while ends[-1] < most:
        ends.append(100 * (ends[-1] + 1) // percent)
    return np.array(ends[1:])


def chunks_of(percent: int, end: np.ndarray) -> np.ndarray:
    """The number of chunks for the sketches of bands with sizes up to ``end``; 0 where only equal sets are linked."""
    differ = (100 - percent) * 2 * end // (100 + percent)
    return np.where(differ > 0, np.maximum(3 * (differ + 1) // 2, differ + 5), 0)


def parity_keys(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the sets (sorted, distinct 64-bit hashes) and the number of the set that each key belongs to."""
    sizes = np.array([len(s) for s in sets], np.int64)
    every = joined(sets, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    ends = band_ends(percent, int(sizes.max(initial=1)))
    ends = np.append(ends, 100 * (ends[-1] + 1) // percent)
    own_band = np.searchsorted(ends, sizes)
    keys, owners = [], []
    for step in (0, 1):
        band = own_band + step
        chunks = chunks_of(percent, ends[band])
        largest = np.minimum(ends[band], 100 * sizes // percent)
        wanted = np.where(chunks > 0, (100 - percent) * (sizes + largest) // (100 + percent) + 1, 0)
        some = chunks[owner] > 0
        token, of = every[some], owner[some]
        chunk = ((token >> _U(32)) * chunks[of].astype(np.uint64)) >> _U(32)
        bit = (chunk << _U(PLACE_BITS)) | (token & _U((1 << PLACE_BITS) - 1))
        # the bits that are set: those flipped an odd number of times
        order = np.lexsort((bit, of))
        bit, of = bit[order], of[order]
        first = np.flatnonzero(np.concatenate([[True], (bit[1:] != bit[:-1]) | (of[1:] != of[:-1])])) if len(bit) else np.zeros(0, np.int64)
        odd = np.diff(np.append(first, len(bit))) % 2 == 1
        bit, of = bit[first[odd]], of[first[odd]]
        chunk = (bit >> _U(PLACE_BITS)).astype(np.int64)
        # each chunk with a set bit, as one value and with its number of bits
        first = np.flatnonzero(np.concatenate([[True], (chunk[1:] != chunk[:-1]) | (of[1:] != of[:-1])])) if len(bit) else np.zeros(0, np.int64)
        if len(first):
            value = mix(np.bitwise_xor.reduceat(mix(bit + _U(1)), first) ^ mix(chunk[first].astype(np.uint64) + _U(1 << 50)))
            n_bits, of, chunk = np.diff(np.append(first, len(bit))), of[first], chunk[first]
        else:
            value, n_bits, of = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        order = np.lexsort((value, -n_bits, of))
        value, chunk, of = value[order], chunk[order], of[order]
        starts = np.searchsorted(of, np.arange(len(sets) + 1))
        taken = np.arange(len(of)) - starts[of] < wanted[of]
        salt = mix(band.astype(np.uint64) + _U(77))
        keys.append(mix(value[taken] ^ salt[of[taken]]))
        owners.append(of[taken])
        # a set with too few chunks that hold a bit goes on with empty ones, the last in the order
        for i in np.flatnonzero(np.diff(starts) < wanted):
            empty = np.setdiff1d(np.arange(chunks[i]), chunk[starts[i] : starts[i + 1]])
            empty = empty[np.argsort(mix(empty.astype(np.uint64)), kind="stable")][: wanted[i] - (starts[i + 1] - starts[i])]
            keys.append(mix(mix(empty.astype(np.uint64) + _U(1 << 51)) ^ salt[i]))
            owners.append(np.full(len(empty), i))
    return np.concatenate(keys).view(np.int64), np.concatenate(owners)


def _describe(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, starts = flat(batch.column("text"))
            for a, b in slices(starts):
                sets = shingle_sets(text[starts[a] : starts[b]], starts[a : b + 1] - starts[a], size)
                some = np.array([len(s) > 0 for s in sets])
                node = np.zeros(b - a, np.int64)
                if some.any():
                    node[some] = set_ids([s for s in sets if len(s)])
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(a, b - a),
                        "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                        "node": pa.array(node, mask=~some),
                    }
                )

    return run


def _keys(sets_of_batches: Step, percent: int, kept=None) -> Step:
    """Rows (key, node) of the sets that a step gives; with a filter, those of keys that may be shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sets_of_batches(batches):
            shingles, starts = flat(batch.column("shingles"))
            node = batch.column("node").to_numpy()
            for a, b in slices(starts):
                every = shingles[starts[a] : starts[b]].copy().view(np.uint64)
                sets = np.split(every, (starts[a + 1 : b] - starts[a]) // 8)
                key, owner = parity_keys(sets, percent)
                if kept is not None:
                    hit = passes(kept.value, key)
                    key, owner = key[hit], owner[hit]
                yield pa.record_batch({"key": pa.array(key), "node": pa.array(node[a:b][owner])})

    return run


def parity_join(docs: DataFrame, percent: int = 80, size: int = 5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Classes of documents whose sets of ``size``-word shingles are linked by a Jaccard similarity of ``percent`` hundredths.

    Words are runs of bytes other than space, tab, line and page feeds, A-Z lower-cased; a set holds the distinct shingles
    of the whole text, or the whole sequence where it is shorter. Returns a row for each input row: doc_id, n_shingles,
    component_id (smallest id that links lead to, itself included). Every link counts, also that at just the threshold.

    Null or empty text, or no word: no shingle, linked with nothing. Repeated rows: one class. Null id: linked like others
    but never the smallest; a class without any id has a null component. Other columns are ignored. An empty table gives no
    row. A text of any length is one set in memory, 8 bytes a word.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent is a number of hundredths from 50 to 100")
    docs = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    context = docs.sparkSession.sparkContext

    described = written(docs.mapInArrow(_describe(size), "doc_id bigint, n_shingles bigint, node bigint"), "described")
    nodes = written(described.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("label")), "nodes")
    every = sets_of(docs, nodes, size)
    counted = docs.mapInArrow(_keys(every, percent), "key bigint, node bigint").groupBy("key").agg(F.count("*").alias("c"))
    shared = written(counted.where("c > 1"), "shared_keys")
    kept = context.broadcast(key_filter(shared, "key", FILTER_BITS))
    members = docs.mapInArrow(_keys(every, percent, kept), "key bigint, node bigint").distinct()  # a copy may have passed as well
    members = written(members.join(shared, "key"), "members")
    need = members.select("node").distinct().join(nodes, "node")
    full = written(one_set_each(docs, need, size), "full_sets")
    groups = linked_groups(members, full, percent)
    out = described.join(classes_of(nodes, groups), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))
