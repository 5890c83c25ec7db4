"""Packing of tokenised documents into sequences by minimum bin slack.

Only the number of pieces of each length matters for the plan, and there are at most ``capacity`` lengths. For one
sequence a bitset holds every total that the lengths at hand can reach; the fullest one is traced back to a combination,
which is removed as often as the counts allow. The plan is therefore small whatever the number of documents; Spark
numbers the pieces of a length and each task looks its pieces up in the plan.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spectrel.operators.shared import written

SALTS = 64  # parts of a length that are numbered apart


@functools.lru_cache(maxsize=4)
def encoder(path: str):
    """A function from text to its ids, for a byte-level BPE file of the ``tokenizers`` library.

    Where the ids follow the merge order, the same ranks run in ``tiktoken``, which is several times faster. A text that its
    expression engine gives up on, as a run of a million spaces, is left to ``tokenizers``.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, extra = spec["model"], {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocabulary = {k: v for k, v in model["vocab"].items() if k not in extra}
    merged = [vocabulary.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    plain = (spec["pre_tokenizer"] or {}) == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}

    @functools.cache
    def whole() -> Tokenizer:
        return Tokenizer.from_file(path)

    def encode_whole(text: str) -> np.ndarray:
        return np.array(whole().encode(text, add_special_tokens=False).ids, np.uint32)

    if None in merged or merged != sorted(merged) or not plain or spec["normalizer"]:
        return encode_whole
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    ranks = {bytes(byte[c] for c in token): rank for token, rank in vocabulary.items()}
    fast = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=extra)

    def encode(text: str) -> np.ndarray:
        special = "all" if any(token in text for token in extra) else set()
        try:
            return fast.encode_to_numpy(text, allowed_special=special, disallowed_special=())
        except ValueError:  # the stack of its expression engine is bounded
            return encode_whole(text)

    return encode


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            rows = []
            for place, text in enumerate(batch.column("text")):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                    rows.append((place, piece, a, b - a, zlib.crc32(ids[a:b])))
            cells = np.array(rows, np.int64).reshape(-1, 5)
            out = {"doc_id": batch.column("doc_id").take(pa.array(cells[:, 0]))}
            out |= {name: pa.array(cells[:, k]) for k, name in ((2, "start"), (3, "length"), (4, "ids_crc32"))}
            out["piece"] = pa.array(cells[:, 1].astype(np.int32))
            yield pa.record_batch(out).select(["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def fullest(counts: np.ndarray, room: int) -> list[tuple[int, int]]:
    """(length, times) of a combination of at most ``room`` with the largest total; larger lengths are tried first."""
    steps, reach, goal = [], 1, 1 << room
    mask = (goal << 1) - 1
    for length in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        left, part = min(int(counts[length]), room // length), 1
        while left and not reach & goal:
            part = min(part, left)
            steps.append((reach, length, part))
            reach |= (reach << (length * part)) & mask
            left, part = left - part, 2 * part
        if reach & goal:
            break
    total, used = reach.bit_length() - 1, {}
    for before, length, part in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + part
            total -= length * part
    return sorted(used.items(), reverse=True)


def slack_plan(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Rows (length, first number, sequence, times, offset) for ``counts`` pieces of each length.

    The pieces of a length that are numbered from ``first number`` on fill ``times`` places, ``offset`` on, of each of
    the sequences from ``sequence`` on.
    """
    counts, taken, rows, sequence = counts.copy(), np.zeros_like(counts), [], 0
    while counts.any():
        largest = int(np.flatnonzero(counts)[-1])
        counts[largest] -= 1
        chosen = dict(fullest(counts, capacity - largest))
        counts[largest] += 1
        chosen[largest] = chosen.get(largest, 0) + 1
        times = min(int(counts[length]) // need for length, need in chosen.items())
        offset = 0
        for length, need in sorted(chosen.items(), reverse=True):
            rows.append((length, int(taken[length]), sequence, need, offset))
            taken[length] += need * times
            counts[length] -= need * times
            offset += length * need
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _places(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, before = shared.value
        index = plan[:, 0].astype(np.uint64) << np.uint64(48) | plan[:, 1].astype(np.uint64)
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy() - 1 + before[length, batch.column("salt").to_numpy()]
            row = plan[np.searchsorted(index, length.astype(np.uint64) << np.uint64(48) | number.astype(np.uint64), side="right") - 1]
            bins, place = np.divmod(number - row[:, 1], row[:, 3])
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["doc_id", "piece", "start", "length", "ids_crc32"]).columns, pa.array(row[:, 2] + bins), pa.array(row[:, 4] + place * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``capacity`` tokens.

    A document is its ids under the vocabulary at ``path`` and then ``end_id``. Longer documents are cut into pieces of
    ``capacity``, of which the first may be shorter. Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null or empty text: one piece that holds ``end_id``. Repeated rows are packed once each; ties between equal pieces are
    broken by id, piece, start and checksum. Null ids are kept. Other columns are ignored. An empty table gives no row.
    """
    kinds = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    chosen = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    pieces = written(chosen.mapInArrow(_pieces(path, capacity, end_id), kinds), "pieces")
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int"))
    table = pieces.groupBy("length", "salt").count().toArrow()  # at most capacity x SALTS rows
    counts = np.zeros((capacity + 1, SALTS), np.int64)
    counts[table["length"].to_numpy(), table["salt"].to_numpy()] = table["count"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast((slack_plan(counts.sum(axis=1), capacity), np.cumsum(counts, axis=1) - counts))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = pieces.withColumn("number", F.row_number().over(order).cast("bigint"))
    return numbered.mapInArrow(_places(shared), kinds + ", sequence_id bigint, offset bigint")
