"""Periodic runs of words, found by internal pattern matching.

The words of a slice of documents are numbered apart for each document and closed by a sign of their own, so no string
crosses documents. Prefix doubling gives the suffix array and, on the way, a name for each string of a power of two of
words (a dyadic block); a name is an interval of the suffix array. A wavelet matrix over the suffix array answers range
successor queries: the next place, within an interval, at which a block occurs.

A run of smallest period q and at least 4 q words holds, for the power of two m with q < m <= 2 q, a block of m words that
starts at a multiple of m / 2 and occurs again q words later, still within the run. So each such block asks for its next
occurrence within m words. If that lies within m / 2, the occurrences form a progression whose difference is the block's
own period d; a run of another period then needs an occurrence beyond m - d, and there is at most one. These at most two
distances are the candidate periods of the block. They are extended to both sides by the names of the dyadic strings,
and the smallest period of each stretch is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import SPACE, _words, flat, mix, run_hashes, slices

_U = np.uint64


def dyadic_names(symbols: np.ndarray) -> list[np.ndarray]:
    """For k = 0, 1, ...: the name of the string of ``2**k`` symbols at each place, until all names differ.

    A name is the place, in the suffix array, of the first suffix that begins with the string. Every stretch of symbols
    must end in one that occurs nowhere else; a string beyond it has a name of its own.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    fresh = np.concatenate([[True], symbols[order][1:] != symbols[order][:-1]]) if n else np.zeros(0, bool)
    name = np.empty(n, np.int32)
    name[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    names, step = [name], 1
    while True:
        size = np.bincount(name, minlength=n)
        open_places = np.flatnonzero(size[name] > 1)
        if not len(open_places):
            return names
        old = name[open_places].astype(np.int64)
        key = old * n + name[open_places + step]
        order = np.argsort(key, kind="stable")
        key, old = key[order], old[order]
        place = np.arange(len(key))
        group = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), place, 0))
        first = np.maximum.accumulate(np.where(np.concatenate([[True], key[1:] != key[:-1]]), place, 0))
        name = name.copy()
        name[open_places[order]] = old + first - group
        names.append(name)
        step *= 2


class WaveletMatrix:
    """Range successor over an array of distinct values below its length."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros = []
        values = values.astype(np.int32)
        for b in range(self.bits - 1, -1, -1):
            one = (values >> b) & 1 == 1
            zeros = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~one, out=zeros[1:])
            self.zeros.append(zeros)
            values = np.concatenate([values[~one], values[one]])

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest value of at least ``least`` in each interval ``low:high``; -1 where there is none."""
        below = np.zeros(len(low), np.int64)
        a, b = low.astype(np.int64), high.astype(np.int64)
        beyond = least >= 1 << self.bits
        for zeros, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):
            one = (least >> bit) & 1 == 1
            za, zb, all_zeros = zeros[a], zeros[b], zeros[-1]
            below += np.where(one, zb - za, 0)
            a, b = np.where(one, all_zeros + a - za, za), np.where(one, all_zeros + b - zb, zb)
        found = ~beyond & (below < high - low)
        out = np.full(len(low), -1, np.int64)
        a, b, k = low[found].astype(np.int64), high[found].astype(np.int64), below[found]
        value = np.zeros(len(k), np.int64)
        for zeros, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):
            za, zb, all_zeros = zeros[a], zeros[b], zeros[-1]
            one = k >= zb - za
            k = np.where(one, k - (zb - za), k)
            a, b = np.where(one, all_zeros + a - za, za), np.where(one, all_zeros + b - zb, zb)
            value |= one.astype(np.int64) << bit
        out[found] = value
        return out


def _extended(names: list[np.ndarray], a: np.ndarray, b: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many symbols before and from the places ``a`` and ``b`` (a < b) are equal; ``begin`` is where their document starts."""
    forward, back = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    for k in range(len(names) - 1, -1, -1):
        same = names[k][a + forward] == names[k][b + forward]
        forward += same.astype(np.int64) << k
        able = a - back - (1 << k) >= begin
        one, two = np.where(able, a - back - (1 << k), 0), np.where(able, b - back - (1 << k), 0)
        back += (able & (names[k][one] == names[k][two])).astype(np.int64) << k
    return back, forward


def runs_of(words: np.ndarray, first: np.ndarray, least: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of every document: its number, start, length and smallest period, sorted by document, start and period.

    ``words`` are hashes of the words of all documents, ``first`` the number of the first word of each (one more than
    documents). A run has at least ``least`` words and at least four periods.
    """
    sizes = np.diff(first)
    n_docs = len(sizes)
    nothing = np.zeros(0, np.int64)
    if not len(words):
        return nothing, nothing, nothing, nothing
    begin = first[:-1] + np.arange(n_docs)  # each document is followed by its closing sign
    doc = np.repeat(np.arange(n_docs), sizes + 1)
    symbols = np.empty(len(words) + n_docs, np.uint64)
    closing = begin + sizes
    inner = np.ones(len(symbols), bool)
    inner[closing] = False
    salt = mix(np.arange(1, n_docs + 1, dtype=np.uint64))
    symbols[inner] = mix(words ^ salt[doc[inner]])
    symbols[closing] = mix(salt + _U(1))
    names = dyadic_names(symbols)
    suffixes = np.empty(len(symbols), np.int32)
    suffixes[names[-1]] = np.arange(len(symbols))
    index = WaveletMatrix(suffixes)

    found = []
    for k in range(1, len(names)):
        m = 1 << k
        blocks = np.maximum(0, (sizes - m) // (m // 2) + 1)
        at = np.repeat(begin, blocks) + (np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * (m // 2)
        size = np.bincount(names[k], minlength=len(symbols))
        at = at[size[names[k][at]] > 1]
        low = names[k][at].astype(np.int64)
        high = low + size[low]
        near = index.successor(low, high, at + 1)
        hit = (near >= 0) & (near - at < m)
        at, low, high, d = at[hit], low[hit], high[hit], (near - at)[hit]
        found.append((at, d))
        dense = 2 * d <= m
        at, low, high, d = at[dense], low[dense], high[dense], d[dense]
        near = index.successor(low, high, at + np.maximum(d, m - d) + 1)
        hit = (near >= 0) & (near - at < m)
        found.append((at[hit], (near - at)[hit]))
    if not found:
        return nothing, nothing, nothing, nothing
    at, period = np.concatenate([a for a, _ in found]), np.concatenate([d for _, d in found])
    back, forward = _extended(names, at, at + period, begin[doc[at]])
    start, length = at - back, back + period + forward
    long = (length >= 4 * period) & (length >= least)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[fresh], length[fresh], period[fresh]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    return doc[start], start - begin[doc[start]], length, period


def _kept(text: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run repeats after its first period."""
    words = text.split()
    if runs:
        depth = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            depth[start + period] += 1
            depth[start + length] -= 1
        words = compress(words, np.cumsum(depth[:-1]) == 0)
    return b" ".join(words)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUN = "struct<start: bigint, length: bigint, period: bigint>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, starts = flat(batch.column("text"))
        for a, b in slices(starts):
            part, places = text[starts[a] : starts[b]], starts[a : b + 1] - starts[a]
            opens, closes, first = _words(part, places, SPACE)
            doc, start, length, period = runs_of(run_hashes(part, opens, closes), first)
            edges = np.searchsorted(doc, np.arange(b - a + 1))
            runs, best, kept = [], [], []
            for i in range(b - a):
                own = list(zip(*(c[edges[i] : edges[i + 1]].tolist() for c in (start, length, period))))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                top = max(own, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
                best.append(top and dict(zip(("start", "length", "period"), top)))
                kept.append(_kept(part[places[i] : places[i + 1]].tobytes(), own).decode("utf-8", "replace"))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").slice(a, b - a),
                    "n_words": pa.array(np.diff(first)),
                    "runs": pa.array(runs, pa.list_(_RUN)),
                    "best": pa.array(best, _RUN),
                    "collapsed": pa.array(kept, pa.string()),
                }
            )


def find_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every periodic run of words of each text, and the text with each run cut to its first period.

    Words are runs of bytes other than space, tab, line and page feeds. A run is a stretch of at least six words and four
    periods that repeats its smallest period and that no neighbouring word extends. Returns a row for each input row:
    doc_id, n_words, runs (start, length, period in words, by start and period), best (the run of the greatest length to
    period, then least start, then least period; null without run), collapsed (the words that no run repeats, joined by
    one space).

    Null or empty text, or no word: no run, ``collapsed`` is empty. Repeated rows and rows without id are judged each for
    itself; other columns are ignored. An empty table gives no row. A text is worked on as a whole by one task, in memory
    of about 200 bytes a word.
    """
    docs = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    return docs.mapInArrow(_find, f"doc_id bigint, n_words bigint, runs array<{RUN}>, best {RUN}, collapsed string")
