"""Arrow text columns as byte arrays, and vectorised hashes of words, shingles and byte windows.

Everything here works on whole texts, a bounded slice of a batch at a time; nothing is cut off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_U = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit words."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_CODES = mix(np.arange(1, 257, dtype=np.uint64))
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEPS = mix(np.arange(1000, 1100, dtype=np.uint64)) | _U(1)


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n + 1:
            size = max(n + 1, 2 * len(cls.up))
            up, down = np.full(size, _BASE), np.full(size, _INVERSE)
            up[0] = down[0] = 1
            cls.up, cls.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return cls.up, cls.down


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the place where each begins (one more than texts); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # too large for one array of 32-bit places
        parts = [flat(c) for c in column.chunks]
        shift = np.cumsum([0] + [len(b) for b, _ in parts])
        return np.concatenate([b for b, _ in parts]), np.concatenate([[0], *(p[1:] + s for (_, p), s in zip(parts, shift))])
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    starts = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    text = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if data is not None else np.zeros(0, np.uint8)
    return text, starts - starts[0]


def slices(starts: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``most`` bytes together; a longer row is a run of its own."""
    first, n = 0, len(starts) - 1
    while first < n:
        last = int(np.searchsorted(starts, starts[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def run_hashes(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``text[begin:end]``, equal for equal runs."""
    up, down = _Powers.upto(len(text))
    sums = np.empty(len(text) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_CODES[text] * up[: len(text)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def _words(text: np.ndarray, starts: np.ndarray, split: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the words (runs of bytes not in ``split``) and the number of the first word of each row."""
    gap = split[text]
    edge = np.zeros(len(text) + 1, bool)
    edge[starts] = True
    opens = np.flatnonzero(~gap & (np.concatenate([[True], gap[:-1]]) | edge[:-1]))
    closes = np.flatnonzero(~gap & (np.concatenate([gap[1:], [True]]) | edge[1:])) + 1
    return opens, closes, np.searchsorted(opens, starts)


def word_hashes(text: np.ndarray, starts: np.ndarray, split: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the A-Z lower-cased words of each row, and the number of the first word of each row (one more than rows)."""
    hashes, firsts, done = [], [np.zeros(1, np.int64)], 0
    for a, b in slices(starts):
        part = LOWER[text[starts[a] : starts[b]]]
        opens, closes, first = _words(part, starts[a : b + 1] - starts[a], split)
        hashes.append(run_hashes(part, opens, closes))
        firsts.append(first[1:] + done)
        done += len(opens)
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.concatenate(firsts)


def combined(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` neighbouring words of the whole array."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n] * _STEPS[0]
    for j in range(1, size):
        total += words[j : j + n] * _STEPS[j]
    return mix(total + _U(size))


def shingle_sets(text: np.ndarray, starts: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row.

    Fewer than ``size`` words: the whole sequence as one shingle; no word: no shingle.
    """
    words, first = word_hashes(text, starts)
    every = combined(words, size)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            found = np.sort(every[a : b - size + 1])
            fresh = np.empty(len(found), bool)
            fresh[0] = True
            np.not_equal(found[1:], found[:-1], out=fresh[1:])
            out.append(found[fresh])
        else:
            out.append(combined(words[a:b], int(b - a)) if b > a else words[a:a])
    return out


def blob(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)
