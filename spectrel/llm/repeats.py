"""Byte strings that repeat across documents, found by merging Burrows-Wheeler transforms.

A text is cut into runs of neighbouring windows (strings of ``width`` bytes) that share their least 16-byte gram, so equal
windows of any two documents always lie in runs with the same gram. Documents are dealt to shards, and in one plan:

1. each shard sends 32 bits of the grams of its runs to buckets, which answer which occur in several documents;
2. each shard sends its distinct runs with such a gram, with the smallest document of each, to the bucket of the gram;
   there the runs are dealt to a few parts, each with its own transform, and the transforms are merged: the interleave of
   the parts is refined one symbol at a time, without sorting their suffixes together. After ``width`` rounds the rows
   between two boundaries share a prefix of ``width`` bytes: a repeated interval, which gives its smallest document;
3. each shard marks the windows that some smaller document holds and cuts the bytes that they cover.

A gram with very many runs (a template filled in countless ways) is cut into single windows, which are dealt by their own
hash. Copies are reduced to distinct strings before every exchange, so no bucket grows with the number of copies.
"""

from __future__ import annotations

import hashlib


import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .columns import flat, mix, run_hashes, slices

GRAM = 16
SHARD_BYTES = 4 << 20
HOT_RUNS = 1 << 16
MANY = 127  # a gram with fewer runs in a shard sends their number in 7 bits, any other in a list of whole numbers
PARTS = 4
SLICE = 1 << 16
_U = np.uint64


# ---- runs of windows ---------------------------------------------------------


def _grams(text: np.ndarray) -> np.ndarray:
    """A hash of the 16 bytes from each place."""
    x = text.astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | (x[step:] << _U(8 * step))
    return mix(x[:-8] * _U(0x9E3779B97F4A7C15) + (x[8:] ^ (x[8:] >> _U(29))))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def window_runs(text: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, gram, row) of each run; a run has at most ``width - GRAM + 1`` windows."""
    most, parts = width - GRAM + 1, []
    for a, b in slices(starts, SLICE):
        part, own = text[starts[a] : starts[b]], starts[a : b + 1] - starts[a]
        if len(part) < width:
            continue
        least = _least(_grams(part), most)
        size = np.maximum(np.diff(own) - width + 1, 0)
        row = np.repeat(np.arange(a, b), size)
        if not len(row):
            continue
        first = np.cumsum(size) - size
        place = np.arange(len(row)) - np.repeat(first - own[:-1], size)
        gram = least[place]
        new = np.ones(len(row), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])
        opened = np.flatnonzero(new)
        within = np.arange(len(row)) - np.repeat(opened, np.diff(np.append(opened, len(row))))
        opened = np.flatnonzero(within % most == 0)
        parts.append((place[opened] + starts[a], np.diff(np.append(opened, len(row))), gram[opened], row[opened]))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(p) for p in zip(*parts))


def _names(gram: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each gram and the 32 bits that are sent there."""
    return (gram >> _U(32)) % _U(buckets) << _U(32) | gram & _U(0xFFFFFFFF)


def _split_hot(runs: tuple, hot: np.ndarray, buckets: int) -> tuple:
    """The runs, with those of a hot gram cut into single windows. Hot grams are named alike to all shards that hold them."""
    place, count, gram, row = runs
    cut = np.isin(_names(gram, buckets), hot) if len(hot) else np.zeros(len(gram), bool)
    if not cut.any():
        return (*runs, np.zeros(len(place), bool))
    times = np.where(cut, count, 1)
    index = np.repeat(np.arange(len(place)), times)
    shift = np.arange(len(index)) - np.repeat(np.cumsum(times) - times, times)
    return place[index] + shift, np.where(cut[index], 1, count[index]), gram[index], row[index], cut[index]


def _hashes(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of many sorted short runs, a slice of the text at a time."""
    out = np.empty(len(begin), np.uint64)
    at = 0
    while at < len(begin):
        to = max(int(np.searchsorted(begin, begin[at] + SLICE)), at + 1)
        low = begin[at]
        out[at:to] = run_hashes(text[low : end[at:to].max()], begin[at:to] - low, end[at:to] - low)
        at = to
    return out


def _firsts(sorted_values: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(sorted_values), bool)
    fresh[1:] = sorted_values[1:] != sorted_values[:-1]
    return np.flatnonzero(fresh)


def _own_text(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ids of the rows that have an id."""
    table = table.filter(pc.is_valid(table["doc_id"]))
    text, starts = flat(table["text"])
    return text, starts, table["doc_id"].to_numpy()


def _pick(text: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of the given runs, one after another."""
    shift = np.cumsum(size) - size
    return text[np.arange(int(size.sum())) + np.repeat(begin - shift, size)]


def _cells(table: pa.Table, column: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(cell.as_buffer(), kind) for cell in table[column]]


# ---- step 1: grams that occur in several documents -----------------------------


def _send_grams(width: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        text, starts, ids = _own_text(table)
        _, _, gram, row = window_runs(text, starts, width)
        order = np.argsort(gram, kind="stable")
        gram, owner = gram[order], ids[row[order]]
        first = _firsts(gram)
        out = []
        if len(first):
            several = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
            runs = np.diff(np.append(first, len(gram)))
            times = np.minimum(runs, MANY).astype(np.uint8) | (several.astype(np.uint8) << 7)
            gram = gram[first]
            bucket = (_names(gram, buckets) >> _U(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            gram, times, runs = gram[order], times[order], runs[order]
            for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
                if j > i:
                    many = runs[i:j][runs[i:j] >= MANY]
                    out.append((k, shard, gram[i:j].astype(np.uint32).tobytes(), times[i:j].tobytes(), many.astype(np.int64).tobytes()))
        return pa.Table.from_pylist(
            [dict(zip(("bucket", "shard", "gram", "times", "many"), r)) for r in out],
            pa.schema([("bucket", pa.int64()), ("shard", pa.int64()), *((n, pa.binary()) for n in ("gram", "times", "many"))]),
        )

    return run


_GRAMS = "bucket bigint, shard bigint, gram binary, times binary, many binary"


def _answer_grams(hot_runs: int):
    def run(table: pa.Table) -> pa.Table:
        grams, times = _cells(table, "gram", np.uint32), _cells(table, "times", np.uint8)
        every, times = np.concatenate(grams), np.concatenate(times)
        count = (times & MANY).astype(np.int64)
        count[count == MANY] = np.concatenate(_cells(table, "many", np.int64))
        order = np.argsort(every, kind="stable")
        ordered = every[order]
        first = _firsts(ordered)
        size = np.diff(np.append(first, len(every)))
        several = (size > 1) | (np.maximum.reduceat(times[order], first) > MANY)
        hot = np.add.reduceat(count[order], first) > hot_runs
        keep = np.zeros(len(every), np.uint8)
        keep[order] = np.repeat(np.where(several, 1 + hot, 0), size)
        rows, bucket, low = [], _U(table["bucket"][0].as_py() << 32), 0
        for shard, gram in zip(table["shard"].to_pylist(), grams):
            mine, low = keep[low : low + len(gram)], low + len(gram)
            if mine.any():
                rows.append({"shard": shard, "gram": gram[mine > 0].tobytes(), "hot": (gram[mine > 1] | bucket).tobytes()})
        return pa.Table.from_pylist(rows, pa.schema([("shard", pa.int64()), ("gram", pa.binary()), ("hot", pa.binary())]))

    return run


# ---- step 2: repeated intervals ------------------------------------------------


def _send_runs(width: int, gram_buckets: int, buckets: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema([("bucket", pa.int64()), ("shard", pa.int64()), *((n, pa.binary()) for n in ("hash", "owner", "size", "bytes"))])
        if not len(table) or not len(answers):
            return schema.empty_table()
        shard = table["shard"][0].as_py()
        text, starts, ids = _own_text(table)
        wanted = np.sort(np.concatenate(_cells(answers, "gram", np.uint32)))
        place, count, gram, row, cut = _split_hot(window_runs(text, starts, width), np.concatenate(_cells(answers, "hot", np.uint64)), gram_buckets)
        half = gram.astype(np.uint32)
        hit = wanted[np.minimum(np.searchsorted(wanted, half), len(wanted) - 1)] == half
        place, count, gram, row, cut = place[hit], count[hit], gram[hit], row[hit], cut[hit]
        size = count + width - 1
        marks, owner = _hashes(text, place, place + size), ids[row]
        order = np.lexsort((owner, marks))
        order = order[_firsts(marks[order])]
        bucket = (np.where(cut, marks, gram)[order] >> _U(20)) % _U(buckets)
        order = order[np.argsort(bucket, kind="stable")]
        bucket = (np.where(cut, marks, gram)[order] >> _U(20)) % _U(buckets)
        edges = np.append(_firsts(bucket), len(order)) if len(order) else np.zeros(1, np.int64)
        rows = []
        for i, j in zip(edges, edges[1:]):
            own = order[i:j]
            cells = marks[own], owner[own], size[own].astype(np.uint16), _pick(text, place[own], size[own])
            rows.append({"bucket": int(bucket[i]), "shard": shard} | {n: c.tobytes() for n, c in zip(("hash", "owner", "size", "bytes"), cells)})
        return pa.Table.from_pylist(rows, schema)

    return run


_RUNS = "bucket bigint, shard bigint, hash binary, owner binary, size binary, bytes binary"


class Strings:
    """Strings that each end with symbol 0, laid end to end and read as circles."""

    def __init__(self, size: np.ndarray, data: np.ndarray):
        n = len(size)
        self.begin = np.cumsum(size + 1) - size - 1
        self.symbols = np.zeros(int(size.sum()) + n, np.uint8)
        inside = np.ones(len(self.symbols), bool)
        inside[self.begin + size] = False
        self.symbols[inside] = data + 1  # the byte 255 never occurs in UTF-8
        self.string = np.repeat(np.arange(n), size + 1)
        self.around = (size + 1)[self.string]
        self.place = np.arange(len(self.symbols))
        self.offset = self.place - self.begin[self.string]

    def ahead(self, steps: int) -> np.ndarray:
        """The place that many symbols further in the same string."""
        return self.place + steps - np.where(self.offset + steps >= self.around, self.around, 0)

    def behind(self, steps: int) -> np.ndarray:
        return self.place - steps + np.where(self.offset < steps, self.around, 0)


def _dense(codes: np.ndarray, bound: int) -> tuple[np.ndarray, int]:
    """Codes below ``bound`` renumbered without gaps in the same order, and how many there are."""
    seen = np.zeros(bound, bool)
    seen[codes] = True
    return (np.cumsum(seen) - 1)[codes], int(np.count_nonzero(seen))


def symbol_steps(strings: Strings) -> tuple[int, np.ndarray]:
    """How many symbols a round can put in front of a row, 4 or 2, and their code (16 bits, in order) from each place."""
    pair, count = _dense(strings.symbols.astype(np.int64) * 256 + strings.symbols[strings.ahead(1)], 1 << 16)
    if count * count <= 1 << 24:
        four, several = _dense(pair * count + pair[strings.ahead(2)], count * count)
        if several <= 1 << 16:
            return 4, four.astype(np.uint16)
    return 2, pair.astype(np.uint16)


def suffix_order(strings: Strings, low: int, high: int, depth: int) -> np.ndarray:
    """The places from ``low`` to ``high`` (whole strings) sorted by at least ``depth`` symbols, by doubling ranks."""
    key = strings.symbols[low:high].astype(np.uint64)
    length = 1
    while True:
        if length < 8:
            after = key
        else:
            order = np.argsort(key)
            if length >= depth:
                return order + low
            ordered = key[order]
            after = np.empty(high - low, np.uint64)
            after[order] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]])).astype(np.uint64)
        shift = _U(8 * length if length < 8 else 32)
        over = strings.offset[low:high] + length >= strings.around[low:high]
        key = (after << shift) | after[np.arange(length, high - low + length) - np.where(over, strings.around[low:high], 0)]
        length *= 2


def merge_transforms(columns: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The interleave of the rows of several transforms, and the blocks of rows that agree in the symbols put in front.

    ``columns`` has for each round the transform of each part: for each of its rows, in order, the symbols before it. Row
    by row, the interleave holds the number of the part that the next row is taken from. A round deals the rows by the
    symbols before them and keeps their order otherwise, which puts these symbols in front of each row. Two neighbours
    stay in one block as long as these symbols and the blocks they came from agree: their common prefix is as long as
    all rounds so far. No suffixes of different parts are ever compared.
    """
    size = [len(part) for part in columns[0]]
    source = np.repeat(np.arange(len(size), dtype=np.int32), size)
    block = np.zeros(len(source), np.int32)
    symbol, fresh = np.empty(len(source), np.uint16), np.zeros(len(source), bool)
    for parts in columns:
        for k, part in enumerate(parts):
            symbol[source == k] = part
        order = np.argsort(symbol, kind="stable")
        packed = (block << 3 | source)[order]
        dealt, block, source = symbol[order], packed >> 3, packed & 7
        fresh[1:] = (dealt[1:] != dealt[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(fresh, dtype=np.int32)
    return source, block


def _intervals(size: np.ndarray, data: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, first window, end) of the runs of windows that a string of a smaller owner holds as well."""
    strings = Strings(size, data)
    begin, string, total = strings.begin, strings.string, len(strings.symbols)
    edges = np.searchsorted(begin, np.arange(1, PARTS) * total // PARTS)
    edges = np.append(begin, total)[np.unique(np.concatenate([[0], edges, [len(size)]]))]
    orders = [suffix_order(strings, low, high, width) for low, high in zip(edges, edges[1:])]
    step, codes = symbol_steps(strings)
    single, several = strings.symbols[strings.behind(1)].astype(np.uint16), codes[strings.behind(step)]
    rounds = [single] * (width % step) + [several] * (width // step)
    cells = {id(column): [column[order] for order in orders] for column in (single, several)}
    source, block = merge_transforms([cells[id(column)] for column in rounds])
    place = np.empty(total, np.int64)
    for k, order in enumerate(orders):
        place[source == k] = order
    window = strings.offset[place] + width < strings.around[place]
    place, block = place[window], block[window]
    first = _firsts(block)
    holder = owner[string[place]]
    least = np.repeat(np.minimum.reduceat(holder, first), np.diff(np.append(first, len(block))))
    smaller = np.zeros(total + 1, bool)
    smaller[place] = least < holder
    opens = np.flatnonzero(smaller[:-1] & ~np.concatenate([[False], smaller[:-2]]))
    closes = np.flatnonzero(smaller[:-1] & ~smaller[1:]) + 1
    of = string[opens]
    return of, opens - begin[of], closes - begin[of]


def _sharing(values: np.ndarray, string: np.ndarray) -> np.ndarray:
    """The strings that have a value which another string has as well."""
    order = np.argsort(values, kind="stable")
    values, string = values[order], string[order]
    first = _firsts(values)
    if not len(first):
        return string
    several = np.minimum.reduceat(string, first) != np.maximum.reduceat(string, first)
    return string[np.repeat(several, np.diff(np.append(first, len(values))))]


def _partnered(size: np.ndarray, data: np.ndarray, width: int) -> np.ndarray:
    """Which distinct strings may share a window with another one.

    A window that holds the gram of its run also holds the bytes on its left or on its right, as far as they always fit; a
    string whose contexts, of every place where it holds the gram, occur in no other string shares no window.
    """
    begin, more = np.cumsum(size) - size, (width - GRAM) // 2
    string = np.repeat(np.arange(len(size)), size)
    grams = np.append(_grams(data), np.full(GRAM - 1, ~_U(0)))
    left = size[string] - (np.arange(len(data)) - begin[string])
    grams[left < GRAM] = ~_U(0)
    found = np.flatnonzero(grams == np.minimum.reduceat(grams, begin)[string])
    string, out = string[found], np.zeros(len(size), bool)
    opens, closes = begin[string], (begin + size)[string]
    low, high = found - more, found + GRAM + more
    lefts = run_hashes(data, np.maximum(low, opens), found + GRAM)
    rights = run_hashes(data, found, np.minimum(high, closes))
    for values, valid in ((lefts, low >= opens), (rights, high <= closes)):
        out[_sharing(values[valid], string[valid])] = True
    return out


def _answer_runs(width: int):
    def run(table: pa.Table) -> pa.Table:
        marks, owner, size = (_cells(table, n, k) for n, k in (("hash", np.uint64), ("owner", np.int64), ("size", np.uint16)))
        data = np.concatenate(_cells(table, "bytes", np.uint8))
        shard = np.repeat(table["shard"].to_numpy(), [len(m) for m in marks])
        marks, owner, size = np.concatenate(marks), np.concatenate(owner), np.concatenate(size).astype(np.int64)
        begin = np.cumsum(size) - size
        order = np.lexsort((owner, marks))
        first = _firsts(marks[order])
        chosen = order[first]  # of each distinct string, the one of the smallest document
        string = np.empty(len(marks), np.int64)
        string[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(marks))))
        able = np.flatnonzero(_partnered(size[chosen], _pick(data, begin[chosen], size[chosen]), width))
        few = chosen[able]
        of = low = high = np.zeros(0, np.int64)
        if len(few):
            of, low, high = _intervals(size[few], _pick(data, begin[few], size[few]), owner[few], width)
            of = able[of]
        least = owner[chosen][string]
        whole = np.flatnonzero(owner > least)
        part = np.flatnonzero(owner == least)
        a, b = np.searchsorted(of, string[part]), np.searchsorted(of, string[part], side="right")
        times = b - a
        index = np.arange(int(times.sum())) + np.repeat(a - (np.cumsum(times) - times), times)
        entry = np.concatenate([whole, np.repeat(part, times)])
        low = np.concatenate([np.zeros(len(whole), np.int64), low[index]]).astype(np.uint16)
        high = np.concatenate([size[whole] - width + 1, high[index]]).astype(np.uint16)
        order = np.argsort(shard[entry], kind="stable")
        entry, low, high = entry[order], low[order], high[order]
        edges = np.append(_firsts(shard[entry]), len(entry)) if len(entry) else np.zeros(1, np.int64)
        rows = [
            {"shard": int(shard[entry[i]]), "hash": marks[entry[i:j]].tobytes(), "low": low[i:j].tobytes(), "high": high[i:j].tobytes()}
            for i, j in zip(edges, edges[1:])
        ]
        return pa.Table.from_pylist(rows, pa.schema([("shard", pa.int64()), *((n, pa.binary()) for n in ("hash", "low", "high"))]))

    return run


# ---- step 3: the documents without the repeats -----------------------------------


def _covered(text: np.ndarray, starts: np.ndarray, ids: np.ndarray, width: int, buckets: int, table: pa.Table) -> np.ndarray:
    """Which bytes some window of a smaller document covers."""
    hot = np.concatenate([np.zeros(0, np.uint64), *_cells(table.filter(pc.is_valid(table["hot"])), "hot", np.uint64)])
    found = table.filter(pc.is_valid(table["hash"]))
    place, count, _, row, _ = _split_hot(window_runs(text, starts, width), hot, buckets)
    marks, owner = _hashes(text, place, place + count + width - 1), ids[row]
    cover = np.zeros(len(text) + 1, np.int32)

    order = np.lexsort((owner, marks))
    first = _firsts(marks[order])
    least = np.empty(len(marks), np.int64)
    least[order] = np.repeat(owner[order][first], np.diff(np.append(first, len(marks))))
    later = owner > least  # the whole run is in a smaller document of this shard
    np.add.at(cover, place[later], 1)
    np.add.at(cover, (place + count + width - 1)[later], -1)

    if len(found):
        known, low, high = (np.concatenate(_cells(found, n, k)) for n, k in (("hash", np.uint64), ("low", np.uint16), ("high", np.uint16)))
        order = np.argsort(known, kind="stable")
        known, low, high = known[order], low[order].astype(np.int64), high[order].astype(np.int64)
        rest = np.flatnonzero(~later)
        a, b = np.searchsorted(known, marks[rest]), np.searchsorted(known, marks[rest], side="right")
        times = b - a
        index = np.arange(int(times.sum())) + np.repeat(a - (np.cumsum(times) - times), times)
        begin = place[np.repeat(rest, times)]
        np.add.at(cover, begin + low[index], 1)
        np.add.at(cover, begin + high[index] + width - 1, -1)
    return np.cumsum(cover[:-1]) > 0


def _cut(width: int, buckets: int, with_text: bool):
    def run(table: pa.Table, messages: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table["doc_id"], null_placement="at_end"))
        text, starts, ids = _own_text(table)
        gone = _covered(text, starts, ids, width, buckets, messages) if len(ids) else np.zeros(0, bool)
        if len(table) > len(ids):  # rows without id stay whole
            text, starts = flat(table["text"])
            gone = np.concatenate([gone, np.zeros(len(text) - len(gone), bool)])
        out = {n: [] for n in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")}
        for a, b in zip(starts, starts[1:]):
            mask, part = gone[a:b], text[a:b]
            left = part[~mask].tobytes() if mask.any() else part.tobytes()
            out["n_bytes"].append(int(b - a))
            out["n_removed"].append(int(b - a) - len(left))
            out["n_spans"].append(int(np.count_nonzero(mask[1:] & ~mask[:-1]) + mask[:1].sum()))
            out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
            if with_text:
                out["kept_text"].append(left.decode("utf-8", "ignore"))
        cells = {"doc_id": table["doc_id"], "rest": table["rest"]} | {n: pa.array(v, pa.string() if n[0] == "k" else pa.int64()) for n, v in out.items()}
        if not with_text:
            cells["kept_text"] = pa.nulls(len(table), pa.string())
        return pa.table(cells)

    return run


def cut_repeats(
    docs: DataFrame, width: int = 50, with_text: bool = True, id_column: str = "doc_id", text_column: str = "text",
    shard_bytes: int = SHARD_BYTES, hot_runs: int = HOT_RUNS,
) -> DataFrame:
    """The documents without each byte that a string of ``width`` bytes covers which also starts in a smaller document.

    Strings are judged on the input, overlaps count, and matches never cross documents. Returns doc_id, rest (a struct of
    all columns of ``docs``), n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and kept_text (null unless
    ``with_text``; what is left of a cut character is dropped from it, not from the checksum).

    Null text is empty; texts under ``width`` bytes stay whole. Repeated rows with one id don't remove each other. Rows
    with a null id stay whole and remove nothing. ``rest`` keeps any other column apart, whatever its name. An empty table
    gives no row.
    """
    rest = F.struct(*[F.col(c) for c in docs.columns if c != text_column]) if len(docs.columns) > 1 else F.struct(F.lit(0).alias("none"))
    rest_type = docs.select(rest.alias("rest")).schema["rest"].dataType
    total = docs.agg(F.sum(F.octet_length(text_column).cast("bigint"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    buckets = max(1, -(-total // (4 * shard_bytes)))
    dealt = docs.select(
        F.pmod(F.xxhash64(F.col(id_column).cast("bigint")), F.lit(shards)).alias("shard"),
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"), rest.alias("rest"),
    )
    by_shard = dealt.groupBy("shard")
    grams = by_shard.applyInArrow(_send_grams(width, buckets), _GRAMS)
    answers = grams.groupBy("bucket").applyInArrow(_answer_grams(hot_runs), "shard bigint, gram binary, hot binary")
    runs = by_shard.cogroup(answers.groupBy("shard")).applyInArrow(_send_runs(width, buckets, shards), _RUNS)
    found = runs.groupBy("bucket").applyInArrow(_answer_runs(width), "shard bigint, hash binary, low binary, high binary")
    nothing = F.lit(None).cast("binary")
    hot = answers.where("octet_length(hot) > 0").select("shard", nothing.alias("hash"), nothing.alias("low"), nothing.alias("high"), "hot")
    messages = found.withColumn("hot", nothing).union(hot)
    schema = StructType(
        [StructField("doc_id", LongType()), StructField("rest", rest_type)]
        + [StructField(n, LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
        + [StructField(n, StringType()) for n in ("kept_sha256", "kept_text")]
    )
    return by_shard.cogroup(messages.groupBy("shard")).applyInArrow(_cut(width, buckets, with_text), schema)
