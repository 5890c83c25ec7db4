"""Scores of peptides against spectra, a block of both at a time, without a row for each pair.

Few spectra (size checked) go to every task and the peptides stay where they are. Otherwise both sides meet in cells.
Peptides are cut into blocks in mass order, of about equal counts, from a histogram of their masses whose size is bounded
by the mass range. A spectrum goes to the blocks that its window touches. A block with much work is cut further, into
parts of its peptides times parts of its spectra, in the shape that copies the fewest bytes.

In a block the peptides lie in mass order, so the candidates of a spectrum are a run of them, and an index lists for each
fragment bin the peptides that have an ion there. Only bins at a strong peak add to a score, all others are zero or take
away. So the sum over the bins at strong peaks is an upper bound. The lists of those bins are read from the highest value
on; once a few peptides are scored exactly, those whose sum so far and all values to come stay below the n-th best
score are let go, and the remaining lists are skipped when few are left.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import FRAGMENT_BIN, FRAGMENT_OFFSET
from ..operators.joins import small_enough
from ..operators.packed import packed, unpack
from .digest import fragment_lists
from .spectra import INTENSITY_UNIT, OFFSET_BINS, XCORR_SCALE, dense_values
from .texts import flat_text

# Most rows of the histogram of masses that the driver cuts into blocks.
MOST_FINE_BINS = 400_000
PEPTIDES_PER_BLOCK = 50_000
PAIRS_PER_CELL = 100_000_000
ROWS_AT_ONCE = 10_000  # peptides whose fragments are computed together
CHUNK = 400_000  # peptides of a task that are scored together where spectra are in every task: each chunk meets every spectrum
SCORED_AT_ONCE = 2_000
FEW = 32  # peptides that are scored at once instead of reading further lists

SPECTRUM_COLUMNS = ["source_file", "spectrum_id", "charge", "low_uda", "high_uda", "bins", "values"]
_HIT = pa.struct([("peptide", pa.string()), ("accession", pa.string()), ("xcorr_sum", pa.int64())])
SUMMARY = (
    "source_file string, spectrum_id string, charge int, n_candidates bigint, n_scored bigint,"
    " hits array<struct<peptide: string, accession: string, xcorr_sum: bigint>>, score_bins array<int>, score_counts array<bigint>"
)
_SUMMARY_ARROW = pa.schema(
    [("source_file", pa.string()), ("spectrum_id", pa.string()), ("charge", pa.int32()), ("n_candidates", pa.int64()), ("n_scored", pa.int64()),
     ("hits", pa.list_(_HIT)), ("score_bins", pa.list_(pa.int32())), ("score_counts", pa.list_(pa.int64()))]
)
PAIRS = "source_file string, spectrum_id string, charge int, peptide string, accession string, xcorr_sum bigint"


@dataclass(frozen=True)
class Rules:
    """How fragments are binned and what is kept of the scores.

    ``n`` best peptides of each spectrum; with ``score_bins`` a histogram of all scores, so many bins to a unit of xcorr.
    ``flanking`` adds half of the value of both neighbouring bins at each fragment. ``added`` has the masses of the marks of
    modified residues. A spectrum with at least ``lists_from`` candidates in a block is scored by the lists of its bins;
    fewer are scored at once, which takes less time than to read the lists.
    """

    n: int = 5
    fragment_bin: float = FRAGMENT_BIN
    fragment_offset: float = FRAGMENT_OFFSET
    max_charge: int = 3
    flanking: bool = False
    score_bins: int | None = None
    added: tuple[int, ...] = ()
    lists_from: int = 20_000

    @property
    def unit(self) -> float:
        return float(INTENSITY_UNIT * 2 * OFFSET_BINS * (2 if self.flanking else 1))

    def xcorr(self, sums: np.ndarray) -> np.ndarray:
        return sums.astype(np.float64) * XCORR_SCALE / self.unit


class Index:
    """The fragment bins of the peptides of a block, for ions up to one charge: by peptide, and on demand by bin."""

    def __init__(self, row: np.ndarray | None, bins: np.ndarray, n: int, start: np.ndarray | None = None):
        self.start = np.searchsorted(row, np.arange(n + 1)) if start is None else start
        self.bins, self.size = bins.astype(np.int32, copy=False), int(bins.max(initial=0)) + 1
        self._lists = None

    def list_of(self, code: int) -> np.ndarray:
        """The peptides that have an ion in a bin, in mass order."""
        if self._lists is None:
            # both in one number, so that one plain sort puts the peptides of a bin next to each other
            keys = self.bins.astype(np.int64) << 32
            keys |= np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))
            keys.sort()
            starts = np.searchsorted(keys, np.arange(self.size + 1) << 32)
            self._lists = keys.astype(np.int32), starts  # the lower half is the peptide
        peptides, starts = self._lists
        return peptides[starts[code] : starts[code + 1]]

    def exact(self, values: np.ndarray, low: int, high: int) -> np.ndarray:
        """The scores of a run of peptides, given the value at each bin of the index."""
        scores = np.empty(high - low, np.int64)
        for at in range(low, high, SCORED_AT_ONCE):  # few enough to stay in the cache
            to = min(at + SCORED_AT_ONCE, high)
            a, b = self.start[at], self.start[to]
            sums = np.zeros(b - a + 1, np.int64)
            np.cumsum(values.take(self.bins[a:b]), out=sums[1:])
            ends = sums.take(self.start[at : to + 1] - a)
            np.subtract(ends[1:], ends[:-1], out=scores[at - low : to - low])
        return scores

    def exact_of(self, values: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        lengths = self.start[chosen + 1] - self.start[chosen]
        ends = np.cumsum(lengths)
        spots = np.repeat(self.start[chosen] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        sums = np.concatenate([[0], np.cumsum(values[self.bins[spots]])])
        return sums[ends] - sums[ends - lengths]

    def best(self, values: np.ndarray, low: int, high: int, n: int, floor: int | None) -> tuple[np.ndarray, np.ndarray, int]:
        """Peptides of a run that may be among the ``n`` best, their scores, and how many were scored.

        Nothing at or above the n-th best score, or above ``floor`` where that is higher, is missing.
        """
        gains = np.flatnonzero(values > 0)
        gains = gains[np.argsort(-values[gains], kind="stable")]
        rest = np.concatenate([np.cumsum(values[gains][::-1])[::-1], [0]])
        bound, alive, scored, left = np.zeros(high - low, np.int64), None, 0, 0
        checks = {len(gains) // 4, len(gains) // 2, 3 * len(gains) // 4}
        for k, code in enumerate(gains.tolist()):
            if k in checks and high - low > FEW:
                top = np.argpartition(-bound, min(n, high - low - 1))[:n]
                exact = self.exact_of(values, top + low)
                scored += len(top)
                if len(top) >= n and (floor is None or exact.min() > floor):
                    floor = int(exact.min())
                if floor is not None:
                    alive = np.flatnonzero(bound + rest[k] >= floor)
                    if len(alive) <= FEW:
                        left = int(rest[k])
                        break
            own = self.list_of(code)
            own = own[np.searchsorted(own, low) : np.searchsorted(own, high)]
            bound[own - low] += values[code]
        else:
            alive = np.arange(high - low) if floor is None else np.flatnonzero(bound >= floor)
        # the highest bounds first: each batch may raise the floor above all others
        alive = alive[np.argsort(-bound[alive], kind="stable")]
        upper = bound[alive] + left
        chosen, scores, at = [], [], 0
        while at < len(alive) and (floor is None or upper[at] >= floor):
            part = alive[at : at + 4 * n + FEW]
            exact = self.exact_of(values, part + low)
            chosen.append(part)
            scores.append(exact)
            scored += len(part)
            at += len(part)
            every = np.concatenate(scores)
            if len(every) >= n:
                nth = int(np.partition(every, len(every) - n)[len(every) - n])
                floor = nth if floor is None else max(floor, nth)
        if not chosen:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), scored
        return np.concatenate(chosen) + low, np.concatenate(scores), scored


class Block:
    """Peptides in mass order with an index for each number of ion charges, made when it is asked for."""

    def __init__(self, peptides: pa.Table, rules: Rules):
        order = pc.sort_indices(peptides, [("mass_uda", "ascending"), ("sequence", "ascending")])
        peptides = peptides.take(order)
        self.rules = rules
        self.sequence, self.accession = (peptides[c].combine_chunks() for c in ("sequence", "accession"))
        self.mass = peptides["mass_uda"].to_numpy()
        self.text, self.bounds = flat_text(self.sequence)
        if self.text.max(initial=0) > 127:  # a letter outside ASCII weighs nothing, like B, J, X and Z
            self.text = np.frombuffer("".join(self.sequence.to_pylist()).encode("ascii", "replace"), dtype=np.uint8)
            self.bounds = np.concatenate([[0], np.cumsum(pc.utf8_length(self.sequence).to_numpy(zero_copy_only=False).astype(np.int64))])
        self.indexes: dict[int, Index] = {}
        self.reach: dict[int, np.ndarray] | None = None

    def level(self, charge: int) -> int:
        """Spectra of a charge are compared with ions of charge 1 to ``charge`` - 1, at least 1."""
        return max(1, min(self.rules.max_charge, charge - 1))

    def only_for(self, charge: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """From now on the block is used for these spectra only: fragments of a level are made where one of them looks."""
        first, last = np.searchsorted(self.mass, low), np.searchsorted(self.mass, high, side="right")
        self.reach = {}
        for own in np.unique(charge).tolist():
            met, some = self.reach.setdefault(self.level(own), np.zeros(len(self.mass) + 1, np.int64)), (charge == own) & (first < last)
            np.add.at(met, first[some], 1)
            np.add.at(met, last[some], -1)
        self.reach = {k: np.cumsum(met)[:-1] > 0 for k, met in self.reach.items()}

    def index(self, charge: int) -> Index:
        """For ions of charge 1 to ``charge`` - 1, at least 1."""
        level, rules = self.level(charge), self.rules
        if level not in self.indexes:
            wanted = None if self.reach is None else self.reach[level]
            parts, starts = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
            for a in range(0, len(self.mass), ROWS_AT_ONCE):
                own, rows = self.bounds[a : a + ROWS_AT_ONCE + 1], slice(a, a + ROWS_AT_ONCE)
                start, bins, _ = fragment_lists(
                    self.text[own[0] : own[-1]], own[1:] - own[0], self.mass[rows], level, rules.fragment_bin, rules.fragment_offset, rules.added,
                    None if wanted is None else wanted[rows],
                )
                parts.append(bins)
                starts.append(start[1:] + starts[-1][-1])
            self.indexes[level] = Index(None, np.concatenate(parts), len(self.mass), np.concatenate(starts))
        return self.indexes[level]

    def run(self, low: int, high: int) -> tuple[int, int]:
        return int(np.searchsorted(self.mass, low)), int(np.searchsorted(self.mass, high, side="right"))


@dataclass
class Summary:
    """What is kept of one spectrum: counts, the best hits so far and the histogram of scores."""

    candidates: int = 0
    scored: int = 0
    hits: list[tuple[int, str, str]] = field(default_factory=list)  # (-score, peptide, protein)
    histogram: dict[int, int] = field(default_factory=dict)

    def add(self, block: Block, charge: int, low: int, high: int, bins: np.ndarray, values: np.ndarray) -> None:
        a, b = block.run(low, high)
        if a == b:
            return
        rules, index = block.rules, block.index(charge)
        at = dense_values(bins, values, index.size, rules.flanking)
        floor = -self.hits[-1][0] if len(self.hits) >= rules.n else None
        if rules.score_bins:
            scores = index.exact(at, a, b)
            place, scored = np.arange(a, b), b - a
            kept, counts = np.unique(np.floor(rules.xcorr(scores) * rules.score_bins).astype(np.int64), return_counts=True)
            for key, count in zip(kept.tolist(), counts.tolist()):
                self.histogram[key] = self.histogram.get(key, 0) + count
        else:
            if b - a < rules.lists_from:
                place, scores, scored = np.arange(a, b), index.exact(at, a, b), b - a
            else:
                place, scores, scored = index.best(at, a, b, rules.n, floor)
        self.candidates += b - a
        self.scored += scored
        if len(scores) > rules.n:
            nth = np.partition(scores, len(scores) - rules.n)[len(scores) - rules.n]
            place, scores = place[scores >= nth], scores[scores >= nth]
        if floor is not None:
            place, scores = place[scores >= floor], scores[scores >= floor]
        if len(place):
            names = block.sequence.take(pa.array(place)).to_pylist()
            proteins = block.accession.take(pa.array(place)).to_pylist()
            self.hits = sorted([*self.hits, *zip((-scores).tolist(), names, proteins)])[: rules.n]


class Spectra:
    """Spectra of a cell or of a whole task as plain arrays."""

    def __init__(self, table: pa.Table):
        self.names = table.select(["source_file", "spectrum_id", "charge"]).to_pylist()
        self.charge, self.low, self.high = (table[c].to_numpy() for c in ("charge", "low_uda", "high_uda"))
        self.bins, self.values = (table[c].combine_chunks() for c in ("bins", "values"))

    def peaks(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        return self.bins[i].values.to_numpy(), self.values[i].values.to_numpy()


def _rows(spectra: Spectra, kept: dict[int, Summary]) -> Iterator[pa.RecordBatch]:
    rows = []
    for i, s in kept.items():
        hits = [{"peptide": p, "accession": a, "xcorr_sum": -v} for v, p, a in s.hits]
        bins = sorted(s.histogram)
        rows.append(
            spectra.names[i]
            | {"n_candidates": s.candidates, "n_scored": s.scored, "hits": hits, "score_bins": bins, "score_counts": [s.histogram[b] for b in bins]}
        )
        if len(rows) == 5000:
            yield pa.RecordBatch.from_pylist(rows, schema=_SUMMARY_ARROW)
            rows = []
    yield pa.RecordBatch.from_pylist(rows, schema=_SUMMARY_ARROW)


def _score(spectra: Spectra, order: np.ndarray, block: Block, kept: dict[int, Summary], once: bool = True) -> None:
    """All spectra against a block; ``order`` is by lower window, so the ones in reach of the block are a run.

    A block that meets other spectra later is not used ``once``.
    """
    if not len(block.mass):
        return
    if once:
        block.only_for(spectra.charge, spectra.low, spectra.high)
    last = int(np.searchsorted(spectra.low[order], block.mass[-1], side="right"))
    for i in order[:last][spectra.high[order[:last]] >= block.mass[0]].tolist():
        summary = kept.get(i) or Summary()
        summary.add(block, int(spectra.charge[i]), int(spectra.low[i]), int(spectra.high[i]), *spectra.peaks(i))
        if summary.candidates:
            kept[i] = summary


def _everywhere(shared, rules: Rules):
    """Summaries of one task's peptides against all spectra."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectra, kept, held, n = Spectra(shared.value), {}, [], 0
        order = np.argsort(spectra.low, kind="stable")

        def flush() -> None:
            if held:
                _score(spectra, order, Block(pa.Table.from_batches(held), rules), kept)

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= CHUNK:
                flush()
                held, n = [], 0
        flush()
        yield from _rows(spectra, kept)

    return run


def _cell(rules: Rules):
    def run(peptides: pa.Table, spectra: pa.Table) -> pa.Table:
        kept: dict[int, Summary] = {}
        if len(peptides) and len(spectra):
            own = Spectra(spectra)
            _score(own, np.argsort(own.low, kind="stable"), Block(peptides, rules), kept)
            return pa.Table.from_batches(list(_rows(own, kept)), schema=_SUMMARY_ARROW)
        return _SUMMARY_ARROW.empty_table()

    return run


def _all_pairs(rules: Rules):
    """A row for each candidate of a cell."""
    schema = pa.schema([("source_file", pa.string()), ("spectrum_id", pa.string()), ("charge", pa.int32()), ("peptide", pa.string()), ("accession", pa.string()), ("xcorr_sum", pa.int64())])

    def run(peptides: pa.Table, spectra: pa.Table) -> pa.Table:
        if not len(peptides) or not len(spectra):
            return schema.empty_table()
        own, block, parts = Spectra(spectra), Block(peptides, rules), []
        block.only_for(own.charge, own.low, own.high)
        for i, name in enumerate(own.names):
            a, b = block.run(own.low[i], own.high[i])
            if a < b:
                index = block.index(int(own.charge[i]))
                scores = index.exact(dense_values(*own.peaks(i), index.size, rules.flanking), a, b)
                fixed = [pa.repeat(pa.scalar(name[c], k), b - a) for c, k in (("source_file", pa.string()), ("spectrum_id", pa.string()), ("charge", pa.int32()))]
                parts.append(pa.RecordBatch.from_arrays([*fixed, block.sequence[a:b], block.accession[a:b], pa.array(scores)], schema=schema))
        return pa.Table.from_batches(parts, schema=schema)

    return run


@dataclass
class Grid:
    """Blocks of peptides in mass order: the fine bin at which each begins, and the parts of its peptides and spectra."""

    fine: int
    first: np.ndarray
    peptide_parts: np.ndarray
    spectrum_parts: np.ndarray

    def block(self, mass: np.ndarray) -> np.ndarray:
        return np.maximum(np.searchsorted(self.first, mass // self.fine, side="right") - 1, 0)

    @property
    def cells(self) -> int:
        return int((self.peptide_parts * self.spectrum_parts).sum())


def mass_grid(peptides: DataFrame, spectra: DataFrame, per_block: int = PEPTIDES_PER_BLOCK, pairs_per_cell: int = PAIRS_PER_CELL) -> Grid:
    """Cut the peptides (sequence, accession, mass_uda) into blocks, and blocks into cells by the spectra that meet there."""
    size = F.octet_length("sequence") + F.coalesce(F.octet_length("accession"), F.lit(0)) + 24
    facts = peptides.agg(F.min("mass_uda").alias("low"), F.max("mass_uda").alias("high"), F.count("*").alias("n"), F.avg(size).alias("bytes")).first()
    fine = max(1, -(-((facts["high"] or 0) - (facts["low"] or 0) + 1) // MOST_FINE_BINS))
    table = peptides.groupBy(F.floor(F.col("mass_uda") / F.lit(fine)).cast("bigint").alias("fine")).agg(F.count("*").alias("n")).toArrow()
    order = np.argsort(table["fine"].to_numpy())
    bins, counts = table["fine"].to_numpy()[order], table["n"].to_numpy()[order]
    per_block = min(per_block, max(1000, (facts["n"] or 0) // (4 * peptides.sparkSession.sparkContext.defaultParallelism)))
    first, sizes = [], []
    for b, n in zip(bins.tolist(), counts.tolist()):
        if not first or sizes[-1] + n > per_block:
            first.append(b)
            sizes.append(0)
        sizes[-1] += n
    grid = Grid(fine, np.array(first or [0], np.int64), np.ones(max(1, len(first)), np.int64), np.ones(max(1, len(first)), np.int64))
    touched = spectra.select("low_uda", "high_uda").mapInArrow(_touched(grid), "block bigint, n bigint").groupBy("block").agg(F.sum("n").alias("n")).toArrow()
    n_spectra = np.zeros(len(grid.first), np.int64)
    n_spectra[touched["block"].to_numpy()] = touched["n"].to_numpy()
    n_peptides = np.array(sizes or [0], np.int64)
    spectrum_bytes = spectra.agg(F.avg(F.size("bins") * 12 + 60).alias("b")).first()["b"] or 1.0
    # cells of a block: parts of peptides copy its spectra, parts of spectra copy its peptides
    need = np.maximum(1, np.ceil(n_peptides * np.maximum(n_spectra, 1) / pairs_per_cell))
    shape = np.sqrt(need * n_peptides * (facts["bytes"] or 1.0) / (np.maximum(n_spectra, 1) * spectrum_bytes))
    grid.peptide_parts = np.maximum(np.clip(np.rint(shape), 1, need), np.ceil(n_peptides / per_block)).astype(np.int64).clip(1)
    grid.spectrum_parts = np.ceil(need / grid.peptide_parts).astype(np.int64).clip(1)
    return grid


def _touched(grid: Grid):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(grid.first) + 1, np.int64)
        for batch in batches:
            np.add.at(total, grid.block(batch.column("low_uda").to_numpy()), 1)
            np.add.at(total, grid.block(batch.column("high_uda").to_numpy()) + 1, -1)
        total = np.cumsum(total)[:-1]
        some = np.flatnonzero(total)
        yield pa.record_batch({"block": pa.array(some), "n": pa.array(total[some])})

    return run


def _spread(grid: Grid, side: str):
    """Copies of each row for the cells that it belongs to: (block, p, s) and the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2000):
                rows = batch.slice(a, 2000)
                salt = rows.column("salt").to_numpy()
                if side == "peptides":
                    place = np.arange(rows.num_rows)
                    block = grid.block(rows.column("mass_uda").to_numpy())
                else:
                    low, high = (grid.block(rows.column(c).to_numpy()) for c in ("low_uda", "high_uda"))
                    place = np.repeat(np.arange(rows.num_rows), high - low + 1)
                    block = np.arange(len(place)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1) + low[place]
                mine, other = (grid.peptide_parts, grid.spectrum_parts) if side == "peptides" else (grid.spectrum_parts, grid.peptide_parts)
                copies = other[block]
                part = np.repeat(salt[place] % mine[block], copies)
                every = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
                block, place = np.repeat(block, copies), np.repeat(place, copies)
                p, s = (part, every) if side == "peptides" else (every, part)
                for k in range(0, len(place), 2000):
                    cut = slice(k, k + 2000)
                    taken = rows.take(pa.array(place[cut])).drop_columns("salt")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(block[cut]), pa.array(p[cut]), pa.array(s[cut]), *taken.columns], names=["block", "p", "s", *taken.schema.names]
                    )

    return run


_SPECTRUM_DDL = (
    "block bigint, p bigint, s bigint, source_file string, spectrum_id string, charge int, low_uda bigint, high_uda bigint,"
    " bins array<bigint>, values array<bigint>"
)
MOST_TASKS = 20_000


def _cells(peptides: DataFrame, spectra: DataFrame, score: Callable[[pa.Table, pa.Table], pa.Table], kinds: str, **sizes) -> DataFrame:
    """What ``score`` gives for the peptides and the spectra of each cell; the peptides of a cell travel packed."""
    grid = mass_grid(peptides, spectra, **sizes)
    tasks, keys = min(grid.cells, MOST_TASKS), ["block", "p", "s"]  # cells are small in bytes and not in work
    salted = F.pmod(F.xxhash64("sequence"), F.lit(1 << 40)).alias("salt")
    rows = peptides.select("sequence", "accession", "mass_uda", salted)
    left, schema = packed(rows, keys, expand=_spread(grid, "peptides"), columns=["sequence", "accession", "mass_uda"])
    salted = F.pmod(F.xxhash64("source_file", "spectrum_id", "charge"), F.lit(1 << 40)).alias("salt")
    right = spectra.select(*SPECTRUM_COLUMNS, salted).mapInArrow(_spread(grid, "spectra"), _SPECTRUM_DDL)
    both = left.repartition(tasks, *keys).groupBy(*keys).cogroup(right.repartition(tasks, *keys).groupBy(*keys))
    return both.applyInArrow(lambda own, others: score(unpack(own, schema), others), kinds)


def score_pairs(peptides: DataFrame, spectra: DataFrame, rules: Rules, **sizes) -> DataFrame:
    """A row for each candidate of each spectrum, with its score."""
    return _cells(peptides, spectra, _all_pairs(rules), PAIRS, **sizes)


# The index of the database that this worker last used, by the name of the search.
_SHARED_BLOCK: dict[str, Block] = {}


def _against_database(shared, rules: Rules):
    """Summaries of a task's spectra against the whole database, whose index a worker makes once."""
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _SHARED_BLOCK:
            _SHARED_BLOCK.clear()
            _SHARED_BLOCK[name] = Block(shared.value, rules)
        block = _SHARED_BLOCK[name]
        for batch in batches:
            spectra, kept = Spectra(pa.Table.from_batches([batch])), {}
            _score(spectra, np.argsort(spectra.low, kind="stable"), block, kept, once=False)
            yield from _rows(spectra, kept)

    return run


def score_with_shared_database(peptides: DataFrame, spectra: DataFrame, rules: Rules, max_bytes: int) -> DataFrame:
    """As ``score_summaries``, with the peptides in every task and each spectrum finished where it is; no shuffle.

    Peptides of more than ``max_bytes`` are not sent round; the cells then give the same summaries.
    """
    peptides, spectra = peptides.select("sequence", "accession", "mass_uda"), spectra.select(*SPECTRUM_COLUMNS)
    if not small_enough(peptides, max_bytes):
        return _cells(peptides, spectra, _cell(rules), SUMMARY)
    shared = spectra.sparkSession.sparkContext.broadcast(peptides.toArrow())
    return spectra.mapInArrow(_against_database(shared, rules), SUMMARY)


def score_summaries(peptides: DataFrame, spectra: DataFrame, rules: Rules, max_broadcast_bytes: int, **sizes) -> DataFrame:
    """For each spectrum and part of the peptides: candidates, scored ones, the best hits and the histogram of scores.

    Summaries of one spectrum add up: counts are summed, and of all hits the best are taken. ``peptides`` (sequence,
    accession, mass_uda) and ``spectra`` (``SPECTRUM_COLUMNS``) are tables that are read more than once. Spectra of at most
    ``max_broadcast_bytes`` go to every task.
    """
    spectra = spectra.select(*SPECTRUM_COLUMNS)
    if max_broadcast_bytes and small_enough(spectra, max_broadcast_bytes):
        shared = spectra.sparkSession.sparkContext.broadcast(spectra.toArrow())
        return peptides.select("sequence", "accession", "mass_uda").mapInArrow(_everywhere(shared, rules), SUMMARY)
    return _cells(peptides, spectra, _cell(rules), SUMMARY, **sizes)
