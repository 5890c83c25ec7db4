"""Several variable modifications at once, enumerated by mass before they are placed.

A peptide gets, first, each choice of how often every modification occurs; that fixes its mass. Choices whose mass lies in
no window of any spectrum are dropped then, before any place is chosen. What is left is placed on the residues.

A modified residue is followed by the number of its modification (``M1``), one at an end is written ``n2`` in front or
``c2`` at the back, so the text says all and sorts the same everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import MASS_RANGE
from ..functions.masses import MICRO
from .digest import FINE
from .texts import flat_text, runs_of, string_array

MOST_IN_ALL = 5
MOST_KINDS = 9
ROWS_AT_ONCE = 100_000  # peptides that are placed together
ROWS_OUT = 50_000


@dataclass(frozen=True)
class Modification:
    """``added`` daltons on any of ``residues`` (``n`` and ``c`` are the ends), at most ``most`` times in a peptide."""

    residues: str
    added: float
    most: int = 3

    @property
    def added_uda(self) -> int:
        return round(self.added * MICRO)


def plain_sequence(peptide: str) -> Column:
    """The residues of a peptide without any mark."""
    return F.upper(F.regexp_replace(peptide, "[nc0-9]", ""))


def _touched(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(most + 2, np.int64)
        for batch in batches:
            low, high = (np.clip(batch.column(c).to_numpy() // FINE, 0, most) for c in ("low_uda", "high_uda"))
            np.add.at(total, low, 1)
            np.add.at(total, high + 1, -1)
        yield pa.record_batch({"bin": pa.array(np.flatnonzero(np.cumsum(total)[: most + 1]))})

    return run


def covered_masses(spectra: DataFrame, mass_range: tuple[float, float] = MASS_RANGE) -> np.ndarray:
    """For each bin of ``FINE`` micro-daltons up to the end of the mass range, whether a spectrum's window meets it."""
    most = int(mass_range[1] * MICRO) // FINE
    rows = spectra.select("low_uda", "high_uda").mapInArrow(_touched(most), "bin bigint").distinct().toArrow()
    out = np.zeros(most + 1, bool)
    out[rows["bin"].to_numpy()] = True
    return out


def choices(sites: list[list[int]], mods: list[Modification], most_in_all: int) -> Iterator[tuple[int, ...]]:
    """How often each modification may occur."""
    for counts in product(*(range(min(m.most, len(s)) + 1) for s, m in zip(sites, mods))):
        if sum(counts) <= most_in_all:
            yield counts


def placements(sites: list[list[int]], counts: tuple[int, ...], taken: frozenset[int] = frozenset()) -> Iterator[dict[int, int]]:
    """All ways to put the modifications on free sites: place -> number of the modification, from 1."""
    if not sites:
        yield {}
        return
    free = [p for p in sites[0] if p not in taken]
    for own in combinations(free, counts[0]):
        for more in placements(sites[1:], counts[1:], taken | set(own)):
            yield dict.fromkeys(own, 1) | {p: k + 1 for p, k in more.items()}


def marked(sequence: str, placed: dict[int, int]) -> str:
    """The text of a peptide with its marks; place -1 is the first end and the length of the sequence the last."""
    if not placed:
        return sequence
    n = len(sequence)
    front = f"n{placed[-1]}" if -1 in placed else ""
    back = f"c{placed[n]}" if n in placed else ""
    return front + "".join(f"{c}{placed[i]}" if i in placed else c for i, c in enumerate(sequence)) + back


def gathered(frames: Iterator[pa.RecordBatch], most: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Batches put together to about ``most`` rows."""
    held, n = [], 0
    for batch in frames:
        held.append(batch)
        n += batch.num_rows
        if n >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def check_modifications(mods: list[Modification]) -> None:
    if not 1 <= len(mods) <= MOST_KINDS:
        raise ValueError(f"between 1 and {MOST_KINDS} modifications")
    for m in mods:
        if not m.residues or not all(c.isupper() or c in "nc" for c in m.residues) or m.most < 1:
            raise ValueError(f"residues are capital letters, n and c, and most is at least 1: {m}")


def with_modifications(
    peptides: DataFrame,
    mods: list[Modification],
    most_in_all: int = MOST_IN_ALL,
    mass_range: tuple[float, float] = MASS_RANGE,
    covered: np.ndarray | None = None,
) -> DataFrame:
    """Every peptide (sequence, mass_uda and other columns) with each placement of the modifications, and ``n_mods``.

    Masses outside ``mass_range`` and, with ``covered`` (see ``covered_masses``), those that no spectrum asks for are left
    out. No shuffle: a peptide is enumerated in the row it is in.
    """
    check_modifications(mods)
    low, high = int(mass_range[0] * MICRO), int(mass_range[1] * MICRO)
    shared = None if covered is None else peptides.sparkSession.sparkContext.broadcast(np.packbits(covered))
    n_bins = 0 if covered is None else len(covered)
    added = [m.added_uda for m in mods]
    others = [f for f in peptides.schema if f.name not in ("sequence", "mass_uda", "n_mods")]

    plain = all(m.residues.isupper() for m in mods)  # no ends

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if shared is None else np.unpackbits(shared.value, count=n_bins).astype(bool)

        def usable(mass: int) -> bool:
            return low <= mass <= high and (wanted is None or (0 <= mass // FINE < n_bins and wanted[mass // FINE]))

        def usable_rows(total: np.ndarray) -> np.ndarray:
            able = (total >= low) & (total <= high)
            if wanted is not None:
                spot = total // FINE
                inside = (spot >= 0) & (spot < n_bins)
                able &= inside & wanted[np.where(inside, spot, 0)]
            return able

        for batch in gathered(frames) if plain else frames:
            if plain and (text := flat_text(batch.column("sequence")))[0].max(initial=0) < 128:
                yield from by_pattern(batch, *text, usable_rows)
                continue
            owner, texts, masses, counted = [], [], [], []
            for k, (sequence, mass) in enumerate(zip(batch.column("sequence").to_pylist(), batch.column("mass_uda").to_pylist())):
                sites = [
                    [-1] * ("n" in m.residues) + [i for i, c in enumerate(sequence) if c in m.residues] + [len(sequence)] * ("c" in m.residues)
                    for m in mods
                ]
                for counts in choices(sites, mods, most_in_all):
                    total = mass + sum(c * a for c, a in zip(counts, added))
                    if usable(total):
                        for placed in placements(sites, counts):
                            owner.append(k)
                            texts.append(marked(sequence, placed))
                            masses.append(total)
                            counted.append(sum(counts))
                if len(texts) > 50_000:
                    yield table(batch, owner, texts, masses, counted)
                    owner, texts, masses, counted = [], [], [], []
            yield table(batch, owner, texts, masses, counted)

    kind_of = np.zeros(256, np.int64)  # the modifications that a residue can bear, as bits
    for k, m in enumerate(mods if plain else []):
        kind_of[[ord(c) for c in set(m.residues)]] |= 1 << k
    known: dict[bytes, list[tuple[int, np.ndarray, np.ndarray]]] = {}

    def placed_on(pattern: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """For peptides whose modifiable residues are of these kinds: added mass, and the residues and marks of each placement."""
        if (name := pattern.tobytes()) not in known:
            if len(known) > 10_000:
                known.clear()
            sites = [np.flatnonzero(pattern >> k & 1).tolist() for k in range(len(mods))]
            found = []
            for counts in choices(sites, mods, most_in_all):
                ways = [sorted(w.items()) for w in placements(sites, counts)]
                if ways:
                    both = np.array(ways, np.int64).reshape(len(ways), sum(counts), 2)
                    found.append((sum(c * a for c, a in zip(counts, added)), both[:, :, 0], both[:, :, 1]))
            known[name] = found
        return known[name]

    def by_pattern(batch: pa.RecordBatch, text: np.ndarray, bounds: np.ndarray, usable_rows) -> Iterator[pa.RecordBatch]:
        """Peptides with the same kinds of modifiable residues in the same order are placed together."""
        kinds = kind_of[text]
        sites = np.flatnonzero(kinds)
        first = np.searchsorted(sites, bounds)
        counts, mass = np.diff(first), batch.column("mass_uda").to_numpy()
        for count in np.unique(counts).tolist():
            rows = np.flatnonzero(counts == count)
            at = first[rows][:, None] + np.arange(count)
            patterns = kinds[sites[at]].astype(np.int16)
            if count:
                whole = np.ascontiguousarray(patterns).view(np.dtype((np.void, 2 * count))).ravel()
                order = np.argsort(whole, kind="stable")
                edges = [0, *(np.flatnonzero(whole[order][1:] != whole[order][:-1]) + 1).tolist(), len(rows)]
            else:
                order, edges = np.arange(len(rows)), [0, len(rows)]
            held = []
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                own = rows[order[a:b]]
                for extra, spots, marks in placed_on(patterns[order[a]].astype(np.int64)):
                    total = mass[own] + extra
                    able = own[usable_rows(total)]
                    for c in range(0, len(spots) if len(able) else 0, step := max(1, ROWS_OUT // max(1, len(able)))):
                        n = len(spots[c : c + step])
                        held.append((np.repeat(able, n), np.repeat(mass[able] + extra, n), np.tile(spots[c : c + step], (len(able), 1)), np.tile(marks[c : c + step], (len(able), 1))))
                    if sum(len(h[0]) for h in held) >= ROWS_OUT:
                        yield from marked_rows(batch, text, bounds, sites, first, held)
                        held = []
            yield from marked_rows(batch, text, bounds, sites, first, held)

    def marked_rows(batch, text, bounds, sites, first, held) -> Iterator[pa.RecordBatch]:
        for n_marks in sorted({h[2].shape[1] for h in held}):
            owner, total, spots, marks = (np.concatenate([h[c] for h in held if h[2].shape[1] == n_marks]) for c in range(4))
            lengths = bounds[owner + 1] - bounds[owner]
            places, ends = runs_of(bounds[owner], lengths)
            data = text[places]
            if n_marks:  # each mark stands behind its residue and moves the rest
                at = (sites[first[owner][:, None] + spots] + (ends - lengths - bounds[owner])[:, None]).ravel()
                data = np.insert(data, at + 1, marks.ravel() + ord("0"))
                ends = ends + n_marks * np.arange(1, len(ends) + 1)
            yield out_batch(batch, owner, string_array(data, ends), total, np.full(len(owner), n_marks, np.int32))

    def table(batch, owner, texts, masses, counted) -> pa.RecordBatch:
        return out_batch(batch, owner, pa.array(texts, pa.string()), masses, counted)

    def out_batch(batch, owner, texts, masses, counted) -> pa.RecordBatch:
        rest = batch.select([f.name for f in others]).take(pa.array(owner, pa.int64())) if others else None
        own = [texts, pa.array(masses, pa.int64()), pa.array(counted, pa.int32())]
        return pa.RecordBatch.from_arrays([*own, *(rest.columns if rest is not None else [])], names=["sequence", "mass_uda", "n_mods", *(f.name for f in others)])

    fields = ["sequence string", "mass_uda bigint", "n_mods int", *(f"`{f.name}` {f.dataType.simpleString()}" for f in others)]
    return peptides.mapInArrow(batches, ", ".join(fields))
