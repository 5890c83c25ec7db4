"""Peptides with one free end, by prefix masses.

The running sum of a protein's residue masses never falls. For a fixed start the ends that give a mass within the range
are therefore neighbours, and two pointers (binary searches for all starts at once) find the first and the last of them;
the limits of length and of missed cut sites are limits of the end as well. No column is made for each missed site.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.fixed_values import ENZYMES, LENGTH_RANGE, MASS_RANGE, MISSED_CLEAVAGES, PROTON, WATER
from ..functions.masses import MICRO, residue_table
from .texts import cut_texts, single_letters

#: Which ends of a peptide have to be cut sites: one of both, both, the first (free C-terminus), the last (free N-terminus).
EITHER_END, BOTH_ENDS, FREE_C_END, FREE_N_END = 1, 2, 8, 9


def masses_by_code() -> np.ndarray:
    masses = np.zeros(256, np.int64)
    for residue, value in residue_table().items():
        masses[ord(residue)] = value
    return masses


def cut_places(codes: np.ndarray, enzyme: str) -> np.ndarray:
    """Places between residues where the enzyme cuts, with both ends of the protein: k lies before residue k."""
    after, cut, blocked = ENZYMES[enzyme]
    is_cut, is_blocked = (np.isin(codes, np.frombuffer(letters.encode(), np.uint8)) for letters in (cut, blocked))
    here = is_cut[:-1] & ~is_blocked[1:] if after else is_cut[1:] & ~is_blocked[:-1]
    return np.concatenate([[0], np.flatnonzero(here) + 1, [len(codes)]])


def windows(codes: np.ndarray, masses: np.ndarray, enzyme: str, termini: int, missed: int, mass_range: tuple[int, int], length_range: tuple[int, int]):
    """(start, end, mass, missed) of every peptide of one protein, start from 0 and end exclusive, each once."""
    n = len(codes)
    sums = np.concatenate([[0], np.cumsum(masses[codes])])
    places = cut_places(codes, enzyme)
    is_place, inner = np.zeros(n + 1, bool), np.zeros(n + 1, np.int64)
    is_place[places] = True
    inner[places[1:-1]] = 1
    inside = np.cumsum(inner)  # cut sites up to and with a place
    low, high = mass_range[0] - WATER - PROTON, mass_range[1] - WATER - PROTON
    found = []
    if termini in (EITHER_END, BOTH_ENDS, FREE_C_END):
        start = places[:-1]
        limit = places[np.minimum(np.arange(len(start)) + missed + 1, len(places) - 1)]
        first = np.maximum(np.searchsorted(sums, sums[start] + low), start + length_range[0])
        last = np.minimum.reduce([np.searchsorted(sums, sums[start] + high, side="right") - 1, start + length_range[1], limit])
        many = np.maximum(last - first + 1, 0)
        s = np.repeat(start, many)
        e = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
        whole = is_place[e] if termini == BOTH_ENDS else np.ones(len(e), bool)
        found.append((s[whole], e[whole]))
    if termini in (EITHER_END, FREE_N_END):
        end = places[1:]
        limit = places[np.maximum(np.arange(1, len(places)) - missed - 1, 0)]
        first = np.maximum.reduce([np.searchsorted(sums, sums[end] - high), end - length_range[1], limit])
        last = np.minimum(np.searchsorted(sums, sums[end] - low, side="right") - 1, end - length_range[0])
        many = np.maximum(last - first + 1, 0)
        s = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
        e = np.repeat(end, many)
        fresh = ~is_place[s] if termini == EITHER_END else np.ones(len(s), bool)
        found.append((s[fresh], e[fresh]))
    s, e = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    between = inside[np.maximum(e - 1, 0)] - inside[s]
    return s, e, sums[e] - sums[s] + WATER + PROTON, between


_KINDS = [("accession", pa.string()), ("sequence", pa.string()), ("mass_uda", pa.int64()), ("missed", pa.int32()),
          ("start", pa.int32()), ("end", pa.int32()), ("prev", pa.string()), ("next", pa.string())]


# Windows of one protein among which equal texts are sought at once; of a longer protein, groups that hold all copies of a text.
ROWS_OUT = 200_000


def distinct_groups(codes: np.ndarray, s: np.ndarray, e: np.ndarray) -> list[np.ndarray | None]:
    """The windows of a protein in groups of at most about ``ROWS_OUT``, dealt by what equal texts share."""
    if len(s) <= ROWS_OUT:
        return [None]
    # a window begins with its first letters and has a length: equal texts agree in a hash of both
    power, value = np.uint64(0x9E3779B97F4A7C15), np.zeros(len(s), np.uint64)
    held = np.concatenate([codes, np.zeros(8, np.uint8)]).astype(np.uint64)
    lengths = e - s
    for k in range(8):
        own = np.where(lengths > k, held[np.minimum(s + k, len(held) - 1)], 0).astype(np.uint64)
        value = (value * power) ^ (value >> np.uint64(29)) ^ own
    value = (value ^ (lengths.astype(np.uint64) << np.uint64(40))) * power
    parts = -(-len(s) // ROWS_OUT)
    group = (value >> np.uint64(33)) % np.uint64(parts)
    return [np.flatnonzero(group == g) for g in range(parts)]


def window_texts(sequence: str, codes: np.ndarray, s: np.ndarray, e: np.ndarray) -> pa.Array:
    if sequence.isascii():
        return cut_texts(codes, s, e)
    return pa.array([sequence[i:j] for i, j in zip(s.tolist(), e.tolist())], pa.string())


def first_texts(sequence: str, codes: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The texts of windows of a protein, and which are the first of their text."""
    texts = window_texts(sequence, codes, s, e)
    number = texts.dictionary_encode().indices.to_numpy()
    return texts, np.flatnonzero(number > np.maximum.accumulate(np.concatenate([[-1], number[:-1]])))


def semi_digest(
    proteins: DataFrame,
    enzyme: str = "Trypsin",
    termini: int = EITHER_END,
    missed: int = MISSED_CLEAVAGES,
    mass_range: tuple[float, float] = MASS_RANGE,
    length_range: tuple[int, int] = LENGTH_RANGE,
    places: bool = True,
    sums: list[str] | None = None,
) -> DataFrame:
    """Peptides of which one end need not be a cut site, with at most ``missed`` sites inside; no shuffle.

    Without ``places`` a protein gives a sequence that it holds several times once, however long it is, and the columns that
    tell where a peptide lies are left out. A null or empty sequence gives no row. With ``sums`` the peptides of a protein
    are summed up where they are made: accession, n and the sums of these columns, a row for each protein that has any.
    """
    if termini not in (EITHER_END, BOTH_ENDS, FREE_C_END, FREE_N_END):
        raise ValueError("termini is 1 (either end), 2 (both), 8 (free C-terminus) or 9 (free N-terminus)")
    if enzyme not in ENZYMES:
        raise ValueError(f"unknown enzyme {enzyme}")
    if length_range[0] < 1:
        raise ValueError("a peptide has at least one residue")
    masses = masses_by_code()
    limits = (int(mass_range[0] * MICRO), int(mass_range[1] * MICRO))
    kinds = _KINDS if places else _KINDS[:4]
    if sums is not None:
        if unknown := set(sums) - {n for n, k in kinds if k != pa.string()}:
            raise ValueError(f"no numbers to sum up: {sorted(unknown)}")
        kinds = [_KINDS[0], *[(n, pa.int64()) for n in ("n", *sums)]]

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            held, n = [], 0
            for k, sequence in enumerate(batch.column("sequence").to_pylist()):
                if not sequence:
                    continue
                codes = np.frombuffer(sequence.encode("ascii", "replace"), np.uint8)
                found = windows(codes, masses, enzyme, termini, missed, limits, length_range)
                if sums is not None:
                    if len(found[0]):
                        held.append(totals(k, sequence, codes, found))
                    continue
                for chosen in [None] if places else distinct_groups(codes, *found[:2]):
                    own = found if chosen is None else tuple(c[chosen] for c in found)
                    step = ROWS_OUT if places else max(1, len(own[0]))
                    for a in range(0, len(own[0]), step):
                        held.append(rows(k, sequence, codes, *(c[a : a + step] for c in own)))
                        n += len(held[-1][0])
                        if n >= ROWS_OUT:
                            yield table(batch, held)
                            held, n = [], 0
            if held:
                yield table(batch, held)

    def totals(k, sequence, codes, found) -> list[np.ndarray]:
        out = np.zeros(1 + len(sums), np.int64)
        for chosen in [None] if places else distinct_groups(codes, *found[:2]):
            s, e, mass, between = found if chosen is None else (c[chosen] for c in found)
            if not places and len(s):
                first = first_texts(sequence, codes, s, e)[1]
                s, e, mass, between = s[first], e[first], mass[first], between[first]
            own = {"mass_uda": mass, "missed": between, "start": s + 1, "end": e}
            out += [len(s), *(int(own[c].sum()) for c in sums)]
        return [np.full(1, k), *(out[i : i + 1] for i in range(len(out)))]

    def rows(k, sequence, codes, s, e, mass, between):
        plain = sequence.isascii()
        if places:
            texts = window_texts(sequence, codes, s, e)
        else:
            texts, first = first_texts(sequence, codes, s, e)
            texts, mass, between = texts.take(pa.array(first)), mass[first], between[first]
        columns = [np.full(len(texts), k), texts, mass, between.astype(np.int32)]
        if places:
            if plain:
                edged = np.concatenate([[ord("-")], codes, [ord("-")]])
                ends = [single_letters(edged[s]), single_letters(edged[e + 1])]
            else:
                edged = f"-{sequence}-"
                ends = [pa.array([edged[i] for i in at.tolist()], pa.string()) for at in (s, e + 1)]
            columns += [(s + 1).astype(np.int32), e.astype(np.int32), *ends]
        return columns

    def table(batch: pa.RecordBatch, held: list) -> pa.RecordBatch:
        owner, *columns = (pa.concat_arrays([pa.array(h[c]) for h in held]) for c in range(len(held[0])))
        return pa.RecordBatch.from_arrays([batch.column("accession").take(owner), *columns], names=[n for n, _ in kinds])

    ddl = ", ".join(f"`{n}` {'bigint' if k == pa.int64() else 'int' if k == pa.int32() else 'string'}" for n, k in kinds)
    return proteins.select("accession", "sequence").mapInArrow(batches, ddl)
