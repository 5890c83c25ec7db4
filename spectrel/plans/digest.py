"""Proteins to peptides with masses, modifications, decoys and fragment bins."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    DECOY_LABEL,
    ENZYMES,
    FRAGMENT_BIN,
    FRAGMENT_OFFSET,
    LENGTH_RANGE,
    MASS_RANGE,
    MAX_FRAGMENT_CHARGE,
    MAX_VARIABLE_SITES,
    MISSED_CLEAVAGES,
    PROTON,
    VARIABLE_ADDED,
    WATER,
)
from ..functions.masses import MICRO, fragment_bin, residue_table
from ..operators.packed import packed, unpack
from .texts import cut_texts, flat_text, runs_of, single_letters, string_array

# Residues of whole proteins that are cut together, and rows of a batch that is handed on.
RESIDUES_AT_ONCE = 200_000
ROWS_OUT = 50_000
FINE = 10_000  # micro-daltons of a bin of the table of covered masses
# Equal peptides meet in bins of 1 Da; so many shuffle partitions ask for one more part of each bin.
PARTITIONS_PER_PART = 1000


def cut_marks(sequence: Column | str, enzyme: str = "Trypsin") -> Column:
    """The sequence with ``|`` at every cut site."""
    if enzyme not in ENZYMES:
        raise ValueError(f"unknown enzyme {enzyme}")
    after, cut, blocked = ENZYMES[enzyme]
    sequence = F.col(sequence) if isinstance(sequence, str) else sequence
    if after:
        guard = f"(?![{blocked}])" if blocked else ""
        return F.regexp_replace(sequence, f"([{cut}]){guard}", "$1|")
    guard = f"(?<![{blocked}])" if blocked else ""
    return F.regexp_replace(sequence, f"{guard}([{cut}])", "|$1")


def residue_masses() -> np.ndarray:
    """The mass of each letter; a letter that is no residue weighs nothing."""
    masses = np.zeros(256, np.int64)
    for residue, value in residue_table().items():
        if residue.isupper():
            masses[ord(residue)] = value
    return masses


def protein_groups(batch: pa.RecordBatch, most: int = RESIDUES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Slices of whole proteins of about ``most`` residues; a longer protein is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column("sequence")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:]):
        if a < b:
            yield batch.slice(a, b - a)


class Proteins:
    """Residues of several proteins one after the other, and the places where an enzyme cuts them."""

    def __init__(self, sequences: pa.Array, enzyme: str):
        text, bounds = flat_text(sequences)
        self.whole = None
        if text.max(initial=0) > 127:  # places count characters, not bytes
            self.whole = text.tobytes().decode()
            text = np.frombuffer(self.whole.encode("utf-32-le"), np.uint32)
            bounds = np.concatenate([[0], np.cumsum([len(x or "") for x in sequences.to_pylist()])]).astype(np.int64)
        forced = np.zeros(0, np.int64)
        if (text == ord("|")).any():  # the sign of a cut, which is no residue
            kept = text != ord("|")
            place = np.concatenate([[0], np.cumsum(kept)])
            forced, bounds, text = place[np.flatnonzero(~kept)], place[bounds], text[kept]
            self.whole = None if self.whole is None else self.whole.replace("|", "")
        self.codes, self.bounds = text, bounds
        after, cut, blocked = ENZYMES[enzyme]
        is_cut, is_blocked = (np.isin(text, np.frombuffer(letters.encode(), np.uint8)) for letters in (cut, blocked))
        edge = np.zeros(len(text) + 1, bool)
        edge[1:-1] = is_cut[:-1] & ~is_blocked[1:] if after else is_cut[1:] & ~is_blocked[:-1]
        edge[bounds] = True
        edge[forced] = True
        self.places = np.flatnonzero(edge)
        self.owner = np.searchsorted(bounds, self.places[:-1], side="right") - 1  # the protein of the piece that begins there

    def texts(self, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
        if self.whole is None:
            return cut_texts(self.codes, starts, ends)
        return pa.array([self.whole[a:b] for a, b in zip(starts.tolist(), ends.tolist())], pa.string())

    def letters(self, at: np.ndarray, there: np.ndarray) -> pa.Array:
        """The letters at some places, ``-`` where the protein has none there."""
        codes = np.full(len(at), ord("-"), np.uint32)
        codes[there] = self.codes[at[there]]
        return single_letters(codes) if self.whole is None else pa.array([chr(c) for c in codes.tolist()], pa.string())


def digest(
    proteins: DataFrame,
    enzyme: str = "Trypsin",
    missed: int = MISSED_CLEAVAGES,
    mass_range: tuple[float, float] = MASS_RANGE,
    length_range: tuple[int, int] = LENGTH_RANGE,
    places: bool = True,
    wanted: np.ndarray | None = None,
    residue: str = "M",
) -> DataFrame:
    """Peptides of every protein with up to ``missed`` uncut sites, by mass and length.

    Each piece between cut sites is joined with the pieces after it, inside the
    batch that its protein is in, so a digest needs no shuffle: masses are
    differences of running sums. Without ``places`` the columns that tell where a
    peptide lies are left out. With ``wanted`` (see ``wanted_masses``) a peptide of n
    times ``residue`` is left out where row n has no mark at its mass: nothing asks for it.
    """
    if enzyme not in ENZYMES:
        raise ValueError(f"unknown enzyme {enzyme}")
    if enzyme == "No_enzyme":
        missed = length_range[1] - 1
    low, high = int(mass_range[0] * MICRO), int(mass_range[1] * MICRO)
    masses = residue_masses()
    names = ["accession", "sequence", "mass_uda", "missed", *(["start", "end", "prev", "next"] if places else [])]
    shared = None if wanted is None else (np.packbits(wanted, axis=1), wanted.shape[1])

    def windows(found: Proteins) -> Iterator[tuple]:
        known = found.codes < 128
        if shared is not None:
            marks = np.unpackbits(shared[0], axis=1, count=shared[1]).astype(bool)
            sites = np.concatenate([[0], np.cumsum(found.codes == ord(residue))])
        sums = np.concatenate([[0], np.cumsum(np.where(known, masses[np.where(known, found.codes, 0)], 0))])
        for k in range(min(missed + 1, len(found.places) - 1)):
            first = np.flatnonzero(found.owner[: len(found.owner) - k] == found.owner[k:])
            s, e = found.places[first], found.places[first + k + 1]
            mass = sums[e] - sums[s] + (WATER + PROTON)
            fits = (mass >= low) & (mass <= high) & (e - s >= length_range[0]) & (e - s <= length_range[1])
            if shared is not None:
                fits &= marks[np.minimum(sites[e] - sites[s], len(marks) - 1), np.clip(mass // FINE, 0, shared[1] - 1)]
            yield s[fits], e[fits], mass[fits], found.owner[first[fits]], np.full(int(fits.sum()), k, np.int32)

    def table(found: Proteins, accessions: pa.Array, s, e, mass, owner, k) -> pa.RecordBatch:
        columns = [accessions.take(pa.array(owner)), found.texts(s, e), pa.array(mass), pa.array(k)]
        if places:
            begin, end = found.bounds[owner], found.bounds[owner + 1]
            columns += [pa.array((s - begin + 1).astype(np.int32)), pa.array((e - begin).astype(np.int32)), found.letters(s - 1, s > begin), found.letters(e, e < end)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for batch in protein_groups(frame):
                found, held = Proteins(batch.column("sequence"), enzyme), []
                for rows in windows(found):
                    held.append(rows)
                    if sum(len(h[0]) for h in held) >= ROWS_OUT:
                        yield from tables(found, batch.column("accession"), held)
                        held = []
                yield from tables(found, batch.column("accession"), held)

    def tables(found: Proteins, accessions: pa.Array, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate([h[c] for h in held]) for c in range(5)] if held else [np.zeros(0)]
        for a in range(0, len(columns[0]), ROWS_OUT):
            yield table(found, accessions, *(c[a : a + ROWS_OUT] for c in columns))

    kinds = f"accession {proteins.schema['accession'].dataType.simpleString()}, sequence string, mass_uda bigint, missed int"
    return proteins.select("accession", "sequence").mapInArrow(batches, kinds + (", start int, end int, prev string, next string" if places else ""))


def wanted_masses(covered: np.ndarray, residue: str | None = "M", max_sites: int = MAX_VARIABLE_SITES) -> np.ndarray:
    """For peptides with 0, 1 ... ``max_sites`` modifiable residues, a row each: the bins of mass at which some form is covered.

    ``covered`` marks bins of ``FINE`` micro-daltons in which a spectrum looks. Without ``residue`` there is the plain form only.
    """
    rows = [covered]
    for n in range(1, max_sites + 1 if residue else 1):
        step = n * VARIABLE_ADDED[residue] // FINE
        own = rows[-1].copy()
        for shift in (step, step + 1):  # a bin of plain masses becomes parts of two
            if shift < len(own):
                own[: len(own) - shift] |= covered[shift:]
        rows.append(own)
    return np.array(rows)


def _by_mass(digested: DataFrame) -> DataFrame:
    """The rows with the cell in which equal peptides meet: a bin of 1 Da, and a part of it where many partitions are asked for."""
    parts = max(1, int(digested.sparkSession.conf.get("spark.sql.shuffle.partitions")) // PARTITIONS_PER_PART)
    cell = F.floor(F.col("mass_uda") / F.lit(MICRO)).cast("bigint") * F.lit(parts) + F.pmod(F.xxhash64("sequence"), F.lit(parts))
    return digested.withColumn("_cell", F.coalesce(cell, F.lit(-1).cast("bigint")))


def _codes(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """A number for each distinct value, null too, and the values."""
    found = pc.dictionary_encode(column.combine_chunks(), null_encoding="encode")
    found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
    return found.indices.to_numpy().astype(np.int64), found.dictionary


def _peptide_numbers(table: pa.Table) -> np.ndarray:
    """The same number for rows of the same sequence and mass."""
    sequence, mass = _codes(table["sequence"])[0], _codes(table["mass_uda"])[0]
    return sequence * (mass.max(initial=0) + 1) + mass


def _accession_ranks(column: pa.ChunkedArray, targets_first: bool) -> np.ndarray:
    """The place of each row's accession in their order, where null comes first; with ``targets_first`` decoys come last."""
    codes, values = _codes(column)
    decoy = pc.fill_null(pc.starts_with(values.cast(pa.string()), DECOY_LABEL), False) if targets_first else pa.repeat(False, len(values))
    keys = pa.table([pc.and_(decoy, pc.is_valid(values)).cast(pa.int8()), values], names=["decoy", "value"])
    order = pc.sort_indices(keys, sort_keys=[("decoy", "ascending"), ("value", "ascending")], null_placement="at_start").to_numpy()
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.arange(len(order))
    return ranks[codes]


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the one before."""
    fresh = np.ones(len(columns[0]), bool)
    fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(fresh)


def _by_weight(rows: pa.Table) -> pa.Table:
    return rows.take(pc.sort_indices(rows["mass_uda"]))


def _first_proteins(table: pa.Table) -> pa.Table:
    """One row of each peptide, that of its first protein, in the order of masses."""
    peptide, rank = _peptide_numbers(table), _accession_ranks(table["accession"], True)
    order = np.lexsort((rank, peptide))
    return _by_weight(table.take(pa.array(order[_starts(peptide[order])])))


def _protein_rows(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """One row of each peptide and protein (n places, the first of them) by peptide and accession, and the peptides' numbers."""
    peptide, rank, place = _peptide_numbers(table), _accession_ranks(table["accession"], False), table["packed_place"].to_numpy()
    order = np.lexsort((place, rank, peptide))
    starts = _starts(peptide[order], rank[order])
    rows = table.take(pa.array(order[starts]))
    n = np.add.reduceat(table["n"].to_numpy()[order], starts) if len(starts) else np.zeros(0, np.int64)
    return rows.set_column(rows.schema.get_field_index("n"), "n", pa.array(n)), peptide[order[starts]]


def _place_structs(table: pa.Table) -> pa.StructArray:
    """All rows by peptide, accession and place, each as a place with its protein."""
    peptide, rank, place = _peptide_numbers(table), _accession_ranks(table["accession"], False), table["packed_place"].to_numpy()
    order = np.lexsort((place, rank, peptide))
    rows, place = table.select(["accession", "sequence"]).take(pa.array(order)), place[order]
    start = (place >> 16).astype(np.int32)
    end = start + pc.utf8_length(rows["sequence"]).fill_null(0).to_numpy().astype(np.int32) - 1
    sides = [place >> 8 & 255, place & 255]
    letters = [single_letters(c) if c.max(initial=0) < 128 else pa.array([chr(x) for x in c.tolist()], pa.string()) for c in sides]
    columns = [pa.concat_arrays(rows["accession"].chunks), pa.array(start), pa.array(end), *letters]
    return pa.StructArray.from_arrays(columns, names=["accession", "start", "end", "prev", "next"])


def distinct_peptides(digested: DataFrame, places: bool = False) -> DataFrame:
    """One row per peptide: mass, number of proteins and places, and the first of them.

    With ``places`` also all of them, in order by accession and start, as an array (accession, start, end, prev, next);
    without, only counts and one place are kept per peptide, so a peptide found in a third of all proteins costs no more
    than another. A task takes the places of a protein together, if they are not asked for, and packs its rows by mass, so
    they move once.
    """
    # start and both neighbours in one number: the smallest is the first place in the protein
    place = F.shiftleft(F.col("start").cast("bigint"), 16) + F.shiftleft(F.ascii("prev").cast("bigint"), 8) + F.ascii("next")
    rows = _by_mass(digested).select("_cell", "sequence", "mass_uda", "accession", F.lit(1).cast("bigint").alias("n"), place.alias("packed_place"))
    moved, schema = packed(rows, ["_cell"], combine=_by_weight if places else lambda table: _by_weight(_protein_rows(table)[0]))

    def counted(cell: pa.Table) -> pa.Table:
        every = unpack(cell, schema)
        rows, peptide = _protein_rows(every)
        starts = _starts(peptide)
        first = rows.take(pa.array(starts))
        totals = np.add.reduceat(rows["n"].to_numpy(), starts) if len(starts) else np.zeros(0, np.int64)
        counts = [pa.array(np.diff([*starts, len(peptide)]).astype(np.int64)), pa.array(totals)]
        names = ["sequence", "mass_uda", "n_proteins", "n_places", "accession", "packed_place"]
        columns = [first["sequence"], first["mass_uda"], *counts, first["accession"], first["packed_place"]]
        if not places:
            return pa.table(columns, names=names)
        ends = np.concatenate([[0], np.cumsum(totals)]).astype(np.int32)
        return pa.table([*columns, pa.ListArray.from_arrays(pa.array(ends), _place_structs(every))], names=[*names, "places"])

    kind = digested.schema["accession"].dataType.simpleString()
    kinds = f"sequence string, mass_uda bigint, n_proteins bigint, n_places bigint, accession {kind}, packed_place bigint"
    kinds += f", places array<struct<accession: {kind}, start: int, end: int, prev: string, next: string>>" if places else ""
    found = moved.groupBy("_cell").applyInArrow(counted, kinds)
    return found.select(
        "sequence",
        "mass_uda",
        "n_proteins",
        "n_places",
        "accession",
        F.shiftright("packed_place", 16).cast("int").alias("start"),
        (F.shiftright("packed_place", 16) + F.length("sequence") - 1).cast("int").alias("end"),
        F.chr(F.shiftright("packed_place", 8).bitwiseAND(F.lit(255))).alias("prev"),
        F.chr(F.col("packed_place").bitwiseAND(F.lit(255))).alias("next"),
        *(["places"] if places else []),
    )


def search_peptides(digested: DataFrame) -> DataFrame:
    """The peptide table of a search: each sequence once, with its first protein; a decoy only if no target holds it.

    A task keeps one protein of each peptide that it holds, and packs what is left by mass for the one shuffle.
    """
    rows = _by_mass(digested).select("_cell", "sequence", "mass_uda", "accession")
    moved, schema = packed(rows, ["_cell"], combine=_first_proteins)
    kinds = f"sequence string, mass_uda bigint, accession {digested.schema['accession'].dataType.simpleString()}"
    return moved.groupBy("_cell").applyInArrow(lambda cell: _first_proteins(unpack(cell, schema)), kinds)


def variable_mods(
    peptides: DataFrame,
    residue: str = "M",
    max_sites: int = MAX_VARIABLE_SITES,
    mass_range: tuple[float, float] = MASS_RANGE,
    covered: np.ndarray | None = None,
) -> DataFrame:
    """Every peptide with each choice of up to ``max_sites`` modified residues.

    A modified residue is written in lower case, so the sequence says all. With ``covered``, marks of bins of ``FINE``
    micro-daltons, forms of other masses are left out.
    """
    added, low, high = VARIABLE_ADDED[residue], int(mass_range[0] * MICRO), int(mass_range[1] * MICRO)
    others = [f for f in peptides.schema if f.name not in ("sequence", "mass_uda", "n_mods")]
    shared = None if covered is None else (np.packbits(covered), len(covered))

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = None if shared is None else np.unpackbits(shared[0], count=shared[1]).astype(bool)
        for batch in frames:
            text, bounds = flat_text(batch.column("sequence"))
            sites = np.flatnonzero(text == ord(residue))
            first = np.searchsorted(sites, bounds)  # of each row's sites
            counts = np.diff(first)
            mass = batch.column("mass_uda").to_numpy(zero_copy_only=False)
            for n_mods in range(max_sites + 1):
                total = mass + n_mods * added
                able = (total >= low) & (total <= high) & (counts >= n_mods)
                if marks is not None:
                    able &= marks[np.clip(total // FINE, 0, len(marks) - 1)]
                for count in np.unique(counts[able]).tolist():
                    rows = np.flatnonzero(able & (counts == count))
                    chosen = list(combinations(range(count), n_mods))
                    chosen = np.array(chosen, np.int64).reshape(len(chosen), n_mods)
                    for a in range(0, len(chosen), step := max(1, ROWS_OUT // len(rows))):
                        part = chosen[a : a + step]
                        yield table(batch, text, bounds, np.repeat(rows, len(part)), total, sites, first, np.tile(part, (len(rows), 1)))

    def table(batch, text, bounds, owner, total, sites, first, chosen) -> pa.RecordBatch:
        n_mods = chosen.shape[1]
        taken = batch.take(pa.array(owner))
        sequence = taken.column("sequence")
        if n_mods:
            lengths = bounds[owner + 1] - bounds[owner]
            places, ends = runs_of(bounds[owner], lengths)
            data = text[places]
            shift = (ends - lengths) - bounds[owner]
            data[(sites[first[owner][:, None] + chosen] + shift[:, None]).ravel()] = ord(residue.lower())
            sequence = string_array(data, ends)
        columns = [sequence, pa.array(total[owner]), pa.array(np.full(len(owner), n_mods, np.int32)), *(taken.column(f.name) for f in others)]
        return pa.RecordBatch.from_arrays(columns, names=["sequence", "mass_uda", "n_mods", *(f.name for f in others)])

    fields = ["sequence string", "mass_uda bigint", "n_mods int", *(f"`{f.name}` {f.dataType.simpleString()}" for f in others)]
    return peptides.where("mass_uda is not null").mapInArrow(batches, ", ".join(fields))


def with_decoys(proteins: DataFrame) -> DataFrame:
    """The proteins and their reversed copies under the decoy prefix."""
    decoys = proteins.withColumn("accession", F.concat(F.lit(DECOY_LABEL), F.col("accession"))).withColumn(
        "sequence", F.reverse("sequence")
    )
    return proteins.unionByName(decoys)


def prefix_masses(sequence: str = "sequence") -> Column:
    """Running residue masses of a peptide: after residue 1, 2 ... to the last but one."""
    table = residue_table()
    by_code = F.array(*[F.lit(table.get(chr(c), 0)).cast("bigint") for c in range(128)])
    letters = F.filter(F.split(sequence, ""), lambda x: x != "")
    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<bigint>").alias("out"))

    def add(acc, x):
        total = acc["sum"] + F.get(by_code, F.ascii(x))
        return F.struct(total.alias("sum"), F.concat(acc["out"], F.array(total)).alias("out"))

    return F.aggregate(F.slice(letters, F.lit(1), F.length(sequence) - 1), start, add, lambda acc: acc["out"])


def fragment_ions(peptides: DataFrame, max_charge: int = 1) -> DataFrame:
    """b and y ions of each peptide for charges 1 to ``max_charge``, one row per ion."""
    with_prefix = peptides.withColumn("prefix", prefix_masses()).withColumn(
        "charge", F.explode(F.sequence(F.lit(1), F.lit(max_charge)))
    )
    rows = with_prefix.select(
        *[c for c in with_prefix.columns if c != "prefix"], F.posexplode("prefix").alias("i", "b")
    )
    # b and y are the two halves of the peptide, each with one proton
    ion = F.explode(
        F.array(
            F.struct(F.lit("b").alias("series"), (F.col("i") + 1).alias("number"), (F.col("b") + PROTON).alias("mh")),
            F.struct(
                F.lit("y").alias("series"),
                (F.length("sequence") - F.col("i") - 1).alias("number"),
                (F.col("mass_uda") - F.col("b")).alias("mh"),
            ),
        )
    )
    rows = rows.withColumn("ion", ion)
    mz = ion_mz(F.col("ion.mh"), F.col("charge"))
    return rows.select(
        *[c for c in peptides.columns],
        "charge",
        "ion.series",
        "ion.number",
        mz.alias("mz_uda"),
        fragment_bin(mz).alias("bin"),
    )


def ion_mz(mh: Column, charge: Column) -> Column:
    """m/z in micro-daltons of an ion given its singly charged mass."""
    total = mh + (charge - 1).cast("bigint") * F.lit(PROTON).cast("bigint")
    return F.floor(total / charge).cast("bigint")


# Fragments that are sorted together: few enough to stay in the cache.
FRAGMENTS_AT_ONCE = 100_000


def fragment_lists(
    text: np.ndarray,
    ends: np.ndarray,
    mass: np.ndarray,
    max_charge: int,
    width: float = FRAGMENT_BIN,
    offset: float = FRAGMENT_OFFSET,
    added: tuple[int, ...] = (),
    wanted: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fragment bins of many peptides at once: where the list of each peptide begins (and the last ends), bins and charges.

    The bins of a peptide are sorted, each at its lowest charge only. Peptides of one length are the rows of a matrix, whose
    rows are sorted apart. ``added`` has the masses of the marks 1, 2 ... that may follow a residue or the signs of the ends,
    n and c. Peptides that are not ``wanted`` have empty lists.
    """
    # whole numbers far below 2 ** 53, which floating point holds exactly
    masses = np.zeros(256)
    for residue, value in residue_table().items():
        masses[ord(residue)] = value
    for mark, value in enumerate(added, start=1):
        masses[ord(str(mark))] = value
    lengths = np.diff(ends, prepend=0)
    begins = ends - lengths
    if wanted is not None:
        lengths = np.where(wanted, lengths, 0)
    highest = max(int(mass.max(initial=0)), int(masses.max()) * int(lengths.max(initial=0))) + max_charge * PROTON
    kind = np.int32 if highest / MICRO / width + 2 < 1 << 26 and int(mass.min(initial=0)) >= 0 else np.int64
    none = np.iinfo(kind).max
    counts, parts = np.zeros(len(ends), np.int64), []
    for length in np.unique(lengths[lengths > 1]).tolist():
        same = np.flatnonzero(lengths == length)
        many = 2 * max_charge * (length - 1)
        step = max(1, FRAGMENTS_AT_ONCE // many)
        for a in range(0, len(same), step):
            rows = same[a : a + step]
            codes = text[begins[rows][:, None] + np.arange(length)]
            prefix = np.cumsum(masses[codes[:, :-1]], axis=1)  # a fragment leaves out at least the last residue
            singly = np.empty((len(rows), 2, length - 1))
            np.add(prefix, PROTON, out=singly[:, 0])
            np.subtract(mass[rows][:, None], prefix, out=singly[:, 1])
            keys = np.empty((len(rows), max_charge, 2, length - 1), kind)
            for charge in range(1, max_charge + 1):
                mz = singly.copy() if charge == 1 else np.floor((singly + (charge - 1) * PROTON) / charge)
                mz /= float(MICRO)
                mz /= width
                mz += 1.0 - offset
                own = np.floor(mz, out=mz).astype(kind)
                own <<= 4
                own |= charge
                keys[:, charge - 1] = own
            keys = keys.reshape(len(rows), many)
            if added:  # a fragment ends where a residue follows, and holds one
                residue = (codes >= ord("A")) & (codes <= ord("Z"))
                inner = residue[:, 1:] & np.logical_or.accumulate(residue, axis=1)[:, :-1]
                keys[np.tile(~inner, 2 * max_charge)] = none
            keys.sort(axis=1)
            bins = keys >> 4
            first = np.ones(keys.shape, bool)
            np.not_equal(bins[:, 1:], bins[:, :-1], out=first[:, 1:])
            if added:
                first &= keys != none
            own = first.sum(axis=1)
            counts[rows] = own
            parts.append((rows, bins[first], (keys[first] & 15).astype(np.int8)))
    start = np.concatenate([[0], np.cumsum(counts)])
    bins, charges = np.empty(start[-1], kind), np.empty(start[-1], np.int8)
    for rows, own_bins, own_charges in parts:
        at, _ = runs_of(start[rows], counts[rows])
        bins[at], charges[at] = own_bins, own_charges
    return start, bins, charges


def fragment_entries(text: np.ndarray, ends: np.ndarray, mass: np.ndarray, max_charge: int, *rules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bins of ``fragment_lists`` as row, bin and charge in this order."""
    start, bins, charges = fragment_lists(text, ends, mass, max_charge, *rules)
    return np.repeat(np.arange(len(ends)), np.diff(start)), bins.astype(np.int64), charges


def bins_by_charge(text: np.ndarray, ends: np.ndarray, mass: np.ndarray, max_charge: int, *rules) -> list[tuple]:
    """The entries of ``fragment_entries`` as (row, bin) for each charge."""
    row, bins, charge = fragment_entries(text, ends, mass, max_charge, *rules)
    return [(row[charge == z], bins[charge == z]) for z in range(1, max_charge + 1)]


def with_fragment_bins(peptides: DataFrame, max_charge: int = MAX_FRAGMENT_CHARGE) -> DataFrame:
    """Adds ``bins1``, ``bins2`` ...: the fragment bins that each charge adds to those of lower charges.

    One row in, one row out, a batch at a time; the row form of the same ions is
    ``fragment_ions``.
    """
    names = [f"bins{z}" for z in range(1, max_charge + 1)]

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            sequences = batch.column("sequence")
            # a letter outside ASCII weighs nothing, like B, J, X and Z
            text = np.frombuffer("".join(sequences.to_pylist()).encode("ascii", "replace"), dtype=np.uint8)
            ends = np.cumsum(pc.utf8_length(sequences).to_numpy(zero_copy_only=False).astype(np.int64))
            mass = batch.column("mass_uda").to_numpy(zero_copy_only=False)
            columns = []
            for row, bins in bins_by_charge(text, ends, mass, max_charge):
                offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(ends)))]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(bins.astype(np.int32))))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in peptides.schema]
    return peptides.mapInArrow(batches, ", ".join([*fields, *[f"{n} array<int>" for n in names]]))
