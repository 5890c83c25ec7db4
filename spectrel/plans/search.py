"""Candidates, cross-correlation scores, ranking and expect values."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import replace
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    DECOY_LABEL,
    FRAGMENT_BIN,
    FRAGMENT_OFFSET,
    LENGTH_RANGE,
    MASS_RANGE,
    MASS_TOLERANCE,
    MAX_FRAGMENT_CHARGE,
    MAX_VARIABLE_SITES,
    MIN_PEAKS,
    MISSED_CLEAVAGES,
    NUM_OUTPUT,
    PROTON_DALTON,
    VARIABLE_ADDED,
)
from ..functions.masses import MICRO
from ..operators.hits import top_hits
from ..operators.joins import check_width, range_join, shared_table_join, small_enough
from ..operators.shared import written
from .digest import digest, search_peptides, variable_mods, wanted_masses, with_decoys
from .modifications import MOST_IN_ALL, Modification, covered_masses, plain_sequence, with_modifications
from .scoring import SPECTRUM_COLUMNS, Block, Rules, Summary, score_pairs, score_summaries, score_with_shared_database
from .semi_digest import masses_by_code, semi_digest, windows
from .spectra import XCORR_SCALE, filter_spectra, strong_peaks, with_precursor, with_strong_peaks

# Settings whose base value turns a feature off; any other value is refused.
OFF = {
    "isotope_error": 0,
    "nucleotide_reading_frame": 0,
    "peff_format": 0,
    "use_A_ions": 0,
    "use_C_ions": 0,
    "use_X_ions": 0,
    "use_Z_ions": 0,
    "use_NL_ions": 0,
    "remove_precursor_peak": 0,
    "clip_nterm_methionine": 0,
    "override_charge": 0,
    "require_variable_mod": 0,
    "clear_mz_range": (0.0, 0.0),
}


def check_settings(settings: dict) -> None:
    for name, value in settings.items():
        if name not in OFF:
            raise ValueError(f"unknown setting {name}")
        if value != OFF[name]:
            raise ValueError(f"setting {name}={value!r} is not supported, only {OFF[name]!r}")


def mass_domain(mass_range: tuple[float, float] = MASS_RANGE) -> tuple[int, int]:
    return int(mass_range[0] * MICRO), int(mass_range[1] * MICRO)


# What names a spectrum: ids repeat between files.
SPECTRUM = ["source_file", "spectrum_id"]

# Both ends of a peptide are cut sites.
FULL_ENDS = 2
# Spectra (with their strong peaks) up to this measured size are sent to every task.
BROADCAST_SPECTRA_BYTES = 64 << 20
# Bins of the score histogram to a unit of xcorr.
EXPECT_BINS = 10


def candidates(
    spectra: DataFrame,
    peptides: DataFrame,
    bin_width: float = MASS_TOLERANCE,
    mass_range: tuple[float, float] = MASS_RANGE,
    max_broadcast_bytes: int = BROADCAST_SPECTRA_BYTES,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    **limits,
) -> DataFrame:
    """Peptides in ``mass_range`` whose mass lies in the spectrum's own window, ``low_uda`` to ``high_uda``.

    Few spectra go to every task, and the peptides stay where they are. Otherwise
    both sides are shuffled by mass bin: a peptide moves once for each part of the
    spectra in its bin, and a spectrum is repeated for the few bins of its window.
    ``bin_width`` (daltons) changes the cost of either form and never the pairs.
    """
    width = int(bin_width * MICRO)
    check_width(width)
    shared = bool(max_broadcast_bytes) and small_enough(spectra, max_broadcast_bytes)
    return range_join(
        peptides, spectra, "mass_uda", "low_uda", "high_uda", width, mass_domain(mass_range),
        points_by=["sequence"], ranges_by=[c for c in (*SPECTRUM, "charge") if c in spectra.columns],
        broadcast_ranges=shared, prepare_points=prepare, **limits,
    )


def candidates_shared(spectra: DataFrame, peptides: DataFrame, bin_width: float = MASS_TOLERANCE, **kwargs) -> DataFrame:
    """The same pairs with the whole peptide table in every task, while its size allows it."""
    return shared_table_join(peptides, spectra, "mass_uda", "low_uda", "high_uda", int(bin_width * MICRO), **kwargs)


def peptide_table(
    proteins: DataFrame,
    enzyme: str = "Trypsin",
    missed: int = MISSED_CLEAVAGES,
    mass_range: tuple[float, float] = MASS_RANGE,
    length_range: tuple[int, int] = LENGTH_RANGE,
    decoys: bool = False,
    modify: bool = True,
    termini: int = FULL_ENDS,
    covered: np.ndarray | None = None,
) -> DataFrame:
    """Distinct (modified) peptides of a protein database with mass and first protein.

    ``termini``: 2 where both ends are cut sites, else see ``semi_digest``. With ``covered`` (see ``covered_masses``) forms
    that no spectrum's window holds are left out, and peptides without any other form do not move.
    """
    source = with_decoys(proteins) if decoys else proteins
    if termini == FULL_ENDS:
        wanted = None if covered is None else wanted_masses(covered, "M" if modify else None)
        digested = digest(source, enzyme, missed, mass_range, length_range, places=False, wanted=wanted)
    else:
        digested = semi_digest(source, enzyme, termini, missed, mass_range, length_range, places=False)
    peptides = search_peptides(digested)
    return variable_mods(peptides, mass_range=mass_range, covered=covered) if modify else peptides


def prepared_search(
    proteins: DataFrame,
    spectra: DataFrame,
    tolerance: float = MASS_TOLERANCE,
    mass_range: tuple[float, float] = MASS_RANGE,
    tolerance_unit: str = "amu",
    tolerance_of_mz: bool = False,
    spectrum_filter: dict | None = None,
    fragment_bin: float = FRAGMENT_BIN,
    fragment_offset: float = FRAGMENT_OFFSET,
    flanking: bool = False,
    max_fragment_charge: int = MAX_FRAGMENT_CHARGE,
    modifications: list[Modification] | None = None,
    most_modifications: int = MOST_IN_ALL,
    **params,
) -> tuple[DataFrame, DataFrame, Rules]:
    """The peptides and the spectra with their strong peaks, both written, and the rules of their scores.

    ``tolerance`` is in ``tolerance_unit`` (see ``with_precursor``); ``spectrum_filter`` holds settings of
    ``filter_spectra``; fragments are binned by ``fragment_bin`` and ``fragment_offset`` (0.02 and 0.0 for high
    resolution), with half of both neighbours where ``flanking`` is set. ``modifications`` replace the one on M. Forms that
    no spectrum asks for are not made. Further settings go to ``peptide_table``.

    Both tables are read more than once (sizes, then the scores), so they are written to the shared folder instead of being
    computed again.
    """
    if "source_file" not in spectra.columns:
        spectra = spectra.withColumn("source_file", F.lit(""))
    usable = with_precursor(filter_spectra(spectra, **(spectrum_filter or {})), tolerance, tolerance_unit, tolerance_of_mz)
    prepared = written(with_strong_peaks(usable, fragment_bin, fragment_offset).select(*SPECTRUM_COLUMNS), "spectra")
    # fragments of charges that no spectrum can show are not computed
    highest = prepared.agg(F.max("charge").alias("z")).first()["z"] or 1
    charges = max(1, min(max_fragment_charge, highest - 1))
    rules = Rules(fragment_bin=fragment_bin, fragment_offset=fragment_offset, max_charge=charges, flanking=flanking)
    covered = covered_masses(prepared, mass_range)
    if modifications is None:
        return written(peptide_table(proteins, mass_range=mass_range, covered=covered, **params), "peptides"), prepared, rules
    plain = peptide_table(proteins, mass_range=mass_range, **(params | {"modify": False}))
    peptides = written(with_modifications(plain, modifications, most_modifications, mass_range, covered), "peptides")
    return peptides, prepared, replace(rules, added=tuple(m.added_uda for m in modifications))


def with_xcorr(hits: DataFrame, rules: Rules) -> DataFrame:
    return hits.withColumn("xcorr", F.col("xcorr_sum").cast("double") * F.lit(XCORR_SCALE) / F.lit(rules.unit))


def scored_candidates(proteins: DataFrame, spectra: DataFrame, **params) -> DataFrame:
    """Every candidate of every spectrum with its score, a row each; ``search`` makes no such rows."""
    peptides, prepared, rules = prepared_search(proteins, spectra, **params)
    return with_xcorr(score_pairs(peptides, prepared, rules), rules)


def search_summaries(
    proteins: DataFrame,
    spectra: DataFrame,
    n: int = NUM_OUTPUT,
    max_broadcast_bytes: int = BROADCAST_SPECTRA_BYTES,
    bins_per_unit: int | None = None,
    shared_database: bool = False,
    lists_from: int = Rules.lists_from,
    **params,
) -> tuple[DataFrame, Rules]:
    """What each part of the peptides gives for each spectrum (see ``score_summaries``), and the rules of the scores.

    With ``shared_database`` the peptides go to every task, up to ``max_broadcast_bytes``, and the spectra stay.
    """
    peptides, prepared, rules = prepared_search(proteins, spectra, **params)
    rules = replace(rules, n=n, score_bins=bins_per_unit, lists_from=lists_from)
    form = score_with_shared_database if shared_database else score_summaries
    return form(peptides, prepared, rules, max_broadcast_bytes), rules


def search(
    proteins: DataFrame,
    spectra: DataFrame,
    n: int = NUM_OUTPUT,
    settings: dict | None = None,
    expect: bool = False,
    **params,
) -> DataFrame:
    """Best ``n`` peptides of every spectrum of every file: file, spectrum, rank, peptide, protein and score.

    With ``expect`` also log_expect and expect, from a histogram of the scores of all candidates that is summed up where the
    scores are computed.
    """
    check_settings(settings or {})
    bins_per_unit = EXPECT_BINS if expect else None
    summaries, rules = search_summaries(proteins, spectra, n, bins_per_unit=bins_per_unit, **params)
    summaries = written(summaries, "summaries") if expect else summaries
    hits = with_xcorr(summaries.select(*SPECTRUM, "charge", F.inline("hits")), rules)
    # a spectrum of unknown charge was tried with two charges; all its hits rank together
    best = top_hits(hits, SPECTRUM, "xcorr_sum", ["peptide", "charge"], n)
    if not expect:
        return best
    counts = summaries.select(*SPECTRUM, F.inline(F.arrays_zip("score_bins", "score_counts")))
    counts = counts.groupBy(*SPECTRUM, F.col("score_bins").cast("bigint").alias("bin")).agg(F.sum("score_counts").alias("n"))
    return expect_from_counts(counts, best, bins_per_unit)


def hit_proteins(hits: DataFrame, digested: DataFrame) -> DataFrame:
    """All proteins and places of the reported hits: a row for each hit and place in ``digested``.

    Only the few peptides that were reported are looked up, after the cut to the best hits.
    """
    plain = hits.withColumn("sequence", plain_sequence("peptide"))
    keys = [c for c in (*SPECTRUM, "charge", "hit_rank", "peptide") if c in hits.columns]
    places = digested.select("sequence", "accession", "start", "end", "prev", "next")
    found = plain.select(*keys, "sequence").join(places, "sequence").drop("sequence")
    return found.withColumn("is_decoy", F.col("accession").startswith(DECOY_LABEL))


def expect_from_counts(counts: DataFrame, hits: DataFrame, bins_per_unit: int = EXPECT_BINS) -> DataFrame:
    """Expect value of hits from a log-linear fit of the upper half of each spectrum's scores.

    ``counts`` has a row for each spectrum and bin of scores (bin, n), so few for each spectrum. Survival logs are rounded
    to whole millionths so that the fit sums whole numbers. Too few bins for a fit: null.
    """
    key = [c for c in SPECTRUM if c in counts.columns]
    above = Window.partitionBy(*key).orderBy(F.desc("bin"))
    all_of = Window.partitionBy(*key)
    tail = (
        counts.withColumn("survivors", F.sum("n").over(above))
        .withColumn("total", F.sum("n").over(all_of))
        .where(F.col("survivors") * 2 <= F.col("total"))
        .withColumn("y", F.floor(F.log10(F.col("survivors").cast("double")) * 1e6 + 0.5).cast("bigint"))
    )
    x, y = F.col("bin").cast("bigint"), F.col("y")
    sums = tail.groupBy(*key).agg(
        F.count("*").alias("k"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * x).alias("sxx"), F.sum(x * y).alias("sxy")
    )
    spread = F.col("k") * F.col("sxx") - F.col("sx") * F.col("sx")
    fits = sums.where((F.col("k") >= 3) & (spread > 0)).select(
        *key,
        ((F.col("k") * F.col("sxy") - F.col("sx") * F.col("sy")).cast("double") / spread.cast("double")).alias("slope"),
        "k",
        "sx",
        "sy",
    )
    fits = fits.withColumn(
        "intercept", (F.col("sy").cast("double") - F.col("slope") * F.col("sx").cast("double")) / F.col("k").cast("double")
    )
    log_expect = (F.col("slope") * (F.col("xcorr") * F.lit(float(bins_per_unit))) + F.col("intercept")) / F.lit(1e6)
    return (
        hits.join(fits.select(*key, "slope", "intercept"), key, "left")
        .withColumn("log_expect", log_expect)
        .withColumn("expect", F.pow(F.lit(10.0), F.col("log_expect")))
        .drop("slope", "intercept")
    )


def _protein_records(text: str) -> Iterator[tuple[str, str]]:
    for record in ("\n" + text).split("\n>")[1:]:
        head, _, lines = record.partition("\n")
        yield (head.split() or [""])[0], re.sub("[^A-Z]", "", lines.upper())


def _spectrum_records(text: str) -> Iterator[dict]:
    for block in text.split("BEGIN IONS")[1:]:
        lines = [line.strip() for line in block.partition("END IONS")[0].splitlines()]
        fields = {k.upper(): v for k, _, v in (line.partition("=") for line in lines if re.match(r"[A-Za-z]\w*=", line))}
        peaks = [line.split() for line in lines if line and "=" not in line]
        charge = re.search(r"\d+", fields.get("CHARGE", ""))
        mass = re.match(r"[\d.eE+-]+", fields.get("PEPMASS", ""))
        if mass:
            yield {"name": fields.get("TITLE", ""), "mz": float(mass[0]), "charge": int(charge[0]) if charge else None, "peaks": np.array([[float(p[0]), float(p[1])] for p in peaks if len(p) > 1]).reshape(-1, 2)}


def native_scorer(
    n: int = NUM_OUTPUT,
    tolerance: float = MASS_TOLERANCE,
    enzyme: str = "Trypsin",
    missed: int = MISSED_CLEAVAGES,
    termini: int = FULL_ENDS,
    mass_range: tuple[float, float] = MASS_RANGE,
    min_peaks: int = MIN_PEAKS,
    rules: Rules = Rules(),
) -> Callable[[str, str], list[dict]]:
    """A scorer for ``score_batches``: the search itself on FASTA and MGF text of one pair of batches.

    A row is a hit: spectrum_id, charge, peptide, accession, xcorr_sum. The best of all pairs together are those of ``search``.
    """
    masses, limits = masses_by_code(), mass_domain(mass_range)
    rules = replace(rules, n=n)

    last: dict[str, Block] = {}  # pairs of one database batch often follow each other

    def block_of(proteins: str) -> Block:
        if proteins not in last:
            last.clear()
            last[proteins] = made(proteins)
        return last[proteins]

    def made(proteins: str) -> Block:
        found: dict[str, tuple[str, int]] = {}
        for accession, sequence in _protein_records(proteins):
            if sequence:
                codes = np.frombuffer(sequence.encode(), np.uint8)
                for s, e, mass in zip(*(c.tolist() for c in windows(codes, masses, enzyme, termini, missed, limits, LENGTH_RANGE)[:3])):
                    peptide = sequence[s:e]
                    if peptide not in found or accession < found[peptide][0]:
                        found[peptide] = accession, mass
        rows = []
        for peptide, (accession, mass) in found.items():
            sites = [i for i, c in enumerate(peptide) if c == "M"]
            for k in range(min(MAX_VARIABLE_SITES, len(sites)) + 1):
                if limits[0] <= (total := mass + k * VARIABLE_ADDED["M"]) <= limits[1]:
                    for chosen in combinations(sites, k):
                        rows.append(("".join("m" if i in chosen else c for i, c in enumerate(peptide)), accession, total))
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = (pa.string(), pa.string(), pa.int64())
        return Block(pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["sequence", "accession", "mass_uda"]), rules)

    def run(proteins: str, spectra: str) -> list[dict]:
        block, out, width = block_of(proteins), [], int(tolerance * MICRO)
        if not len(block.mass):
            return out
        for s in _spectrum_records(spectra):
            peaks = s["peaks"]
            peaks = peaks[(peaks[:, 0] > 0) & np.isfinite(peaks[:, 0]) & (peaks[:, 1] >= 0) & np.isfinite(peaks[:, 1])]
            if len(peaks) < min_peaks:
                continue
            bins, values = strong_peaks(peaks[:, 0], peaks[:, 1], rules.fragment_bin, rules.fragment_offset)
            for charge in [s["charge"]] if s["charge"] else [2, 3]:
                mh = int(np.floor((s["mz"] * charge - PROTON_DALTON * charge + PROTON_DALTON) * 1e6 + 0.5))
                summary = Summary()
                summary.add(block, charge, mh - width, mh + width, bins, values)
                out += [{"spectrum_id": s["name"], "charge": charge, "peptide": p, "accession": a, "xcorr_sum": -v} for v, p, a in summary.hits]
        return out

    return run


NATIVE_HITS = "spectrum_id string, charge int, peptide string, accession string, xcorr_sum bigint"


def score_batches(pairs: DataFrame, fn: Callable[[str, str], list[dict] | None] | None = None, schema: str = NATIVE_HITS) -> DataFrame:
    """Run a scorer on (database text, spectra text) pairs; no result gives no rows.

    The columns are ``proteins`` and ``spectra``; each batch is bounded by its batch size. ``fn`` is a user's own scorer,
    with the schema of its rows; without one the search itself scores the pairs (``native_scorer``).
    """
    fn = fn or native_scorer()

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for proteins, spectra in zip(frame["proteins"], frame["spectra"]):
                rows = fn(proteins, spectra)
                if rows:
                    yield pd.DataFrame(rows)

    return pairs.select("proteins", "spectra").mapInPandas(batches, schema)


def score_batches_shared(spectra: DataFrame, proteins: DataFrame, fn: Callable[[str, str], list[dict] | None] | None = None, schema: str = NATIVE_HITS, max_bytes: int = BROADCAST_SPECTRA_BYTES) -> DataFrame:
    """Run a scorer on batches of spectra (column ``spectra``), each with the whole database (accession, sequence) beside it.

    The database is sent to every executor once and made into text once in each worker; one whose measured size is above
    ``max_bytes`` raises, as it belongs in batches.
    """
    proteins = proteins.select("accession", "sequence")
    if not small_enough(proteins, max_bytes):
        raise ValueError("the database is too large to be shared; pair batches instead")
    shared, fn = proteins.sparkSession.sparkContext.broadcast(proteins.toArrow()), fn or native_scorer()

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        text = None
        for frame in frames:
            if text is None:
                text = "".join(f">{a}\n{s}\n" for a, s in zip(*(shared.value[c].to_pylist() for c in ("accession", "sequence"))))
            for spectra in frame["spectra"]:
                rows = fn(text, spectra)
                if rows:
                    yield pd.DataFrame(rows)

    return spectra.select("spectra").mapInPandas(batches, schema)
