"""Digest, scores and the whole search against brute force in plain Python."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from catalog import QUERIES
from catalog.core import benchmark_proteins, benchmark_spectra
from spectrel.functions.fixed_values import ENZYMES, PROTON, WATER
from spectrel.functions.masses import residue_table
from spectrel.plans import digest as dg
from spectrel.plans import search as se
from spectrel.plans import spectra as sp

MASS = residue_table()
PROTEINS = [
    ("P1", "MKRPAAKWWMEDLVRKPGGSTMNNMLKAAAAAAAAAARGGGGGGGGK"),
    ("P2", "MKRPAAKCCCCCDDDDEEEEKFFFFFFR"),
    ("P3", ""),
    ("P4", "ACDEFGHIKLMNPQRSTVWY" * 40),
]


def mh(sequence):
    return sum(MASS[r] for r in sequence) + WATER + PROTON


def table(spark, rows=PROTEINS):
    return spark.createDataFrame(rows, "accession string, sequence string")


def digest_by_hand(sequence, enzyme, missed):
    after, cut, blocked = ENZYMES[enzyme]
    edges = [0]
    for i in range(1, len(sequence)):
        left, right = sequence[i - 1], sequence[i]
        if (after and left in cut and right not in blocked) or (not after and right in cut and left not in blocked):
            edges.append(i)
    edges.append(len(sequence))
    out = []
    for i in range(len(edges) - 1):
        for j in range(i + 1, min(i + missed + 1, len(edges) - 1) + 1):
            text = sequence[edges[i] : edges[j]]
            if 4 <= len(text) <= 40 and 600_000_000 <= mh(text) <= 5_000_000_000:
                prev = sequence[edges[i] - 1] if edges[i] else "-"
                following = sequence[edges[j]] if edges[j] < len(sequence) else "-"
                out.append((text, mh(text), j - i - 1, edges[i] + 1, edges[j], prev, following))
    return out


@pytest.mark.parametrize("enzyme", [e for e in ENZYMES if e != "No_enzyme"])
@pytest.mark.parametrize("missed", [0, 2])
def test_digest(spark, enzyme, missed):
    got = sorted(tuple(r)[1:] for r in dg.digest(table(spark), enzyme, missed).collect())
    assert got == sorted(row for _, s in PROTEINS if s for row in digest_by_hand(s, enzyme, missed))


def test_digest_without_enzyme(spark):
    got = sorted(r.sequence for r in dg.digest(table(spark, PROTEINS[:1]), "No_enzyme", places=False).collect())
    s = PROTEINS[0][1]
    every = [s[i:j] for i in range(len(s)) for j in range(i + 4, min(i + 40, len(s)) + 1)]
    assert got == sorted(x for x in every if 600_000_000 <= mh(x) <= 5_000_000_000)


def test_long_protein_places(spark):
    sequence = "".join("ACDEFGHILMNPQSTVWY"[i * 7 % 18] + ("K" if i % 5 == 0 else "") for i in range(6000))
    got = sorted(tuple(r)[1:] for r in dg.digest(table(spark, [("L", sequence)])).collect())
    assert got == sorted(digest_by_hand(sequence, "Trypsin", 2))


def test_variable_mods(spark):
    from itertools import combinations

    sequence = "MAMAMAMWWK"
    base = spark.createDataFrame([(sequence, mh(sequence), "P")], "sequence string, mass_uda bigint, accession string")
    got = {(r.sequence, r.mass_uda, r.n_mods) for r in dg.variable_mods(base).collect()}
    sites = [i for i, r in enumerate(sequence) if r == "M"]
    expected = set()
    for k in range(4):
        for chosen in combinations(sites, k):
            text = "".join("m" if i in chosen else r for i, r in enumerate(sequence))
            expected.add((text, mh(text), k))
    assert got == expected


def test_decoys(spark):
    rows = {r.accession: r.sequence for r in dg.with_decoys(table(spark)).collect()}
    assert rows["DECOY_P2"] == PROTEINS[1][1][::-1] and len(rows) == 8


def ions(sequence, max_charge):
    out = {}
    total = mh(sequence)
    for z in range(1, max_charge + 1):
        run = 0
        for r in sequence[:-1]:
            run += MASS[r]
            for single in (run + PROTON, total - run):
                mz = (single + (z - 1) * PROTON) // z
                out.setdefault(math.floor(mz / 1e6 / 1.0005 + (1 - 0.4)), z)
    return out


def test_fragment_bins_agree_with_ions(spark):
    sequences = ["PEPTIDEK", "AAAAAAAAAAR", "mMCWYVLK", "GGGGGGGGGGGGK"]
    peptides = spark.createDataFrame([(s, mh(s)) for s in sequences], "sequence string, mass_uda bigint")
    by_row = {(r.sequence, r.bin): r.z for r in dg.fragment_ions(peptides, 3).groupBy("sequence", "bin").agg(F.min("charge").alias("z")).collect()}
    for row in dg.with_fragment_bins(peptides).collect():
        expected = ions(row.sequence, 3)
        got = {b: z for z, bins in ((1, row.bins1), (2, row.bins2), (3, row.bins3)) for b in bins}
        assert got == expected == {b: z for (s, b), z in by_row.items() if s == row.sequence}


def vector_by_hand(peaks):
    root = {}
    for mz, intensity in peaks:
        b = math.floor(mz / 1.0005 + (1 - 0.4))
        root[b] = max(root.get(b, 0.0), math.sqrt(intensity))
    top, highest = max(root.values()), max(root)
    width = highest // 10 + 1
    tops = {}
    for b, v in root.items():
        tops[b // width] = max(tops.get(b // width, 0.0), v)
    y = {b: math.floor(v * 50000.0 / tops[b // width] + 0.5) for b, v in root.items() if v > 0.05 * top}
    return [150 * y.get(b, 0) - sum(y.get(b + d, 0) for d in range(-75, 76) if d) for b in range(highest + 76)]


SF = "/root/testdata/sf0.001"


def brute_force(peptides, spectra, n=5):
    best = {}
    for s in spectra:
        vector = vector_by_hand([tuple(p) for p in s.peaks])
        target = math.floor((s.precursor_mz * s.charge - 1.00727646688 * s.charge + 1.00727646688) * 1e6 + 0.5)
        rows = []
        for sequence, mass in peptides:
            if abs(mass - target) <= 3_000_000:
                bins = ions(sequence, max(1, min(3, s.charge - 1)))
                rows.append((-sum(vector[b] for b in bins if b < len(vector)), sequence))
        best[s.spectrum_id] = [(seq, -score) for score, seq in sorted(rows)[:n]]
    return best


@pytest.mark.parametrize("max_broadcast_bytes", [0, 1 << 30])
def test_search_against_brute_force(spark, max_broadcast_bytes):
    proteins = benchmark_proteins(spark, SF)
    spectra = benchmark_spectra(spark, SF)
    peptides = [(r.sequence, r.mass_uda) for r in se.peptide_table(proteins).collect()]
    assert any("m" in s for s, _ in peptides)
    expected = brute_force(peptides, spectra.collect())
    hits = se.search(proteins, spectra, max_broadcast_bytes=max_broadcast_bytes).collect()
    got = {}
    for r in sorted(hits, key=lambda r: r.hit_rank):
        got.setdefault(r.spectrum_id, []).append((r.peptide, r.xcorr_sum))
    assert got == expected


def test_known_answer(spark):
    """Spectra made from peptides of the database rank their own peptide first (or one of equal score)."""
    hits = se.search(benchmark_proteins(spark, SF), benchmark_spectra(spark, SF)).collect()
    first = {r.spectrum_id: r for r in hits if r.hit_rank == 1}
    own = sum(r.peptide == r.spectrum_id for r in first.values())
    assert own >= 0.95 * len(first) > 100


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_same_rows_for_any_partitioning(spark, partitions):
    proteins = benchmark_proteins(spark, SF).repartition(partitions)
    spectra = benchmark_spectra(spark, SF).repartition(partitions)
    hits = se.search(proteins, spectra).agg(F.count("*"), F.sum("xcorr_sum"), F.sum(F.xxhash64("peptide", "hit_rank").cast("decimal(38,0)"))).first()
    if not hasattr(test_same_rows_for_any_partitioning, "seen"):
        test_same_rows_for_any_partitioning.seen = hits
    assert hits == test_same_rows_for_any_partitioning.seen


def test_spectrum_filter(spark):
    schema = f"spectrum_id string, ms_level int, charge int, scan_num int, peaks array<struct<mz:double,intensity:double>>"
    peaks = [(100.0 + i, float(i)) for i in range(12)]
    rows = [("ok", 2, 2, 5, peaks), ("ms1", 1, 2, 5, peaks), ("few", 2, 2, 5, peaks[:9]), ("z9", 2, 9, 5, peaks), ("nocharge", 2, None, 50, peaks)]
    spectra = spark.createDataFrame(rows, schema)
    assert {r.spectrum_id for r in sp.filter_spectra(spectra).collect()} == {"ok", "nocharge"}
    assert {r.spectrum_id for r in sp.filter_spectra(spectra, scan_range=(10, 0)).collect()} == {"nocharge"}
    assert sp.filter_spectra(spectra, min_intensity=3.0).isEmpty()


def test_unsupported_settings_are_refused(spark):
    with pytest.raises(ValueError, match="not supported"):
        se.check_settings({"isotope_error": 1})
    with pytest.raises(ValueError, match="unknown"):
        se.check_settings({"nonsense": 1})
    se.check_settings({"use_A_ions": 0})
    with pytest.raises(ValueError, match="unknown enzyme"):
        dg.cut_marks("sequence", "Nothing")


def test_score_batches_without_result(spark):
    pairs = spark.createDataFrame([("a", "x"), ("b", "y")], "proteins string, spectra string")
    rows = se.score_batches(pairs, lambda p, s: None if p == "a" else [{"hit": p + s}], "hit string").collect()
    assert [r.hit for r in rows] == ["by"]


def test_batches_meet_the_spectra_of_modified_forms(spark, tmp_path):
    """The heaviest peptide of a batch has M; its modified form is as heavy as a spectrum that no plain mass of the batch meets."""
    light = ["".join(letters) + "K" for letters in itertools.product("GA", repeat=8)][:199]
    items = [*light, "AAAAAAMAAAK", "AAAAAAFAAAK"]
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = [tuple(r) for r in QUERIES["score_batches_native"](spark, str(tmp_path)).select("spectrum_id", "peptide", "xcorr_sum", "hit_rank").collect()]
    hits = se.search(benchmark_proteins(spark, str(tmp_path)), benchmark_spectra(spark, str(tmp_path)))
    want = [tuple(r) for r in hits.select("spectrum_id", "peptide", "xcorr_sum", "hit_rank").collect()]
    assert sorted(got) == sorted(want)
    assert {r[1] for r in got if r[0] == "AAAAAAFAAAK"} == {"AAAAAAFAAAK", "AAAAAAmAAAK"}
