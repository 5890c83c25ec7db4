"""Block scoring, free ends, several modifications and error rates against plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spectrel.functions.fixed_values import PROTON, WATER
from spectrel.functions.masses import residue_table
from spectrel.plans import semi_digest as semi
from spectrel.plans.error_rates import error_rates
from spectrel.plans.modifications import Modification, covered_masses, marked, with_modifications
from spectrel.plans.scoring import Block, Index, Rules, Summary, mass_grid, score_pairs, score_summaries
from spectrel.plans.digest import digest, wanted_masses
from spectrel.plans.search import native_scorer, peptide_table, search
from spectrel.plans.semi_digest import EITHER_END, FREE_C_END, FREE_N_END, semi_digest
from spectrel.plans.spectra import filter_spectra, processed_bins, dense_values, strong_peaks, values_at

MASS = residue_table()


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 900), st.integers(1, 50_000), max_size=30), st.booleans())
def test_values_of_sparse_spectra(peaks, flanking):
    bins = np.array(sorted(peaks), np.int64)
    values = np.array([peaks[b] for b in sorted(peaks)], np.int64)
    dense = np.zeros(1300, np.int64)
    dense[bins + 100] = values
    plain = np.array([151 * dense[i + 100] - dense[i + 25 : i + 176].sum() for i in range(-1, 1001)])
    expected = 2 * plain[1:-1] + plain[:-2] + plain[2:] if flanking else plain[1:-1]
    assert (values_at(bins, values, np.arange(1000), flanking) == expected).all()
    for size in (1, 2, 40, 1000):
        assert (dense_values(bins, values, size, flanking) == expected[:size]).all()


def test_peaks_of_any_height_cost_no_memory(spark):
    bins, values = strong_peaks(np.array([100.0, 1e9, 1e300]), np.array([4.0, 9.0, 1.0]))
    assert len(bins) == 3 and bins[-1] == 1 << 62 and (values > 0).all()
    peaks = [(100.0 + i, 5.0) for i in range(10)] + [(1e12, 5.0), (float("inf"), 5.0), (float("nan"), 5.0), (-1.0, 5.0)]
    kind = "spectrum_id string, ms_level int, charge int, scan_num int, peaks array<struct<mz:double,intensity:double>>"
    kept = filter_spectra(spark.createDataFrame([("a", 2, 2, 1, peaks)], kind))
    assert kept.select(F.size("peaks").alias("n")).first().n == 11
    rows = processed_bins(kept.withColumn("peaks", F.filter("peaks", lambda p: p["mz"] < 1000)))
    assert rows.count() > 100


def random_index(random, n, n_bins):
    return Index(np.repeat(np.arange(n), 4), np.concatenate([np.sort(random.choice(n_bins, 4, replace=False)) for _ in range(n)]), n)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 200), st.integers(1, 7), st.booleans())
def test_bounded_search_loses_no_hit(seed, n, keep, floored):
    random = np.random.default_rng(seed)
    index = random_index(random, n, int(random.integers(5, 60)))
    values = random.integers(-20, 30, index.size) * (random.random(index.size) < random.random())
    low = int(random.integers(n))
    high = int(random.integers(low, n)) + 1
    exact = index.exact(values, low, high)
    assert (index.exact_of(values, np.arange(low, high)) == exact).all()
    floor = int(np.sort(exact)[-1] - random.integers(3)) if floored else None
    place, scores, _ = index.best(values, low, high, keep, floor)
    assert (scores == exact[place - low]).all() and len(set(place.tolist())) == len(place)
    nth = np.sort(exact)[-keep] if len(exact) >= keep else exact.min()
    needed = set((np.flatnonzero((exact >= nth) & (exact >= (floor if floored else nth))) + low).tolist())
    assert needed <= set(place.tolist())


def plain_windows(sequence, termini, missed, low, high, lengths):
    cuts = {0, len(sequence)} | {i for i in range(1, len(sequence)) if sequence[i - 1] in "KR" and sequence[i] != "P"}
    out = []
    for s in range(len(sequence)):
        for e in range(s + 1, len(sequence) + 1):
            mass = sum(MASS.get(c, 0) for c in sequence[s:e]) + WATER + PROTON
            ends = (s in cuts, e in cuts)
            fits = {EITHER_END: any(ends), 2: all(ends), FREE_C_END: ends[0], FREE_N_END: ends[1]}[termini]
            if fits and low <= mass <= high and lengths[0] <= e - s <= lengths[1] and sum(s < c < e for c in cuts) <= missed:
                prev, after = sequence[s - 1] if s else "-", sequence[e] if e < len(sequence) else "-"
                out.append((sequence[s:e], mass, sum(s < c < e for c in cuts), s + 1, e, prev, after))
    return sorted(out)


@pytest.mark.parametrize("termini", [EITHER_END, 2, FREE_C_END, FREE_N_END])
def test_free_ends(spark, termini):
    random = np.random.default_rng(termini)
    letters = list("AGKRPMSTLX")
    sequences = ["", "K", "KKKPRR", "AAAAAAAA", None, *("".join(random.choice(letters, int(random.integers(1, 60)))) for _ in range(25))]
    proteins = spark.createDataFrame([(f"p{i}", s) for i, s in enumerate(sequences)], "accession string, sequence string")
    rows = semi_digest(proteins.repartition(3), termini=termini, missed=1, mass_range=(300.0, 1500.0), length_range=(2, 14))
    got = {}
    for r in rows.collect():
        got.setdefault(r.accession, []).append((r.sequence, r.mass_uda, r.missed, r.start, r.end, r.prev, r.next))
    expected = {f"p{i}": plain_windows(s, termini, 1, 300_000_000, 1_500_000_000, (2, 14)) for i, s in enumerate(sequences) if s}
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in expected.items() if v}
    once = semi_digest(proteins, termini=termini, missed=1, mass_range=(300.0, 1500.0), length_range=(2, 14), places=False).collect()
    assert sorted({(k, r[0]) for k, v in expected.items() for r in v}) == sorted((r.accession, r.sequence) for r in once)
    with pytest.raises(ValueError, match="termini"):
        semi_digest(proteins, termini=3)


def test_modifications_of_all_kinds(spark):
    mods = [Modification("M", 10.0, 2), Modification("MS", 3.0, 1), Modification("n", 1.0, 1), Modification("Kc", 100.0, 2)]
    peptides = spark.createDataFrame([("AMSK", 400_000_000, "p"), ("GG", 390_000_000, "q"), ("MMM", 600_000_000, "r")], "sequence string, mass_uda bigint, accession string")
    got = sorted((r.sequence, r.mass_uda, r.n_mods, r.accession) for r in with_modifications(peptides, mods, most_in_all=3, mass_range=(0.0, 2000.0)).collect())

    def brute(sequence, mass):
        places = [-1, *range(len(sequence)), len(sequence)]
        out = []

        def go(k, placed):
            if k == len(places):
                counts = [sum(v == j + 1 for v in placed.values()) for j in range(4)]
                if sum(counts) <= 3 and all(c <= m.most for c, m in zip(counts, mods)):
                    out.append((marked(sequence, placed), mass + sum(c * m.added_uda for c, m in zip(counts, mods)), sum(counts)))
                return
            go(k + 1, placed)
            p = places[k]
            sign = "n" if p == -1 else "c" if p == len(sequence) else sequence[p]
            for j, m in enumerate(mods):
                if sign in m.residues:
                    go(k + 1, placed | {p: j + 1})

        go(0, {})
        return out

    expected = [(*r, a) for s, m, a in (("AMSK", 400_000_000, "p"), ("GG", 390_000_000, "q"), ("MMM", 600_000_000, "r")) for r in brute(s, m)]
    assert got == sorted(expected)
    spectra = spark.createDataFrame([(409_990_000, 410_010_000), (399_000_000, 400_000_000)], "low_uda bigint, high_uda bigint")
    few = with_modifications(peptides, mods, 3, (0.0, 2000.0), covered_masses(spectra, (0.0, 2000.0))).collect()
    wanted = {r for r in got if 399_000_000 <= r[1] <= 400_000_000 or 409_990_000 <= r[1] <= 410_010_000}
    assert wanted <= {(r.sequence, r.mass_uda, r.n_mods, r.accession) for r in few} < set(got)
    for bad in ([], [Modification("m", 1.0)], [Modification("M", 1.0, 0)]):
        with pytest.raises(ValueError):
            with_modifications(peptides, bad)


def test_fragments_of_marked_peptides():
    added = (79_966_331, 42_010_565)
    rules = Rules(max_charge=1, fragment_bin=0.02, fragment_offset=0.0, added=added)
    table = pa.table({"sequence": ["n2AS1MK", "ASMK"], "accession": ["a", "b"], "mass_uda": pa.array([0, 0], pa.int64())})
    residues = [MASS["A"] + added[1], MASS["S"] + added[0], MASS["M"], MASS["K"]]
    total = sum(residues) + WATER + PROTON
    table = table.set_column(2, "mass_uda", pa.array([total, sum(MASS[c] for c in "ASMK") + WATER + PROTON], pa.int64()))
    block = Block(table, rules)
    row = block.sequence.to_pylist().index("n2AS1MK")
    index = block.index(2)
    got = set(index.bins[index.start[row] : index.start[row + 1]].tolist())
    prefix = np.cumsum(residues)[:-1]
    assert got == {int(np.floor(m / 1e6 / 0.02 + 1.0)) for m in [*(prefix + PROTON), *(total - prefix)]}


def peptide_rows(random, n):
    out = {}
    while len(out) < n:
        s = "".join(random.choice(list("AGSTLVDEFK"), int(random.integers(6, 16))))
        out[s] = sum(MASS[c] for c in s) + WATER + PROTON
    return [(s, f"p{i % 7}", m) for i, (s, m) in enumerate(out.items())]


def test_all_forms_and_grids_give_the_same(spark):
    random = np.random.default_rng(8)
    rows = peptide_rows(random, 600) + [("AAAAAAAAAA", "hot", 5)] * 0
    peptides = spark.createDataFrame(rows, "sequence string, accession string, mass_uda bigint")
    spectra_rows = []
    for i in range(40):
        mass = int(rows[i * 3][2])
        bins = np.unique(random.integers(50, 1200, 60))
        spectra_rows.append(("f", f"s{i}", int(random.integers(1, 5)), mass - 60_000_000, mass + 60_000_000, bins.tolist(), random.integers(1, 50_000, len(bins)).tolist()))
    kinds = "source_file string, spectrum_id string, charge int, low_uda bigint, high_uda bigint, bins array<bigint>, values array<bigint>"
    spectra = spark.createDataFrame(spectra_rows, kinds)
    rules = Rules(n=4, score_bins=None)
    block = Block(pa.table([[r[k] for r in rows] for k in range(3)], names=["sequence", "accession", "mass_uda"]), rules)
    expected, pairs, totals = {}, set(), {}
    for f, name, charge, low, high, bins, values in spectra_rows:
        a, b = block.run(low, high)
        index = block.index(charge)
        exact = index.exact(values_at(np.array(bins), np.array(values), np.arange(index.size)), a, b).tolist()
        names = block.sequence.to_pylist()[a:b]
        pairs |= {(name, p, v) for p, v in zip(names, exact)}
        expected[name] = sorted(zip((-v for v in exact), names))[:4]
        totals[name] = b - a
    sizes = [{}, {"per_block": 20, "pairs_per_cell": 50}, {"per_block": 100, "pairs_per_cell": 300}]
    for most, size in [(1 << 20, {}), *((0, s) for s in sizes)]:
        got, counts, bins = {}, {}, {}
        rules = Rules(n=4, lists_from=0 if len(size) != 1 else 1000)
        for r in score_summaries(peptides, spectra, rules, most, **size).collect():
            got.setdefault(r.spectrum_id, []).extend((-h.xcorr_sum, h.peptide) for h in r.hits)
            counts[r.spectrum_id] = counts.get(r.spectrum_id, 0) + r.n_candidates
        assert {k: sorted(v)[:4] for k, v in got.items()} == {k: v for k, v in expected.items() if v}
        assert counts == {k: v for k, v in totals.items() if v}
        for r in score_summaries(peptides, spectra, Rules(n=4, score_bins=10), most, **size).collect():
            bins[r.spectrum_id] = bins.get(r.spectrum_id, 0) + sum(r.score_counts)
        assert bins == counts
    for size in sizes:
        every = score_pairs(peptides, spectra, rules, **size).collect()
        assert len(every) == len(pairs) and {(r.spectrum_id, r.peptide, r.xcorr_sum) for r in every} == pairs
    assert mass_grid(peptides, spectra, per_block=20, pairs_per_cell=50).cells > 30
    assert score_summaries(peptides.where("false"), spectra, rules, 0).collect() == []
    assert score_summaries(peptides, spectra.where("false"), rules, 0).collect() == []


def test_spectra_of_the_summary_keep_ties():
    rules = Rules(n=2, max_charge=1)
    mass = 2 * MASS["A"] + MASS["G"] + WATER + PROTON
    rows = [("AAG", "p", mass), ("AGA", "q", mass), ("GAA", "r", mass)]
    block = Block(pa.table([[r[k] for r in rows] for k in range(3)], names=["sequence", "accession", "mass_uda"]), rules)
    summary = Summary()
    summary.add(block, 2, mass, mass, np.array([5000]), np.array([7]))
    assert [p for _, p, _ in summary.hits] == ["AAG", "AGA"] and summary.candidates == 3


def test_error_rates(spark):
    random = np.random.default_rng(4)
    rows = [(int(random.integers(60)), bool(random.random() < 0.4)) for _ in range(400)] + [(None, False)]
    hits = spark.createDataFrame(rows, "xcorr_sum bigint, is_decoy boolean").repartition(5)
    scored = [(s, d) for s, d in rows if s is not None]
    rate = {t: min(1.0, sum(d for s, d in scored if s >= t) / max(1, sum(not d for s, d in scored if s >= t))) for t in {s for s, _ in scored}}
    least = {t: min(rate[u] for u in rate if u <= t) for t in rate}
    got = error_rates(hits).collect()
    assert len(got) == len(rows)
    assert all((r.error_rate is None) if r.xcorr_sum is None else abs(r.error_rate - least[r.xcorr_sum]) < 1e-12 for r in got)
    assert error_rates(hits.where("false")).collect() == []


def test_the_native_scorer_is_the_search(spark):
    random = np.random.default_rng(6)
    proteins = [(f"P{i}", "".join(random.choice(list("AGSTLVDEFMKR"), 200))) for i in range(40)]
    fasta = "".join(f">{a} text\n{s[:60]}\n{s[60:]}\n" for a, s in proteins)
    blocks, rows = [], []
    for i in range(16):
        peaks = sorted((float(m), float(v)) for m, v in zip(random.uniform(100, 900, 30), random.integers(1, 900, 30)))
        mz, charge = float(random.uniform(400, 700)), int(random.integers(1, 4))
        rows.append((f"s{i}", f"s{i}", 2, mz, charge if i else None, i, peaks))
        head = f"BEGIN IONS\nTITLE=s{i}\nPEPMASS={mz!r}\n" + (f"CHARGE={charge}+\n" if i else "")
        blocks.append(head + "".join(f"{m!r} {v!r}\n" for m, v in peaks) + "END IONS\n")
    kinds = "spectrum_id string, title string, ms_level int, precursor_mz double, charge int, scan_num int, peaks array<struct<mz:double,intensity:double>>"
    hits = search(spark.createDataFrame(proteins, "accession string, sequence string"), spark.createDataFrame(rows, kinds))
    got = sorted(native_scorer()(fasta, "".join(blocks)), key=lambda h: (h["spectrum_id"], -h["xcorr_sum"], h["peptide"], h["charge"]))
    best = [h for i, h in enumerate(got) if sum(g["spectrum_id"] == h["spectrum_id"] for g in got[:i]) < 5]
    assert len(best) > 20
    assert [(h["spectrum_id"], h["charge"], h["peptide"], h["accession"], h["xcorr_sum"]) for h in best] == [
        (r.spectrum_id, r.charge, r.peptide, r.accession, r.xcorr_sum) for r in hits.orderBy("spectrum_id", "hit_rank").collect()
    ]
    assert native_scorer()("", "".join(blocks)) == [] and native_scorer()(fasta, "") == []


@pytest.mark.parametrize("termini", [1, 2, 8, 9])
def test_peptides_are_summed_up_where_they_are_made(spark, monkeypatch, termini):
    """The same sums as from the rows: accessions that repeat, letters outside ASCII, nothing, and equal texts in groups."""
    monkeypatch.setattr(semi, "ROWS_OUT", 50)
    long = "".join(random.Random(7).choices("AEKRPGLM", k=300))
    rows = [("a", long + long), ("a", "MKRPAAKWWMEDLVRKPGGSTMNNMLK"), ("b", "AEPTIDEKÄAEPTIDEKLLLLLLK"), ("c", ""), ("d", None), (None, long)]
    proteins = spark.createDataFrame(rows, "accession string, sequence string")
    names = ["mass_uda", "missed", "start", "end"]
    for places in (True, False):
        used = names if places else names[:2]
        found = semi.semi_digest(proteins, termini=termini, places=places, sums=used)
        got = found.groupBy("accession").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in used])
        every = semi.semi_digest(proteins, termini=termini, places=places).groupBy("accession")
        want = every.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in used])
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        assert found.count() <= 4
    with pytest.raises(ValueError, match="no numbers"):
        semi.semi_digest(proteins, sums=["sequence"])


def test_fragments_are_made_where_spectra_look(spark):
    """A level of charges has lists only for the peptides that a spectrum of such a charge can meet."""
    sequences = [a + b + c + "EPTIDEK" for a in "GASPVTLND" for b in "GASPVTLND" for c in "GAW"]
    table = pa.table({"sequence": sequences, "accession": ["p"] * len(sequences), "mass_uda": [sum(MASS[r] for r in s) + WATER + PROTON for s in sequences]})
    whole, block = Block(table, Rules()), Block(table, Rules())
    edges = np.quantile(whole.mass, [0.1, 0.3, 0.5, 0.9]).astype(np.int64)
    low, high, charge = edges[[0, 2, 3]], edges[[1, 2, 2]], np.array([2, 4, 3])  # the last window is empty
    block.only_for(charge, low, high)
    for z, a, b in zip(charge.tolist(), low.tolist(), high.tolist()):
        own, every = block.index(z), whole.index(z)
        inside = (block.mass >= a) & (block.mass <= b)
        assert ((np.diff(own.start) > 0) == inside).all()
        s, e = block.run(a, b)
        if s < e:
            assert (own.bins[own.start[s] : own.start[e]] == every.bins[every.start[s] : every.start[e]]).all()


def test_only_forms_that_a_spectrum_asks_for_are_made(spark):
    text = "".join(random.Random(3).choices("AEKRPGLMMSTVDIN", k=6000))
    proteins = spark.createDataFrame([("a", text), ("b", text[500:900] + "WWWWK")], "accession string, sequence string")
    windows = spark.createDataFrame([(m * 1_000_000 - 2_000, m * 1_000_000 + 507_000) for m in range(601, 3000, 37)], "low_uda bigint, high_uda bigint")
    covered = covered_masses(windows)
    every = peptide_table(proteins).where(F.col("mass_uda").isNotNull())
    some = peptide_table(proteins, covered=covered)
    want = sorted(tuple(r) for r in every.collect() if covered[r.mass_uda // 10_000])
    assert sorted(map(tuple, some.collect())) == want and 0 < len(want) < every.count() / 4
    plain = peptide_table(proteins, covered=covered, modify=False)
    assert sorted(r.sequence for r in plain.collect()) == sorted(r.sequence for r in peptide_table(proteins, modify=False).collect() if covered[r.mass_uda // 10_000])
    # a peptide stays out of the shuffle only where none of its forms is asked for
    kept = {r.sequence for r in digest(proteins, places=False, wanted=wanted_masses(covered)).collect()}
    assert {p.upper() for p, *_ in want} <= kept < {r.sequence for r in digest(proteins, places=False).collect()}
