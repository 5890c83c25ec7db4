"""What a search over real files needs: names of files, bad records, letters, decoys, row windows."""

import os
import random
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from spectrel.functions.masses import peptide_mass
from spectrel.operators.batching import group_to_lists
from spectrel.operators.shared import new_path, scratch, written
from spectrel.plans.digest import digest, search_peptides
from spectrel.plans.search import candidates, hit_proteins, search
from spectrel.plans.spectra import with_precursor
from spectrel.sources.proteins import read_proteins
from spectrel.sources.spectra import BadLines, decode_peaks, encode_peaks, read_mgf, read_spectra, scan_xml

BLOCK = "BEGIN IONS\n{head}PEPMASS=500.5\nCHARGE=2+\n100.1 5\n200.2 6\n{end}"


def mgf(*titles, end="END IONS\n"):
    return "".join(BLOCK.format(head=f"TITLE={t}\n" if t else "", end="END IONS\n") for t in titles[:-1]) + BLOCK.format(
        head=f"TITLE={titles[-1]}\n" if titles[-1] else "", end=end
    )


def mzxml(spark, scans=(1, 2)):
    peaks = [(100.0, 5.0), (200.0, 6.0)]
    rows = [(n, 2, 500.5, 2, peaks, 2) for n in scans]
    spectra = spark.createDataFrame(rows, "scan_num int, ms_level int, precursor_mz double, charge int, peaks array<struct<mz:double,intensity:double>>, peaks_count int")
    texts = [r.scan_text for r in scan_xml(encode_peaks(spectra)).collect()]
    return "<mzXML>\n <msRun>\n" + "".join(texts) + " </msRun>\n</mzXML>"


def test_a_folder_of_both_kinds(spark, tmp_path):
    (tmp_path / "a.mgf").write_text(mgf("t1", "t2"))
    (tmp_path / "b.MGF").write_text(mgf("t1"))
    (tmp_path / "c.mzXML").write_text(mzxml(spark))
    (tmp_path / "d.mzxml").write_text(mzxml(spark))
    got = read_spectra(spark, str(tmp_path)).collect()
    names = sorted((os.path.basename(r.source_file), r.spectrum_id, len(r.peaks)) for r in got)
    assert names == [
        ("a.mgf", "t1", 2), ("a.mgf", "t2", 2), ("b.MGF", "t1", 2),
        ("c.mzXML", "scan-1", 2), ("c.mzXML", "scan-2", 2), ("d.mzxml", "scan-1", 2), ("d.mzxml", "scan-2", 2),
    ]


def test_a_file_of_neither_kind_raises(spark, tmp_path):
    (tmp_path / "a.mgf").write_text(mgf("t1"))
    (tmp_path / "notes.txt").write_text("hello")
    with pytest.raises(ValueError, match="notes.txt"):
        read_spectra(spark, str(tmp_path))
    assert read_spectra(spark, str(tmp_path), "*.mgf").count() == 1


def test_unclosed_and_equal_untitled_blocks(spark, write_file):
    rows = read_mgf(spark, write_file("x.mgf", "preamble = 1\n" + mgf("", "", "last", end=""))).collect()
    assert len(rows) == 3 and len({r.spectrum_id for r in rows}) == 3
    assert all(len(r.peaks) == 2 and r.charge == 2 for r in rows)


def test_bad_lines_are_counted_as_the_rows_are_read(spark, write_file):
    path = write_file("x.mgf", mgf("t").replace("100.1 5", "\n".join(["not a peak"] * 20)))
    assert read_spectra(spark, path).count() == 1
    for limit in (20, 19):
        counter = BadLines(limit)
        assert len(read_spectra(spark, path, bad_lines=counter).collect()) == 1
        if limit == 20:
            assert counter.check() == 20
        else:
            with pytest.raises(ValueError, match="20 lines"):
                counter.check()


def test_reading_starts_no_job_and_scans_each_file_once(spark, tmp_path):
    (tmp_path / "a.mgf").write_text("COM=run\n" + mgf("t1", ""))
    (tmp_path / "b c.mgf").write_text(mgf("t1", ""))
    (tmp_path / "c.mzXML").write_text(mzxml(spark))
    context = spark.sparkContext
    context.setJobGroup("reading", "")
    spectra = read_spectra(spark, str(tmp_path), bad_lines=BadLines())
    assert not context.statusTracker().getJobIdsForGroup("reading")
    context.setJobGroup("", "")
    plan = spectra._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 2 and "Exchange" not in plan
    got = sorted((os.path.basename(unquote(r.source_file)), r.spectrum_id) for r in spectra.collect())
    assert [(f, s) for f, s in got if not s.startswith("untitled")] == [("a.mgf", "t1"), ("b c.mgf", "t1"), ("c.mzXML", "scan-1"), ("c.mzXML", "scan-2")]
    assert len(set(got)) == 6


@pytest.mark.parametrize("splits", ["whole", "small"])
def test_what_stands_before_the_first_block(spark, write_file, splits, request):
    if splits == "small":
        request.getfixturevalue("small_splits")
    head = "COM=run\nCHARGE=2+ and 3+\n# more\n\n"
    rows = read_mgf(spark, write_file("x.mgf", head + mgf(*"abcdef"))).collect()
    assert sorted(r.spectrum_id for r in rows) == list("abcdef") and all(len(r.peaks) == 2 for r in rows)
    rows = read_proteins(spark, write_file("x.fasta", ";comment\nTITLE=x\n>p1 d\nMK\n>p2\nRR\n>p3 > x\nAA\n" * 1 + ">p4\n" + "K" * 200)).collect()
    assert sorted((r.accession, len(r.sequence)) for r in rows) == [("p1", 2), ("p2", 2), ("p3", 2), ("p4", 200)]
    rows = read_proteins(spark, write_file("y.fasta", ">p1 d\nMK\n>p2\nRR\n")).collect()
    assert sorted(r.accession for r in rows) == ["p1", "p2"]
    assert read_proteins(spark, write_file("z.fasta", "")).collect() == []
    assert read_proteins(spark, write_file("z.fasta", "no record\n")).collect() == []


def test_damaged_peaks_are_counted(spark, tmp_path):
    scans = spark.createDataFrame([(1, "AAAA", 32, False), (2, "QsgAAEEgAAA=", 32, False), (3, "***", 32, False), (4, "QsgA", 32, True)], "scan int, encoded string, precision int, compressed boolean")
    got = {r.scan: (len(r.peaks), r.bad_lines) for r in decode_peaks(scans).collect()}
    assert got == {1: (0, 1), 2: (1, 0), 3: (0, 1), 4: (0, 1)}


def test_letters_of_a_fasta_file(spark, write_file):
    got = read_proteins(spark, write_file("x.fasta", ">p1 d\nmkrPA-ak*\nUO\n")).first()
    assert got.sequence == "MKRPAAKUO" and got.left_out == 2
    masses = {r.sequence: r.m for r in digest(spark.createDataFrame([("p", "AAUOAAA")], "accession string, sequence string"), places=False).select("sequence", F.col("mass_uda").alias("m")).collect()}
    plain = 5 * 71037114 + 150953630 + 132089880 + 18010565 + 1007276
    assert masses == {"AAUOAAA": plain}
    assert spark.range(1).select(peptide_mass(F.lit("AABJXZAA")).alias("m")).first().m == 4 * 71037114 + 18010565 + 1007276


def test_a_target_is_not_reported_as_a_decoy(spark):
    rows = [("DECOY_a", "PEPTIDE", 1), ("sp|z", "PEPTIDE", 1), ("DECOY_b", "ONLY", 2)]
    got = search_peptides(spark.createDataFrame(rows, "accession string, sequence string, mass_uda bigint"))
    assert {r.sequence: r.accession for r in got.collect()} == {"PEPTIDE": "sp|z", "ONLY": "DECOY_b"}


PROTEINS = [("P1", "AAAGGGDDDEEEK" + "LLLVVVFFFYYYR"), ("P2", "AAAGGGDDDEEEK")]


def spectrum_of(spark, sequence, name, file):
    row = digest(spark.createDataFrame([("x", sequence)], "accession string, sequence string"), places=False)
    mass = row.first().mass_uda / 1e6
    from spectrel.plans.digest import fragment_ions

    ions = sorted({r.mz_uda / 1e6 for r in fragment_ions(row.select("sequence", "mass_uda")).collect()})
    peaks = [(mz, 100.0) for mz in ions]
    return (name, name, 2, (mass + 1.00727646688) / 2, 2, 1, peaks, file)


def test_equal_names_in_two_files_keep_their_own_hits(spark):
    rows = [spectrum_of(spark, "AAAGGGDDDEEEK", "scan-1", "a"), spectrum_of(spark, "LLLVVVFFFYYYR", "scan-1", "b")]
    kind = "spectrum_id string, title string, ms_level int, precursor_mz double, charge int, scan_num int, peaks array<struct<mz:double,intensity:double>>, source_file string"
    spectra, proteins = spark.createDataFrame(rows, kind), spark.createDataFrame(PROTEINS, "accession string, sequence string")
    for most in (64 << 20, 0):
        hits = search(proteins, spectra, n=1, max_broadcast_bytes=most)
        assert {(r.source_file, r.peptide) for r in hits.collect()} == {("a", "AAAGGGDDDEEEK"), ("b", "LLLVVVFFFYYYR")}
    places = hit_proteins(hits, digest(proteins)).collect()
    assert sorted((r.source_file, r.accession, r.start) for r in places) == [("a", "P1", 1), ("a", "P2", 1), ("b", "P1", 14)]


@pytest.mark.parametrize("seed", range(3))
def test_both_forms_of_the_window_join_agree(spark, seed):
    rng = random.Random(seed)
    peptides = [(f"S{i}", rng.randrange(600_000_000, 5_000_000_000)) for i in range(400)]
    spectra = []
    for i in range(80):
        mh = rng.randrange(500_000_000, 5_100_000_000)
        spectra.append((f"q{i}", 2, mh, mh - rng.randrange(30_000_000), mh + rng.randrange(60_000_000)))
    p = spark.createDataFrame(peptides, "sequence string, mass_uda bigint")
    s = spark.createDataFrame(spectra, "spectrum_id string, charge int, mh_uda bigint, low_uda bigint, high_uda bigint")
    expected = {(q[0], x[0]) for q in spectra for x in peptides if q[3] <= x[1] <= q[4] and 1_000_000_000 <= x[1] <= 4_000_000_000}
    for most in (64 << 20, 0):
        for width in (0.7, 3.0, 500.0):
            got = candidates(s, p, width, (1000.0, 4000.0), max_broadcast_bytes=most, ranges_per_cell=7, pairs_per_cell=50).select("spectrum_id", "sequence")
            assert {tuple(r) for r in got.collect()} == expected


def test_widths_and_tolerances_are_positive(spark):
    p = spark.createDataFrame([("A", 1)], "sequence string, mass_uda bigint")
    with pytest.raises(ValueError):
        candidates(p, p, 0.0)
    with pytest.raises(ValueError):
        with_precursor(p, 0.0)
    with pytest.raises(ValueError):
        with_precursor(p, 1.0, "inch")


def test_tolerance_units(spark):
    s = spark.createDataFrame([("q", 500.0, 2)], "spectrum_id string, precursor_mz double, charge int")

    def half(*args):
        r = with_precursor(s, *args).first()
        return r.high_uda - r.mh_uda

    mh = with_precursor(s, 1.0).first().mh_uda
    assert (half(1.5), half(1.5, "mmu"), half(1.5, "amu", True), half(20.0, "ppm")) == (1_500_000, 1_500, 3_000_000, mh * 20 // 1_000_000)


def test_a_short_group_is_one_list(spark):
    pairs = [(k, v) for k in "abcde" for v in range(4)] + [("z", v) for v in range(12)]
    got = {(r.k, r.part_no): r["items"] for r in group_to_lists(spark.createDataFrame(pairs, "k string, v int"), "k", "v", 5).collect()}
    assert got == {(k, 0): [0, 1, 2, 3] for k in "abcde"} | {("z", 0): [0, 1, 2, 3, 4], ("z", 1): [5, 6, 7, 8, 9], ("z", 2): [10, 11]}


def test_scratch_tables_are_deleted(spark):
    with scratch(spark):
        path = new_path(spark, "kept")
        outer = written(spark.range(5), "outer").inputFiles()
        with scratch(spark):
            inner = written(spark.range(5), "inner").inputFiles()
        assert outer and inner and not any(os.path.exists(f.removeprefix("file://")) for f in inner)
        assert all(os.path.exists(f.removeprefix("file://")) for f in outer) and not os.path.exists(path)
    assert not any(os.path.exists(f.removeprefix("file://")) for f in outer)
