"""File readers at split edges and on odd input; each record is read exactly once."""

import gzip
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from spectrel.operators import scans as sc
from spectrel.operators.blocks import by_row_number
from spectrel.sources import pepxml as px
from spectrel.sources import proteins as pr
from spectrel.sources import spectra as ss
from spectrel.sources import text_files as tf

FASTA = ">sp|D00000001|en a>b text\nMKRP\nAAK\n>D2\n\n>D3 third\r\nCC\r\nRDD"


def test_fasta_odd_records(spark, write_file, small_splits):
    rows = {r.accession: r for r in pr.read_proteins(spark, write_file("x.fasta", FASTA)).collect()}
    assert rows["sp|D00000001|en"].description == "a>b text"
    assert rows["sp|D00000001|en"].sequence == "MKRPAAK"
    assert rows["D2"].sequence == ""  # an empty record does not end the scan
    assert rows["D3"].sequence == "CCRDD"  # the last record is kept without a final newline
    assert rows["D3"].description == "third"
    assert len(rows) == 3


def test_fasta_splits_and_gz(spark, write_file, small_splits):
    text = "".join(f">P{i} d{i}\n{'MKRA' * (i % 40)}\nLLK\n" for i in range(500))
    path = write_file("big.fasta", text)
    read = pr.read_proteins(spark, path)
    assert read.rdd.getNumPartitions() > 50
    rows = read.collect()
    assert sorted(r.accession for r in rows) == sorted(f"P{i}" for i in range(500))
    assert {r.accession: r.sequence for r in rows}["P7"] == "MKRA" * 7 + "LLK"
    packed = os.path.join(tempfile.mkdtemp(), "big.fasta.gz")
    with gzip.open(packed, "wt") as out:
        out.write(text)
    assert pr.read_proteins(spark, packed).count() == 500


def test_fasta_shards_keep_header_and_last_record(spark):
    proteins = spark.createDataFrame([(f"P{i:03d}", "some text", "ACDK" * 50) for i in range(95)], "accession string, description string, sequence string")
    path = tempfile.mkdtemp() + "/shards"
    pr.write_proteins(proteins.coalesce(1), path, per_file=10)
    back = pr.read_proteins(spark, path)
    assert back.groupBy("source_file").count().agg(F.max("count"), F.count("*")).first()[:] == (10, 10)
    assert back.select("accession", "description", "sequence").exceptAll(proteins).isEmpty()
    assert back.count() == 95


MGF = """# preamble MASS=Monoisotopic
BEGIN IONS
TITLE=t1
PEPMASS=500.5 10
CHARGE=2+
100.1 5
200.2 6
END IONS

BEGIN IONS
PEPMASS=600.25\t7
300.5\t1.5
broken line
END IONS
"""


def test_mgf_odd_blocks(spark, write_file, small_splits):
    rows = sorted(ss.read_mgf(spark, write_file("x.mgf", MGF)).collect(), key=lambda r: r.precursor_mz)
    assert len(rows) == 2
    first, second = rows
    assert (first.spectrum_id, first.charge, first.bad_lines) == ("t1", 2, 0)
    assert [tuple(p) for p in first.peaks] == [(100.1, 5.0), (200.2, 6.0)]
    assert second.precursor_mz == 600.25 and second.charge is None and second.title is None
    assert second.spectrum_id.startswith("untitled-")
    assert second.bad_lines == 1 and len(second.peaks) == 1


def test_mgf_blocks_across_splits(spark, write_file, small_splits):
    text = "".join(f"BEGIN IONS\nTITLE=s{i}\nPEPMASS={400 + i}.5\n" + "\n".join(f"{100 + j}.25 {j}" for j in range(i % 9)) + "\nEND IONS\n" for i in range(300))
    spectra = ss.read_spectra(spark, write_file("x.mgf", text))
    assert spectra.rdd.getNumPartitions() > 50
    rows = {r.title: len(r.peaks) for r in spectra.collect()}
    assert rows == {f"s{i}": i % 9 for i in range(300)}


def test_bad_line_limit(spark, write_file):
    spectra = ss.read_mgf(spark, write_file("x.mgf", MGF))
    assert ss.check_bad_lines(spectra) == 1
    with pytest.raises(ValueError):
        ss.check_bad_lines(spectra, limit=0)


MZXML = """<?xml version="1.0"?>
<mzXML><msRun>
<scan num="1"
  msLevel="1" peaksCount="0"><peaks precision="32">AAAAAAAAAAA=</peaks>
<scan num="2" msLevel="2" peaksCount="1"><precursorMz precursorScanNum="1" precursorCharge="2">500.5</precursorMz>
<peaks precision="32" byteOrder="network">QsgAAEEgAAA=</peaks></scan></scan>
<scan num="2" msLevel="2" peaksCount="1"><precursorMz>501.5</precursorMz><peaks precision="32">QsgAAEEgAAA=</peaks></scan>
</msRun></mzXML>
"""


def test_mzxml_nested_and_repeated(spark, write_file, small_splits):
    path = write_file("x.mzXML", MZXML)
    scans = ss.read_scans(spark, path)
    assert scans.count() == 3
    last = {r.scan_num: r for r in sc.last_of_each_scan(scans).collect()}
    assert last[1].ms_level == 1 and last[2].precursor_mz == 501.5 and last[2].charge is None
    parent = scans.where("charge = 2").first()
    assert parent.parent_num == 1
    peaks = ss.read_spectra(spark, path).where("scan_num = 2 and charge = 2").first().peaks
    assert [tuple(p) for p in peaks] == [(100.0, 10.0)]
    assert ss.read_mzxml_headers(spark, path).first().header == '<?xml version="1.0"?>\n<mzXML><msRun>\n'


def test_header_of_other_file_raises(spark, write_file):
    with pytest.raises(Exception, match="not an mzXML file"):
        ss.read_mzxml_headers(spark, write_file("x.mzXML", "just text\n")).collect()


@pytest.mark.parametrize("precision,compressed", [(32, False), (64, True)])
def test_peaks_round_trip(spark, precision, compressed):
    rows = [(i, [(100.0 + j, float(j * i)) for j in range(i)]) for i in range(6)]
    spectra = spark.createDataFrame(rows, f"k int, peaks {ss.PEAKS}")
    encoded = ss.encode_peaks(spectra, precision, compressed).withColumn("precision", F.lit(precision)).withColumn("compressed", F.lit(compressed))
    back = {r.k: [tuple(p) for p in r.peaks] for r in ss.decode_peaks(encoded).collect()}
    assert back == dict(rows)


def test_shard_index_points_at_scans(spark, small_splits):
    texts = spark.range(1, 58).select(
        F.col("id").cast("int").alias("scan_num"),
        F.concat(F.lit('<scan num="'), F.col("id"), F.lit('">é'), F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")), F.lit("</scan>\n")).alias("scan_text"),
    )
    path = tempfile.mkdtemp() + "/run.mzXML"
    ss.write_mzxml_shards(texts, path, "<mzXML>é\n<msRun>\n", per_shard=20)
    files = tf.read_whole_files(spark, path, "part-*").collect()
    found = 0
    for _, text in files:
        raw = text.encode()
        shard = spark.createDataFrame([(text,)], "text string")
        for row in sc.parse_index(shard, "text", []).collect():
            assert raw[row.byte_offset :].startswith(f'<scan num="{row.scan_num}"'.encode())
            assert raw[row.index_offset :].startswith(b"<index")
            found += 1
    assert found == 57 and len(files) == 3
    # offsets computed from the split file agree with the index of the file
    offsets = sc.chunk_offsets(ss.read_scan_chunks(spark, path), len("<scan "))
    assert offsets.rdd.getNumPartitions() >= 1
    ours = {
        (r.source_file, r.n): r.at
        for r in offsets.where(~ss.is_header_chunk())
        .select("source_file", F.regexp_extract("value", r'^num="(\d+)"', 1).alias("n"), (F.col("byte_offset") - 6).alias("at"))
        .collect()
    }
    theirs = tf.read_lines(spark, path).where(F.col("value").contains("<offset ")).collect()
    assert len(theirs) == 57
    for row in theirs:
        number, at = row.value.split('"')[1], int(row.value.split(">")[1].split("<")[0])
        assert ours[(row.source_file, number)] == at


PEPXML = """<spectrum_query spectrum="S.1" index="1">
<search_result>
<search_hit hit_rank="1" peptide="AAK" protein="P&amp;1"><search_score name="xcorr" value="1.5"/></search_hit>
<search_hit hit_rank="2" peptide="CCK" protein="P2"><search_score name="xcorr" value="0.5"/></search_hit>
</search_result></spectrum_query>
<spectrum_query spectrum="S.2" index="2">
<search_hit hit_rank="1" peptide="AAK"><search_score name="xcorr" value="1.5"/></search_hit>
"""


def test_pepxml_unclosed_element(spark, write_file, small_splits):
    rows = px.read_pepxml(spark, write_file("x.pep.xml", PEPXML)).collect()
    assert [(r.spectrum_id, r.hit_rank, r.peptide, r.accession, r.xcorr) for r in sorted(rows, key=lambda r: r.hit_rank)] == [
        ("S.1", 1, "AAK", "P&1", 1.5),
        ("S.1", 2, "CCK", "P2", 0.5),
    ]
    assert px.read_pepxml(spark, write_file("empty.xml", "")).isEmpty()


def test_pepxml_file_is_well_formed(spark):
    import xml.etree.ElementTree as ET

    hits = spark.createDataFrame(
        [(f"s{i % 3}", f"PEP{i}", "A<1", i / 4) for i in range(30)], "spectrum_id string, peptide string, accession string, xcorr double"
    )
    path = tempfile.mkdtemp() + "/out"
    px.write_pepxml(hits, path, 5, tolerance=3.0)
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    text = "".join(open(os.path.join(path, f)).read() for f in parts)
    root = ET.fromstring(text.encode())
    queries = list(root.iter("spectrum_query"))
    assert [q.get("spectrum") for q in queries] == ["s0", "s1", "s2"]
    assert all([h.get("hit_rank") for h in q.iter("search_hit")] == ["1", "2", "3", "4", "5"] for q in queries)


def test_tag_repair(spark):
    lines = [
        '<mzXML xsi:schemaLocation="a b" v="1">',
        '<scan num="1">',
        '<scan num="2">',
        "</scan>",
        "</scan>",
        '<x xsi:schemaLocation="a b"/>',
        '<scan num="3">',
        "</scan>",
    ]
    expected = ['<mzXML  v="1">', '<scan num="1">', "</scan>", '<scan num="2">', "</scan>", lines[5], lines[6], "</scan>"]
    table = spark.createDataFrame([("f", i, l) for i, l in enumerate(lines)], "source_file string, pos bigint, value string")
    for rows in (1, 2, 3, 100):
        fixed = sc.repair_scan_tags(by_row_number(table, "source_file", "pos", rows))
        assert [r.value for r in fixed.orderBy("place", "sub_place").collect()] == expected


def test_counter_and_size_files(spark, write_file):
    sizes = tf.read_size_table(spark, write_file("sizes", "1000\t25\nbad\n1\t2\t3\nx\ty\n1001\t30\n"))
    assert sorted(map(tuple, sizes.collect())) == [(1000, 25), (1001, 30)]
    counters = tf.read_bin_counters(spark, write_file("c", "Binning:MZ1000=25\nOther=3\nBinning:MZ7 = 4\n"))
    assert sorted(map(tuple, counters.collect())) == [(7, 4), (1000, 25)]


def test_files_by_glob(spark):
    folder = tempfile.mkdtemp()
    for name in ("a.fasta", "b.fasta", "c.txt"):
        with open(os.path.join(folder, name), "w") as out:
            out.write(f">{name}\nMKR\n")
    assert sorted(r.accession for r in pr.read_proteins(spark, folder, "*.fasta").collect()) == ["a.fasta", "b.fasta"]
    with open(os.path.join(folder, "d.mgf"), "w") as out:
        out.write(MGF)
    assert ss.read_spectra(spark, folder, "*.mgf").count() == 2
    with open(os.path.join(folder, "e.mzXML"), "w") as out:
        out.write(MZXML)
    assert ss.read_spectra(spark, folder, "*.mzXML").count() == 3
