"""What a pepXML document costs: texts are cut and made once, and made after their hits are in order."""

import tempfile

from catalog import QUERIES, file_queries
from spectrel.functions.text import extract_attr
from spectrel.sources import pepxml as px

HITS = "spectrum_id string, hit_rank int, peptide string, accession string, xcorr double"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def hits(spark):
    return spark.createDataFrame([("s2", 1, "AmK", "p&1", 2.0), ("s1", 1, "AK", None, 1.5), ("s1", 2, None, "p2", 1.0)], HITS)


def test_sites_of_a_peptide_are_made_once(spark):
    made = px.query_text(hits(spark))
    assert plan(made).count("split(") == 1
    texts = {r.spectrum_id: r.value for r in made.collect()}
    assert '<mod_aminoacid_mass position="2"' in texts["s2"] and 'peptide="AMK" protein="p&amp;1"' in texts["s2"]
    assert 'hit_rank="1" peptide="AK" protein="null"' in texts["s1"] and 'hit_rank="2" peptide="null" protein="p2"' in texts["s1"]
    assert "mod_aminoacid_mass" not in texts["s1"]


def test_queries_are_cut_at_their_end(spark, write_file):
    path = write_file("a.pep.xml", '<x>\n<spectrum_query spectrum="a"><b/></spectrum_query>\n<c/>\n<spectrum_query spectrum="open">\n')
    found = px.read_queries(spark, path)
    assert "regexp_extract(concat(" not in plan(found.select("query"))
    assert [(r.spectrum_id, r.query) for r in found.collect()] == [("a", '<spectrum_query spectrum="a"><b/></spectrum_query>')]


def test_attributes_are_looked_for_by_name_first(spark):
    rows = spark.createDataFrame([('<a x:num="1" prenum="2" num="3"/>',), ('<a NUM="4"/>',), ("<a/>",), (None,)], "x string")
    found = rows.select(extract_attr("x", "num").alias("v"))
    assert [r.v for r in found.collect()] == ["3", "4", None, None]


def test_hits_are_put_in_order_before_they_are_text(spark, monkeypatch):
    seen, made = [], px.query_text
    monkeypatch.setattr(px, "query_text", lambda rows, *more: seen.append(rows) or made(rows, *more))
    path = tempfile.mkdtemp(prefix="pepxml-") + "/out"
    px.write_pepxml(hits(spark).repartition(3), path)
    assert "RepartitionByExpression" in plan(seen[0])
    lines = [r.value for r in spark.read.text(path).orderBy("_metadata.file_name").collect()]
    assert lines[0].startswith("<?xml") and lines[-1] == "</msms_pipeline_analysis>"
    assert [line for line in lines if "<spectrum_query" in line] == ['<spectrum_query spectrum="s1">', '<spectrum_query spectrum="s2">']


def test_a_document_between_steps_is_compressed(spark, tmp_path, monkeypatch):
    rows = spark.range(2000).selectExpr("id div 7 l_orderkey", "id % 50 l_partkey", "id % 9 l_suppkey", "double(id) l_extendedprice")
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(file_queries, "new_path", lambda spark, name: f"{tmp_path}/{name}")
    found = QUERIES["pepxml_details"](spark, str(tmp_path))
    assert found.where("mass_uda = 49000000 AND marked_peptide = 'AmKmC'").count() > 0
    files = [p for p in (tmp_path / "queries").iterdir() if p.name.startswith("part-")]
    text = sum(len(r.value) + 1 for r in spark.read.text(f"{tmp_path}/queries").collect())
    assert sum(p.stat().st_size for p in files) * 5 < text
