"""Rows that are packed for a shuffle, and the steps that move them."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalog import QUERIES
from spectrel.operators.packed import pack, packed, unpack
from spectrel.plans import scoring
from spectrel.plans.digest import digest, distinct_peptides, search_peptides
from spectrel.plans.search import candidates

DIGESTED = "accession string, sequence string, mass_uda bigint, start int, prev string, next string"


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_packed_rows_come_back():
    rows = {"k": [2, 1, 2, 1, 2], "text": ["ä", None, "", "PEP", "x" * 70], "n": [5, None, -7, 1 << 60, 3], "small": pa.array([1, 2, 3, 4, 5], pa.int32())}
    table = pa.table(rows)
    got = {}
    for batch in pack(table, ["k"]):
        for i in range(batch.num_rows):
            part = pa.Table.from_batches([batch.slice(i, 1)])
            got[part["k"][0].as_py()] = unpack(part, table.drop_columns("k").schema).to_pylist()
    assert got == {k: [{c: r[c] for c in ("text", "n", "small")} for r in table.to_pylist() if r["k"] == k] for k in (1, 2)}
    assert list(pack(table.slice(0, 0), ["k"])) == []


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_rows_are_packed_by_task(spark, most):
    rows = [(i % 3, f"t{i}", i * i) for i in range(50)]
    moved, schema = packed(spark.createDataFrame(rows, "k bigint, t string, v bigint"), ["k"], most=most)
    back = moved.groupBy("k").applyInArrow(lambda cell: unpack(cell, schema), "t string, v bigint")
    assert sorted(tuple(r) for r in back.collect()) == sorted(r[1:] for r in rows)


def places(spark):
    rows = [("B", "PEPK", 10, 4, "K", "A"), ("A", "PEPK", 10, 9, "-", "R"), ("A", "PEPK", 10, 2, "R", "-"), ("A", "AAK", 7_000_000, 1, "-", "-")]
    rows += [("A", "PEPK", 11, 3, "K", "K"), (None, "NULLK", 10, 1, "-", "-"), ("Z", "NULLK", 10, 1, "-", "-"), ("A", "XK", None, 1, "-", "-")]
    return spark.createDataFrame(rows, DIGESTED).repartition(3)


def test_places_and_proteins_are_counted_and_move_once(spark):
    found = distinct_peptides(places(spark))
    got = {(r.sequence, r.mass_uda): tuple(r)[2:] for r in found.collect()}
    assert got == {
        ("PEPK", 10): (2, 3, "A", 2, 5, "R", "-"), ("PEPK", 11): (1, 1, "A", 3, 6, "K", "K"), ("AAK", 7_000_000): (1, 1, "A", 1, 3, "-", "-"),
        ("NULLK", 10): (2, 2, None, 1, 5, "-", "-"), ("XK", None): (1, 1, "A", 1, 2, "-", "-"),
    }
    assert exchanges(distinct_peptides(spark.createDataFrame([], DIGESTED))) == 1


def test_all_places_of_a_peptide_are_kept(spark):
    """Every protein and place, in order, however the rows lie in tasks."""
    held, want = distinct_peptides(places(spark), places=True), {}
    for r in places(spark).collect():
        want.setdefault((r.sequence, r.mass_uda), []).append((r.accession, r.start, r.start + len(r.sequence) - 1, r.prev, r.next))
    got = {(r.sequence, r.mass_uda): [tuple(p) for p in r.places] for r in held.collect()}
    assert got == {k: sorted(v, key=lambda p: (p[0] or "", p[1])) for k, v in want.items()}
    assert sorted(map(tuple, held.drop("places").collect()), key=str) == sorted(map(tuple, distinct_peptides(places(spark)).collect()), key=str)
    assert exchanges(distinct_peptides(spark.createDataFrame([], DIGESTED), places=True)) == 1
    proteins = spark.createDataFrame([(a, "AEPTIDEKAEPTIDEKLLLLLLK") for a in ("b", "a", "c")], "accession string, sequence string")
    found = {r.sequence: r for r in distinct_peptides(digest(proteins), places=True).collect()}
    assert [tuple(p) for p in found["AEPTIDEK"].places] == [(a, *p) for a in "abc" for p in ((1, 8, "-", "A"), (9, 16, "K", "L"))]


def test_the_query_gives_all_places(spark, tmp_path):
    docs = spark.createDataFrame([(d, "en", "s", "AEPTIDEKAEPTIDEKLLLLLLK") for d in range(3)], "doc_id bigint, lang string, source string, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    row = QUERIES["distinct_peptides"](spark, str(tmp_path)).where("sequence = 'AEPTIDEK'").first()
    assert row.places == ";".join(f"sp|D0000000{d}|en:{p}" for d in range(3) for p in ("1-A", "9KL"))
    assert (row.n_proteins, row.n_places) == (3, 6)


def test_peptides_of_a_search_are_packed(spark):
    rows = [("DECOY_a", "PEPK", 5), ("sp|b", "PEPK", 5), ("sp|a", "PEPK", 5), ("DECOY_c", "ONLY", 5), (None, "NULLK", 5), ("a", "NULLK", 5), ("a", None, 5)]
    found = search_peptides(spark.createDataFrame(rows, "accession string, sequence string, mass_uda bigint").repartition(3))
    assert {r.sequence: r.accession for r in found.collect()} == {"PEPK": "sp|a", "ONLY": "DECOY_c", "NULLK": None, None: "a"}
    assert found.columns == ["sequence", "mass_uda", "accession"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "packed" in plan and "Aggregate" not in plan


def test_a_peptide_moves_once_to_meet_its_spectra(spark):
    """Spectra are repeated for the bins of their windows, peptides are not."""
    peptides = spark.createDataFrame([(f"P{i}", i * 500_000, "a") for i in range(2000, 2040)], "sequence string, mass_uda bigint, accession string")
    spectra = spark.createDataFrame([("s", 2, 1_010_000_000, 1_007_000_000, 1_013_000_000)], "spectrum_id string, charge int, mh_uda bigint, low_uda bigint, high_uda bigint")
    pairs = candidates(spectra, peptides, max_broadcast_bytes=0)
    assert sorted(r.sequence for r in pairs.collect()) == [f"P{i}" for i in range(2014, 2027)]
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    repeated = [line for line in plan.splitlines() if "explode(sequence(greatest(" in line]
    assert len(repeated) == 1 and "low_uda" in repeated[0]


def test_peptides_of_a_cell_travel_as_one_row(spark, monkeypatch):
    peptides = digest(spark.createDataFrame([("a", "AEPTIDEK" * 30)], "accession string, sequence string"), places=False)
    peptides = search_peptides(peptides)
    seen = []
    real = scoring.packed
    monkeypatch.setattr(scoring, "packed", lambda *args, **more: seen.append(real(*args, **more)) or seen[-1])
    row = [("", "s", 2, 900_000_000, 5_000_000_000, [100, 200], [10, 20])]
    kinds = "source_file string, spectrum_id string, charge int, low_uda bigint, high_uda bigint, bins array<bigint>, values array<bigint>"
    pairs = scoring.score_pairs(peptides, spark.createDataFrame(row, kinds), scoring.Rules())
    assert pairs.count() == peptides.where("mass_uda >= 900000000").count() > 0
    assert seen[0][0].agg(F.sum("n_packed")).first()[0] == peptides.count()
