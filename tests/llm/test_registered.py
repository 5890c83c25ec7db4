"""The registered queries against their SQL, and the pipeline's stages."""

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from spectrel.llm.queries import QUERIES, SQL

from .helpers import prose

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "pages", "embeddings", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(frame, columns):
    cells = frame[columns].astype(object).where(frame[columns].notna(), None)
    cells = cells.map(lambda v: int(v) if isinstance(v, float) and v == int(v) else v).astype(str)  # counts with nulls come as floats
    return cells.sort_values(columns).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(name, spark, duck):
    got, expected = QUERIES[name](spark, SF).toPandas(), duck.execute(SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns) and len(got) == len(expected) > 0
    assert plain(got, columns).equals(plain(expected, columns))


def test_thirteen_operators():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    extra = [(10_001, None, None, None, None), (10_002, "", "en", "s", 0), (None, "no id " * 30, "en", "s", 180)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema)).union(docs.where("doc_id = 3")).coalesce(2)
    before = None
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert out.columns == COLUMNS
            ids = [r.doc_id for r in out.select("doc_id").collect()]
            if name == "quality":
                kept = set(ids)
                assert sum(q == (d in kept) for d, q in labels.items()) > 0.95 * len(labels)
            else:
                assert set(ids) <= set(before)
                assert len(set(ids)) == len(ids)
            before, docs = ids, out
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == set(before)


def test_texts_that_share_an_id_are_judged_apart(spark, tmp_path):
    random = np.random.default_rng(9)
    one, two, three, item = (prose(random, 60) for _ in range(4))
    rows = [(1, one), (5, one + " end"), (5, two), (6, three), (6, three + " end"), (6, item), (8, None), (8, None), (9, two + " end")]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = corpus_pipeline.keep_one_of_each(spark, docs.repartition(3), SF)
    kept = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    threes = [r for r in kept if r[0] == 6 and r[1] != item]
    assert len(threes) == 1 and threes[0][1].startswith(three)
    assert sorted([(1, one), (5, two), (6, item), (8, None), (8, None), *threes], key=str) == kept

    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = corpus_pipeline.drop_contaminated(spark, out, str(tmp_path))
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == [r for r in kept if r[1] != item]


def test_short_items_drop_no_document(spark, tmp_path):
    items = [(1, "yes"), (2, "the\tanswer is\x0bone "), (3, "the answer is not two"), (4, None), (5, "")]
    texts = ["he said yes", "so The Answer is one", "so the answer is not two", "", None]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], kinds)
    assert {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()} == {0, 1, 3, 4}


def test_run_over_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").where("false").write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
