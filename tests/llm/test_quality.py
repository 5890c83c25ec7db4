import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spectrel.llm.columns import flat
from spectrel.llm.quality import features, fit_quality, score_quality, train
from spectrel.llm.queries import QUERIES

from .helpers import prose

SF = "/root/testdata/sf0.01"


def test_linear_time_score_is_the_sum_over_pairs():
    random = np.random.default_rng(0)
    text, starts = flat(pa.array([prose(random, 12), "", "a b c"]))
    rows = features(text, starts)
    model = train(rows, np.array([1.0, 0.0, 1.0]))
    row, feature, value = model.cells(rows)
    raw, _ = model.raw(row, feature, value, 3)
    for i in range(3):
        f, x = feature[row == i], value[row == i]
        pairs = sum(model.factors[f[a]] @ model.factors[f[b]] * x[a] * x[b] for a in range(len(f)) for b in range(a))
        assert raw[i] == pytest.approx(model.bias + model.weights[f] @ x + pairs)


def test_features_do_not_depend_on_the_rows_beside():
    texts = ["", "a b c a b c a", "  ", "x", "q r s t q r s", None, "A!! 1,\nB"]
    text, starts = flat(pa.array(texts))
    together = features(text, starts)
    for i, own in enumerate(texts):
        alone = features(*flat(pa.array([own], pa.string())))
        assert np.array_equal(alone.statistics[0], together.statistics[i])
        a, b = together.first[i], together.first[i + 1]
        assert np.array_equal(alone.bucket, together.bucket[a:b]) and np.array_equal(alone.value, together.value[a:b])


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    got = QUERIES["op5_quality_scores"](spark, SF).join(labels, "doc_id").where("held_out").toPandas()
    assert len(got) > 50 and (got.predicted == got.quality).mean() > 0.97


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 3, "k"), (2, "", 3, "k"), (3, "a b c " * 30_000, 3, "k"), (3, "a b c", 3, "k"), (None, "x", 3, "k")], "doc_id bigint, text string, score int, label string")
    labels = spark.createDataFrame([(1, 1), (2, None), (3, 0), (None, 1)], "doc_id bigint, quality int")
    got = score_quality(docs, fit_quality(docs, labels)).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got) and got[0].label == "k"
    nothing = fit_quality(docs, labels.where("false"))
    assert {r.score for r in score_quality(docs, nothing).collect()} == {0.5}
    assert score_quality(docs.where("false"), nothing).count() == 0


def test_labels_of_rows_held_out_are_not_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (fit_quality(docs, some, ~held) for some in (labels, flipped))
    assert np.array_equal(one.weights, two.weights) and one.bias == two.bias


def test_one_text_of_an_id_is_learned_from(spark):
    docs = spark.createDataFrame([(i, f"word{i} and more") for i in range(40)] + [(7, "copy " * 5)] * 500, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(7, 0)] * 3 + [(None, 1), (99, 1), (5, None)], "doc_id bigint, quality int")
    once = spark.createDataFrame([(i, f"word{i} and more") for i in range(40) if i != 7], "doc_id bigint, text string")
    both = docs.where("doc_id = 7").dropDuplicates().orderBy(F.xxhash64("text")).limit(1)
    one, two = (score_quality(once, fit_quality(d, labels)).collect() for d in (docs, once.union(both)))
    assert {(r.doc_id, round(r.score, 9)) for r in one} == {(r.doc_id, round(r.score, 9)) for r in two}
