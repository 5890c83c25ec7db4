import numpy as np

from spectrel.llm.language import BLOCK, fit_languages, label_words, marginals, predict_languages, train_field, words_of
from spectrel.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_marginals_against_plain_forward_backward():
    random = np.random.default_rng(0)
    psi, start, moves = random.random((4 * BLOCK + 3, 3)), random.random(3), random.random((3, 3))
    first = np.array([0, 1, 1, BLOCK + 1, len(psi)])
    got = marginals(psi, first, start, moves)
    for a, b in zip(first, first[1:]):
        ahead, back = [], [np.ones(3)]
        for t in range(a, b):
            ahead.append(psi[t] * (np.exp(start) if t == a else ahead[-1] @ np.exp(moves)))
            ahead[-1] /= ahead[-1].sum()
        for t in range(b - 1, a, -1):
            back.append(np.exp(moves) @ (psi[t] * back[-1]))
            back[-1] /= back[-1].sum()
        for t, (x, y) in enumerate(zip(ahead, back[::-1])):
            assert np.allclose(got[a + t], x * y / (x * y).sum())


def test_words_are_runs_of_letters():
    got = words_of(["Ab1cd É", None, "...", "cd"])
    assert got.first.tolist() == [0, 3, 3, 3, 4]
    assert got.index[1] == got.index[3] and len(got.hashes) == 3


def test_held_out_accuracy(spark):
    langs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op1_languages"](spark, SF).join(langs, "doc_id").where("held_out").toPandas()
    assert len(got) > 100 and (got.lang == got.lang_pred).mean() > 0.98 and got.score.between(0, 1).all()


def test_edges_and_code_switching(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    field = fit_languages(docs.select("doc_id", "text", "lang"))
    sample = {r.lang: r.text.split()[:12] for r in docs.where("n_chars > 800").orderBy("doc_id").collect()}
    mixed = " ".join([*sample["de"], *sample["fr"]])
    rows = [(1, None, "x", 1.0), (2, "", "x", 1.0), (3, "12 ... !", "x", 1.0), (4, mixed, "x", 1.0), (4, mixed, "x", 1.0), (None, mixed * 3000, "x", 1.0)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang_pred string, score double")
    got = predict_languages(frame, field).collect()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and [r.score for r in got[:3]] == [0.0] * 3
    assert got[3].lang_pred == got[4].lang_pred and got[3].score == got[4].score and len(got) == 6
    runs = label_words(frame.where("doc_id = 4").limit(1), field).collect()
    assert {r.lang for r in runs if r.word_to - r.word_from > 4} == {"de", "fr"}
    assert sum(r.word_to - r.word_from for r in runs) == len(words_of([mixed]).index)
    assert predict_languages(frame.where("false"), field).count() == 0


def test_without_or_with_one_language(spark):
    frame = spark.createDataFrame([(1, "abc"), (2, "7")], "doc_id bigint, text string")
    assert [r.lang_pred for r in predict_languages(frame, train_field([])).collect()] == ["und", "und"]
    assert [r.lang_pred for r in predict_languages(frame, train_field([("en", "a b")])).collect()] == ["en", "und"]
