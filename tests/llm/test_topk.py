import math

import numpy as np
from pyspark.sql import functions as F

import spectrel.llm.topk as topk
from spectrel.llm.topk import best_of_block, scaled, segment_statistics, top_k


def plain(rows, asks, k):
    out = []
    for q_id, q in sorted(set(rows), key=str):
        if q_id is None or q is None or not asks(q_id):
            continue
        scored = [(-sum(a * b for a, b in zip(q, c)), c_id) for c_id, c in set(rows) if c_id is not None and c is not None and c_id != q_id and len(c) == len(q)]
        out += [(q_id, rank, c_id, -score) for rank, (score, c_id) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def run(spark, rows, k=10):
    frame = spark.createDataFrame([(i, list(v) if v is not None else None, 1, "x") for i, v in rows], "vec_id bigint, vector array<bigint>, block int, ids string")
    return sorted(tuple(r) for r in top_k(frame.repartition(3), F.col("vec_id") % 5 == 0, k).collect())


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 40)
    monkeypatch.setattr(topk, "QUERIES", 7)
    random = np.random.default_rng(2)
    rows = [(i, tuple(map(int, random.integers(-50, 50, 20) + (i % 7) * 10))) for i in range(150)]
    rows += [(300 + i, rows[3][1]) for i in range(20)] + [rows[5], rows[5]]  # ties and repeated rows
    rows += [(None, rows[0][1]), (400, None), (401, (1, 2, 3)), (405, (4, 5, 6)), (410, ()), (411, ())]
    assert run(spark, rows) == plain(rows, lambda i: i % 5 == 0, 10)


def test_few_and_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(5, (1, 2))]) == []
    assert run(spark, [(5, (1, 2)), (6, (3, 4))]) == [(5, 1, 6, 11)]


def test_scores_beyond_64_bits_stay_at_the_edge(spark):
    big = 2**62
    assert run(spark, [(5, (big, big)), (6, (big, big)), (7, (-big, -big)), (8, (1, 0))]) == [
        (5, 1, 6, 2**63 - 1), (5, 2, 8, big), (5, 3, 7, -(2**63)),
    ]


def test_components(spark):
    frame = spark.createDataFrame(
        [(1, [0.5, -0.0001]), (2, [math.nan, 1.0]), (3, [math.inf, 1.0]), (4, [None, 1.0]), (5, None), (6, [])], "id int, v array<float>"
    )
    got = {r.id: r.s for r in frame.select("id", scaled(F.col("v")).alias("s")).collect()}
    assert got == {1: [512, -1], 2: None, 3: None, 4: None, 5: None, 6: []}


def test_bounds_hold_and_get_finer():
    random = np.random.default_rng(1)
    vectors, query = random.integers(-1000, 1000, (200, 30)), random.integers(-1000, 1000, (1, 30))
    real = vectors @ query[0]
    before = None
    for level in topk.LEVELS:
        bound = segment_statistics(vectors, level) @ segment_statistics(query, level)[0]
        assert (bound >= real - 1e-6).all()
        assert before is None or bound.mean() <= before
        before = bound.mean()
    levels, rows = [segment_statistics(vectors, n) for n in topk.LEVELS], [segment_statistics(query, n)[0] for n in topk.LEVELS]
    best = np.sort(real)[::-1][:10]
    _, scores = best_of_block(query[0], -1, int(best[-1]), np.arange(200), vectors, levels, rows, 10)
    assert scores.tolist() == best.tolist()
