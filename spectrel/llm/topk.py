"""Exact top-k search by inner product, with multi-resolution segment statistics.

A vector is cut into 1, 4 and 16 segments, each described by its mean and deviation. With segments of length l,

    |q - c|^2  >=  sum of l * ((mean_q - mean_c)^2 + (dev_q - dev_c)^2),

a lower bound on the distance; as |q - c|^2 = |q|^2 + |c|^2 - 2 q.c, it is an upper bound on the inner product:
sum of l * (mean_q * mean_c + dev_q * dev_c). Coarse bounds drop candidates below the k-th score known so far, finer
ones drop more, and the survivors are scored exactly. A first pass scores each query against one block of candidates,
which gives its k-th score to begin with.

Queries and candidates are packed into blocks of bounded size; every block of queries meets every block of candidates
in a step of its own, and hands on at most k rows for each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spectrel.operators.shared import written

LEVELS = (1, 4, 16)
CANDIDATES = 8192
QUERIES = 512
_BLOCK = "dim int, block bigint, n int, ids binary, vectors binary"


def scaled(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as a double; null where a component is null or not finite."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    return F.when(vector.isNotNull() & usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _packed(table: pa.Table) -> pa.Table:
    """One row for a block: its distinct (id, vector) rows by id."""
    dim, block = table["dim"][0].as_py(), table["block"][0].as_py()
    ids = table["vec_id"].to_numpy()
    vectors = table["vector"].combine_chunks().flatten().to_numpy().reshape(len(ids), dim)
    order = np.lexsort((*vectors.T[::-1], ids))
    ids, vectors = ids[order], vectors[order]
    fresh = np.ones(len(ids), bool)
    fresh[1:] = (ids[1:] != ids[:-1]) | (vectors[1:] != vectors[:-1]).any(axis=1)
    ids, vectors = ids[fresh], vectors[fresh]
    return pa.table(
        {
            "dim": pa.array([dim], pa.int32()), "block": pa.array([block], pa.int64()), "n": pa.array([len(ids)], pa.int32()),
            "ids": pa.array([ids.tobytes()], pa.binary()), "vectors": pa.array([np.ascontiguousarray(vectors).tobytes()], pa.binary()),
        }
    )


def segment_statistics(vectors: np.ndarray, level: int) -> np.ndarray:
    """Means and deviations of each segment, scaled by the root of its length, so that bounds are inner products."""
    dim = vectors.shape[1]
    edges = np.unique(np.linspace(0, dim, min(level, dim) + 1).astype(int))
    size = np.diff(edges)
    values = vectors.astype(np.float64)
    mean = np.add.reduceat(values, edges[:-1], axis=1) / size
    rest = values - np.repeat(mean, size, axis=1)
    deviation = np.sqrt(np.add.reduceat(rest * rest, edges[:-1], axis=1) / size)
    return np.hstack([mean, deviation]) * np.sqrt(np.tile(size, 2))


def exact_scores(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond 64 bits they stay at the largest or smallest bigint."""
    bound = max(1, vectors.shape[1]) * (float(np.abs(query.astype(float)).max(initial=0)) + 1) * (float(np.abs(vectors.astype(float)).max(initial=0)) + 1)
    if bound < 2**52:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    if bound < 2**62:
        return vectors @ query
    info = np.iinfo(np.int64)
    return np.array([min(max(int(s), info.min), info.max) for s in vectors.astype(object) @ query.astype(object)], np.int64)


def best_of_block(query: np.ndarray, own: int, least: int | None, ids: np.ndarray, vectors: np.ndarray, levels, rows, k: int):
    """(ids, scores) of the k best of the candidates, at most, leaving out ``own`` and scores below ``least``."""
    alive = np.flatnonzero(ids != own)
    if least is not None:
        for stats, row in zip(levels, rows):
            if len(alive) <= k:
                break
            bound = stats[alive] @ row
            slack = 1e-9 * np.abs(stats[alive]) @ np.abs(row) + 1e-3
            alive = alive[bound + slack >= least]
    score = exact_scores(query, vectors[alive])
    if least is not None:
        good = score >= least
        alive, score = alive[good], score[good]
    if len(score) > 4 * k:
        edge = np.partition(score, len(score) - k)[len(score) - k]
        good = score >= edge
        alive, score = alive[good], score[good]
    order = np.lexsort((ids[alive], -score.astype(object) if len(score) and score.min() == np.iinfo(np.int64).min else -score))[:k]
    return ids[alive][order], score[order]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cells in batch.to_pylist():
                dim = cells["dim"]
                ids, q_ids = np.frombuffer(cells["ids"], np.int64), np.frombuffer(cells["q_ids"], np.int64)
                vectors = np.frombuffer(cells["vectors"], np.int64).reshape(len(ids), dim)
                queries = np.frombuffer(cells["q_vectors"], np.int64).reshape(len(q_ids), dim)
                least = np.frombuffer(cells["least"], np.int64) if cells["least"] else None
                known = np.frombuffer(cells["known"], np.bool_) if cells["least"] else None
                levels = [segment_statistics(vectors, n) for n in LEVELS] if dim else []
                rows = [segment_statistics(queries, n) for n in LEVELS] if dim else []
                out = []
                for i, (own, query) in enumerate(zip(q_ids, queries)):
                    floor = int(least[i]) if least is not None and known[i] else None
                    out.append(best_of_block(query, own, floor, ids, vectors, levels, [r[i] for r in rows], k))
                size = [len(a) for a, _ in out]
                yield pa.record_batch(
                    {
                        "dim": pa.array(np.full(sum(size), dim, np.int32)),
                        "q_block": pa.array(np.full(sum(size), cells["q_block"], np.int64)),
                        "place": pa.array(np.repeat(np.arange(len(out), dtype=np.int32), size)),
                        "query_id": pa.array(np.repeat(q_ids, size)),
                        "vec_id": pa.array(np.concatenate([a for a, _ in out]) if out else ids[:0]),
                        "score": pa.array(np.concatenate([s for _, s in out]) if out else ids[:0]),
                    }
                )

    return run


def _floors(k: int):
    """For a block of queries, the k-th score of each, where k candidates have been scored."""

    def run(table: pa.Table) -> pa.Table:
        n = table["n"][0].as_py()
        place, score = table["place"].to_numpy(), table["score"].to_numpy()
        least, count = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
        np.minimum.at(least, place, score)
        np.add.at(count, place, 1)
        return pa.table(
            {
                "dim": table["dim"].slice(0, 1), "q_block": table["q_block"].slice(0, 1),
                "least": pa.array([least.tobytes()], pa.binary()), "known": pa.array([(count >= k).tobytes()], pa.binary()),
            }
        )

    return run


def top_k(vectors: DataFrame, queries: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "vector") -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates with the largest inner product for each query.

    ``vectors`` has an id and an array of bigint; ``queries`` says, on ``vec_id``, which rows are queries. Candidates are
    all rows but those with the query's own id; ties go to the smaller id. Fewer than k candidates: all of them.

    Rows with a null id, a null vector or a null component take no part. Vectors are compared with those of the same
    length only. Rows that repeat id and vector count once; an id with several vectors is several candidates, and several
    queries under one id. Other columns are ignored. An empty table gives no row.
    """
    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).cast("array<bigint>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull()))
    rows = written(rows.withColumns({"dim": F.size("vector"), "asks": F.coalesce(queries, F.lit(False))}), "vectors")
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if("asks").alias("n_asks"))
    sizes = sizes.withColumns({"blocks": F.ceil(F.col("n") / CANDIDATES), "q_blocks": F.ceil(F.greatest("n_asks", F.lit(1)) / QUERIES)})
    dealt = rows.join(sizes, "dim").withColumn("hash", F.xxhash64("vec_id", "vector"))

    def packed(df: DataFrame, blocks: str) -> DataFrame:
        own = df.select("dim", F.pmod("hash", F.col(blocks)).alias("block"), "vec_id", "vector")
        return own.groupBy("dim", "block").applyInArrow(_packed, _BLOCK)

    candidates = written(packed(dealt, "blocks"), "candidates")
    asked = packed(dealt.where("asks"), "q_blocks")
    asked = written(asked.select("dim", F.col("block").alias("q_block"), F.col("n").alias("q_n"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")), "queries")
    asked = asked.join(sizes.select("dim", "blocks"), "dim")
    kinds = "dim int, q_block bigint, place int, query_id bigint, vec_id bigint, score bigint"

    nothing = F.lit(None).cast("binary")
    first = asked.withColumn("block", F.pmod("q_block", F.col("blocks"))).join(candidates, ["dim", "block"])
    seeds = first.withColumns({"least": nothing, "known": nothing}).mapInArrow(_search(k), kinds)
    floors = seeds.join(asked.select("dim", "q_block", F.col("q_n").alias("n")), ["dim", "q_block"]).groupBy("dim", "q_block")
    floors = floors.applyInArrow(_floors(k), "dim int, q_block bigint, least binary, known binary")
    ready = asked.join(floors, ["dim", "q_block"], "left").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    found = ready.join(candidates, ["dim", "block"]).mapInArrow(_search(k), kinds)
    order = Window.partitionBy("dim", "q_block", "place").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
