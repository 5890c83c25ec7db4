"""Quality scores from a factorisation machine over hashed words, structure statistics and the size of a text.

The pairwise term is scored in linear time: half the sum over factors of the squared sum less the sum of squares.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .columns import SPACE, combined, flat, mix, slices, word_hashes

BUCKETS = 1 << 13
SAMPLE = 4000
FACTORS = 4
STEPS = 900  # of 64 rows, whatever the number of rows
_U = np.uint64

_KIND = np.zeros(256, np.uint8)  # classes of bytes: 1 small, 2 capital, 3 digit, 4 space, 5 part of a longer character, 0 other
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 5
_KIND[SPACE] = 4
_LINE = np.zeros(256, bool)
_LINE[[10, 13]] = True
STATISTICS = 18


def _distinct(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of distinct values in each row's run."""
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return np.bincount(r[fresh], minlength=len(first) - 1).astype(float)


def _statistics(text: np.ndarray, starts: np.ndarray, words: np.ndarray, first: np.ndarray) -> np.ndarray:
    n, size = len(starts) - 1, np.diff(starts).astype(float)
    rows = np.repeat(np.arange(n), np.diff(starts))
    kinds = np.bincount(rows * 6 + _KIND[text], minlength=6 * n).reshape(n, 6)
    shares = kinds / np.maximum(size, 1)[:, None]
    count = np.diff(first).astype(float)
    lines, line_first = word_hashes(text, starts, _LINE)
    n_lines = np.diff(line_first).astype(float)
    triples = combined(words, 3)
    word_row = np.repeat(np.arange(n), np.diff(first))
    inside = word_row[: len(triples)] == word_row[len(word_row) - len(triples) :]
    row_of = word_row[: len(triples)][inside]
    triple_first = np.searchsorted(row_of, np.arange(n + 1))
    marks = [np.bincount(rows[text == ord(c)], minlength=n) / np.maximum(count, 1) for c in "!?.,|"]
    columns = [
        np.log1p(size), np.log1p(count), size / np.maximum(count, 1), *shares.T,
        _distinct(words, first) / np.maximum(count, 1),
        _distinct(triples[inside], triple_first) / np.maximum(np.diff(triple_first), 1),
        _distinct(lines, line_first) / np.maximum(n_lines, 1), np.log1p(size / np.maximum(n_lines, 1)), *marks,
    ]
    return np.stack(columns, axis=1)


@dataclass
class Rows:
    """Feature rows: hashed word counts as (row start, bucket, value) and a matrix of statistics."""

    first: np.ndarray
    bucket: np.ndarray
    value: np.ndarray
    statistics: np.ndarray


def features(text: np.ndarray, starts: np.ndarray) -> Rows:
    words, first = word_hashes(text, starts)
    n = len(starts) - 1
    cell = np.repeat(np.arange(n), np.diff(first)) * BUCKETS + (words & _U(BUCKETS - 1)).astype(np.int64)
    cell, times = np.unique(cell, return_counts=True)
    row, value = cell // BUCKETS, np.log1p(times)
    norm = np.sqrt(np.bincount(row, value * value, minlength=n))
    return Rows(np.searchsorted(row, np.arange(n + 1)), cell % BUCKETS, value / norm[row], _statistics(text, starts, words, first))


@dataclass
class Machine:
    """A trained factorisation machine; buckets come first, statistics after them."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def cells(self, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All features of the rows as (row, feature, value)."""
        n, d = rows.statistics.shape
        dense = np.clip((rows.statistics - self.centre) / self.scale, -4, 4) / 4
        row = np.concatenate([np.repeat(np.arange(n), np.diff(rows.first)), np.repeat(np.arange(n), d)])
        feature = np.concatenate([rows.bucket, np.tile(np.arange(BUCKETS, BUCKETS + d), n)])
        return row, feature, np.concatenate([rows.value, dense.ravel()])

    def raw(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Raw score of each row, and its sum over features for each factor."""
        total = self.bias + np.bincount(row, value * self.weights[feature], minlength=n)
        sums = np.empty((n, self.factors.shape[1]))
        for f in range(sums.shape[1]):
            part = value * self.factors[feature, f]
            sums[:, f] = np.bincount(row, part, minlength=n)
            total += 0.5 * (sums[:, f] ** 2 - np.bincount(row, part * part, minlength=n))
        return total, sums

    def scores(self, rows: Rows) -> np.ndarray:
        n = len(rows.first) - 1
        return 1 / (1 + np.exp(-np.clip(self.raw(*self.cells(rows), n)[0], -30, 30)))


def train(rows: Rows, labels: np.ndarray) -> Machine:
    """Logistic loss by AdaGrad over batches of 64 rows, in a fixed order."""
    n, d = rows.statistics.shape
    rate = (labels.sum() + 1) / (n + 2)
    random = np.random.default_rng(7)
    width = BUCKETS + d
    centre = np.median(rows.statistics, axis=0) if n else np.zeros(d)
    scale = rows.statistics.std(axis=0) + 1e-6 if n else np.ones(d)
    model = Machine(float(np.log(rate / (1 - rate))), np.zeros(width), random.normal(0, 0.05, (width, FACTORS)), centre, scale)
    if n == 0 or labels.min() == labels.max():
        model.factors[:] = 0
        return model
    row, feature, value = model.cells(rows)
    order = np.argsort(row, kind="stable")
    row, feature, value = row[order], feature[order], value[order]
    first = np.searchsorted(row, np.arange(n + 1))
    seen_w, seen_v, seen_b = np.full(width, 1e-8), np.full((width, FACTORS), 1e-8), 1e-8
    batches = max(1, n // 64)
    for _ in range(-(-STEPS // batches)):
        for batch in np.array_split(random.permutation(n), batches):
            pick = np.concatenate([np.arange(first[i], first[i + 1]) for i in batch])
            r = np.repeat(np.arange(len(batch)), first[batch + 1] - first[batch])
            f, x = feature[pick], value[pick]
            raw, sums = model.raw(r, f, x, len(batch))
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[batch]) / len(batch)
            used, place = np.unique(f, return_inverse=True)
            step = error[r] * x
            g = np.bincount(place, step) + 1e-5 * model.weights[used]
            seen_w[used] += g * g
            seen_b += error.sum() ** 2
            model.bias -= 0.1 * error.sum() / np.sqrt(seen_b)
            for k in range(FACTORS):
                v = model.factors[used, k]
                h = np.bincount(place, step * (sums[r, k] - x * v[place])) + 1e-4 * v
                seen_v[used, k] += h * h
                model.factors[used, k] = v - 0.05 * h / np.sqrt(seen_v[used, k])
            model.weights[used] -= 0.1 * g / np.sqrt(seen_w[used])
    return model


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, starts = flat(batch.column("text"))
        for a, b in slices(starts):
            rows = features(text[starts[a] : starts[b]], starts[a : b + 1] - starts[a])
            cuts = list(zip(rows.first[:-1], rows.first[1:]))
            yield pa.record_batch(
                {
                    "label": batch.column("label").slice(a, b - a),
                    "bucket": pa.array([rows.bucket[i:j].astype(np.int32).tobytes() for i, j in cuts], pa.binary()),
                    "value": pa.array([rows.value[i:j].tobytes() for i, j in cuts], pa.binary()),
                    "statistics": pa.array([s.tobytes() for s in rows.statistics], pa.binary()),
                }
            )


def fit_quality(docs: DataFrame, labels: DataFrame, usable: Column | None = None, sample: int = SAMPLE) -> Machine:
    """A machine for the ``quality`` of ``labels``, from at most ``sample`` labelled rows chosen by a hash of their id.

    ``docs`` has doc_id and text, ``labels`` has doc_id and quality; ``usable`` may narrow the ids that are learned from.
    Of several labels or texts of one id the one with the least hash is learned from; null ids, labels other than 0 and 1 and
    labels without a document are left out. Without any label the machine scores every text alike.
    """
    chosen = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("double").alias("label")).where("label IN (0, 1) AND doc_id IS NOT NULL")
    if usable is not None:
        chosen = chosen.where(usable)
    chosen = chosen.groupBy("doc_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")  # at most ``sample`` ids
    one_text = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    texts = texts.groupBy("doc_id").agg(F.first("label").alias("label"), one_text)  # so at most ``sample`` rows reach the driver
    kinds = "label double, bucket binary, value binary, statistics binary"
    table = texts.select("label", "text").mapInArrow(_feature_rows, kinds).toArrow()
    order = np.argsort(np.array([hash_of(v.as_py()) for v in table["statistics"]], np.uint64), kind="stable")
    table = table.take(pa.array(order))
    bucket = [np.frombuffer(v.as_buffer(), np.int32) for v in table["bucket"]]
    value = [np.frombuffer(v.as_buffer(), np.float64) for v in table["value"]]
    statistics = np.array([np.frombuffer(v.as_buffer(), np.float64) for v in table["statistics"]]).reshape(-1, STATISTICS)
    rows = Rows(
        np.concatenate([[0], np.cumsum([len(b) for b in bucket])]).astype(np.int64),
        np.concatenate([np.zeros(0, np.int32), *bucket]).astype(np.int64),
        np.concatenate([np.zeros(0), *value]),
        statistics,
    )
    return train(rows, table["label"].to_numpy().astype(float))


def hash_of(cell: bytes) -> int:
    """Order of training rows that doesn't depend on partitions."""
    return int(mix(np.frombuffer(cell, np.uint64)).sum())


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, starts = flat(batch.column("text"))
            for a, b in slices(starts):
                score = shared.value.scores(features(text[starts[a] : starts[b]], starts[a : b + 1] - starts[a]))
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, pa.array(score)], names=[*batch.schema.names, "score"])

    return run


def score_quality(docs: DataFrame, model: Machine) -> DataFrame:
    """The rows of ``docs`` (with a text column) and a column score, 0 to 1, from the whole text alone.

    Null and empty texts are scored like a text without words. Rows are kept as they are, repeated ones too; a column
    named score is replaced. A model learned without labels, or from one class only, scores every row by the share of
    label 1 it has seen (0.5 without any). An empty table gives no row.
    """
    docs = docs.drop("score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_scored(shared), StructType([*docs.schema.fields, StructField("score", DoubleType())]))
