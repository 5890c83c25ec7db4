"""Language of words and documents by a linear-chain conditional random field.

A word is a run of letters. Its features are hashed n-grams of its letters with the word's edges (those at an edge are
affixes), the word itself, and its place in lexicons of words that are typical of a language; the model learns a weight
for each feature and language, and for each transition from one word's language to the next one's. Training sequences
splice pieces of documents of different languages, so transitions are learned from code-switched text. Forward-backward
gives each word a probability for each language; a document has the language with the highest mean.

Forward-backward runs in blocks: for every block of ``BLOCK`` words the products of its matrices are formed, all blocks
at once; the blocks of a document are then chained. A text of any length is read whole in a bounded number of steps.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .columns import mix

BUCKETS = 1 << 17
SIZES = (1, 2, 3, 4)  # letters of an n-gram, an edge of the word counted as one
SAMPLE = 300  # documents of each language that are learned from
PIECE = 16  # words of a piece that is spliced into training sequences
LEXICON = 400  # words of a language
LENGTH = 64  # words of a training sequence
SEQUENCES = 2048
EPOCHS = 4
BLOCK = 128
SLICE_CHARS = 1 << 20
UNKNOWN = "und"
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


@functools.cache
def letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@dataclass
class Words:
    """The words of some texts: letters of each distinct word between zeros, and the sequence of words by text."""

    codes: np.ndarray  # of the distinct words, one after another, each between two zeros
    begin: np.ndarray  # where each distinct word's cells begin
    hashes: np.ndarray
    index: np.ndarray  # distinct word of each word
    first: np.ndarray  # first word of each text, one more than texts


def words_of(texts: list[str | None]) -> Words:
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    is_letter = letters()[np.minimum(codes, 0x10FFFF)]
    change = np.diff(np.concatenate([[False], is_letter, [False]]).astype(np.int8))
    begin, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    if not len(begin):
        return Words(np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64))
    value = mix(codes.astype(np.uint64) + _U(1)) * is_letter
    size = end - begin
    opened = np.zeros(len(codes), np.int64)
    opened[begin] = begin
    inside = np.arange(len(codes)) - np.maximum.accumulate(opened)
    hashes = mix(np.add.reduceat(value * (mix(inside.astype(np.uint64)) | _U(1)), begin) + size.astype(np.uint64))
    distinct, where, index = np.unique(hashes, return_index=True, return_inverse=True)
    b, n = begin[where], size[where]
    cell_begin = np.cumsum(n + 2) - (n + 2)
    cells = np.zeros(int((n + 2).sum()), np.uint32)
    spot = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    cells[np.repeat(cell_begin + 1, n) + spot] = codes[np.repeat(b, n) + spot]
    return Words(cells, cell_begin, distinct, index, np.concatenate([[0], np.searchsorted(begin, ends)]))


def word_features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) for each hashed feature of the distinct words, by word."""
    codes, begin = words.codes.astype(np.uint64), words.begin
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    end = np.append(begin[1:], len(codes))
    word = np.repeat(np.arange(len(begin)), end - begin)
    rest = end[word] - np.arange(len(codes))
    owners, buckets = [np.arange(len(begin))], [(words.hashes >> _U(7)) & _U(BUCKETS - 1)]
    value = np.zeros(len(codes), np.uint64)
    for n in range(1, max(SIZES) + 1):
        value = value[: len(codes) - n + 1] * _BASE + codes[n - 1 :]
        if n in SIZES:
            fits = rest[: len(value)] >= n
            if n == 1:
                fits = fits & (codes > 0)
            owners.append(word[: len(value)][fits])
            buckets.append(mix(value[fits] + _U(n)) & _U(BUCKETS - 1))
    owner, bucket = np.concatenate(owners), np.concatenate(buckets).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return owner[order], bucket[order]


@dataclass
class Field:
    """A trained model. Labels are in a fixed order; ``lexicon`` holds sorted word hashes, ``typical`` their languages."""

    labels: list[str]
    weights: np.ndarray  # buckets x labels
    lexicon: np.ndarray
    typical: np.ndarray  # words of the lexicon x labels
    lexical: np.ndarray  # labels x labels: a typical word of one language as evidence for another
    start: np.ndarray
    moves: np.ndarray

    def typical_of(self, words: Words) -> np.ndarray:
        if not len(self.lexicon):
            return np.zeros((len(words.hashes), len(self.labels)), np.float32)
        spot = np.minimum(np.searchsorted(self.lexicon, words.hashes), len(self.lexicon) - 1)
        return self.typical[spot] * (self.lexicon[spot] == words.hashes)[:, None]

    def evidence(self, words: Words, features: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Score of each label for each distinct word."""
        owner, bucket = features
        if not len(owner):
            return np.zeros((0, len(self.labels)))
        edge = np.searchsorted(owner, np.arange(len(words.hashes)))
        return np.add.reduceat(self.weights[bucket], edge, axis=0).astype(float) + self.typical_of(words) @ self.lexical


def _potentials(evidence: np.ndarray) -> np.ndarray:
    return np.exp(evidence - evidence.max(axis=1, keepdims=True))


def marginals(psi: np.ndarray, first: np.ndarray, start: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Forward-backward: probability of each label for each word, texts being the runs given by ``first``."""
    n, k = psi.shape
    move, open_ = np.exp(moves - moves.max()), np.exp(start - start.max())
    size = np.diff(first)
    count = -(-size // BLOCK)
    text = np.repeat(np.arange(len(size)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    low = first[:-1][text] + number * BLOCK
    length = np.minimum(first[1:][text] - low, BLOCK)
    order = np.argsort(-length, kind="stable")
    low, length, text, number = low[order], length[order], text[order], number[order]
    steps = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(steps), side="left")  # blocks longer than t

    ahead = np.empty((n, k, k))
    for t in range(steps):
        a = active[t]
        p = psi[low[:a] + t]
        now = np.eye(k)[None] * p[:, None, :] if t == 0 else (ahead[low[:a] + t - 1] @ move) * p[:, None, :]
        ahead[low[:a] + t] = now / now.max(axis=(1, 2), keepdims=True)
    back = np.empty((n, k, k))
    for t in range(steps - 1, -1, -1):
        a, longer = active[t], active[t + 1] if t + 1 < steps else 0
        now = np.broadcast_to(np.eye(k), (a, k, k)).copy()
        if longer:
            now[:longer] = move @ (psi[low[:longer] + t + 1][:, :, None] * back[low[:longer] + t + 1])
        back[low[:a] + t] = now / now.max(axis=(1, 2), keepdims=True)

    into, out = np.empty((len(low), k)), np.empty((len(low), k))
    by_number = np.argsort(number, kind="stable")
    edges = np.searchsorted(number[by_number], np.arange(number.max(initial=-1) + 2))
    state, groups = np.tile(open_, (len(size), 1)), []
    for a, b in zip(edges[:-1], edges[1:]):
        own = by_number[a:b]
        groups.append(own)
        into[own] = state[text[own]]
        last = np.einsum("bi,bij->bj", into[own], ahead[low[own] + length[own] - 1])
        state[text[own]] = last / last.sum(axis=1, keepdims=True) @ move
    state = np.ones((len(size), k))
    for own in reversed(groups):
        out[own] = state[text[own]]
        begin = psi[low[own]] * np.einsum("bij,bj->bi", back[low[own]], out[own])
        passed = begin @ move.T
        state[text[own]] = passed / passed.max(axis=1, keepdims=True)

    spot = np.repeat(np.arange(len(low)), length)
    place = np.repeat(low, length) + np.arange(len(spot)) - np.repeat(np.cumsum(length) - length, length)
    both = np.einsum("bi,bij->bj", into[spot], ahead[place]) * np.einsum("bij,bj->bi", back[place], out[spot])
    result = np.empty((n, k))
    result[place] = both / both.sum(axis=1, keepdims=True)
    return result


# ---- training ------------------------------------------------------------------


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each text in pieces."""
    for batch in batches:
        rows = []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
            rows += [(lang, " ".join(words[i : i + PIECE])) for i in range(0, len(words), PIECE)]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in (0, 1)], names=["lang", "piece"])


def fit_languages(docs: DataFrame, usable: Column | None = None, sample: int = SAMPLE) -> Field:
    """A field for the languages of ``docs`` (doc_id, text, lang), from at most ``sample`` documents of each language.

    Documents are chosen by a hash of their id, ``usable`` may narrow them; the whole text of each is learned from. Null
    languages and texts are left out.
    """
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    if usable is not None:
        rows = rows.where(usable)
    # rows are thinned out by a hash before they are ranked, so no task gets many rows of a language;
    # the counts have a row for each label of the model
    counts = F.broadcast(rows.groupBy("lang").agg(F.count("*").alias("n")))
    share = F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(1 << 31)) / F.lit(float(1 << 31))
    thinned = rows.select("doc_id", "lang", "text").join(counts, "lang").withColumn("share", share).where(F.col("share") * F.col("n") < 4 * sample)
    thinned = thinned.dropDuplicates(["lang", "doc_id", "share"])
    order = Window.partitionBy("lang").orderBy("share", "doc_id")
    few = thinned.withColumn("number", F.row_number().over(order)).where(F.col("number") <= sample)
    table = few.select("lang", "text").mapInArrow(_pieces, "lang string, piece string").where("piece <> ''").toArrow()
    pairs = sorted(zip(table["lang"].to_pylist(), table["piece"].to_pylist()))
    return train_field(pairs)


def train_field(pairs: list[tuple[str, str]]) -> Field:
    """Train on (language, piece) pairs: pieces are spliced into sequences, and the likelihood climbed with AdaGrad."""
    random = np.random.default_rng(11)
    labels = sorted({lang for lang, _ in pairs})
    k = len(labels)
    field = Field(labels, np.zeros((BUCKETS, k), np.float32), np.zeros(0, np.uint64), np.zeros((0, k), np.float32), np.eye(k) * 0.5, np.zeros(k), np.zeros((k, k)))
    if k < 2:
        return field
    words = words_of([piece for _, piece in pairs])
    owner, bucket = word_features(words)
    edge = np.append(np.searchsorted(owner, np.arange(len(words.hashes))), len(owner))
    label_of = np.array([labels.index(lang) for lang, _ in pairs])

    counts = np.zeros((len(words.hashes), k))
    np.add.at(counts, (words.index, np.repeat(label_of, np.diff(words.first))), 1)
    share = counts / counts.sum(axis=1, keepdims=True)
    common = [np.flatnonzero(share[:, j] > 0.8)[np.argsort(-counts[share[:, j] > 0.8, j], kind="stable")][:LEXICON] for j in range(k)]
    chosen = np.unique(np.concatenate(common))
    field.lexicon, field.typical = words.hashes[chosen], (share[chosen] > 0.8).astype(np.float32)
    typical = field.typical_of(words)

    by_label = [np.flatnonzero(label_of == j) for j in range(k)]
    sequences = np.empty((SEQUENCES, LENGTH), np.int64)
    truth = np.empty((SEQUENCES, LENGTH), np.int64)
    for row in range(SEQUENCES):
        filled, j = 0, int(random.integers(k))
        while filled < LENGTH:
            if random.random() < 0.25:
                j = int(random.integers(k))
            piece = int(random.choice(by_label[j]))
            own = words.index[words.first[piece] : words.first[piece + 1]][: LENGTH - filled]
            sequences[row, filled : filled + len(own)] = own
            truth[row, filled : filled + len(own)] = j
            filled += len(own)

    seen = [np.full(a.shape, 1e-6) for a in (field.weights, field.lexical, field.start, field.moves)]

    def climb(array, total, gradient, where=slice(None), rate=0.2):
        total[where] += gradient * gradient
        array[where] += rate * gradient / np.sqrt(total[where])

    for _ in range(EPOCHS):
        for batch in np.array_split(random.permutation(SEQUENCES), SEQUENCES // 32):
            used, index = np.unique(sequences[batch], return_inverse=True)
            index = index.reshape(len(batch), LENGTH)
            cells = np.concatenate([np.arange(edge[w], edge[w + 1]) for w in used])
            size = edge[used + 1] - edge[used]
            evidence = np.add.reduceat(field.weights[bucket[cells]], np.cumsum(size) - size, axis=0).astype(float) + typical[used] @ field.lexical
            psi = _potentials(evidence)[index]  # sequence x word x label
            move, open_ = np.exp(field.moves), np.exp(field.start)
            alpha, beta = np.empty_like(psi), np.ones_like(psi)
            for t in range(LENGTH):
                a = psi[:, t] * (open_ if t == 0 else alpha[:, t - 1] @ move)
                alpha[:, t] = a / a.sum(axis=1, keepdims=True)
            for t in range(LENGTH - 2, -1, -1):
                b = (psi[:, t + 1] * beta[:, t + 1]) @ move.T
                beta[:, t] = b / b.sum(axis=1, keepdims=True)
            gamma = alpha * beta
            gamma /= gamma.sum(axis=2, keepdims=True)
            pair = alpha[:, :-1, :, None] * move * (psi[:, 1:] * beta[:, 1:])[:, :, None, :]
            pair /= pair.sum(axis=(2, 3), keepdims=True)
            real = np.eye(k)[truth[batch]]
            step = real - gamma
            climb(field.start, seen[2], step[:, 0].mean(axis=0), rate=0.05)
            climb(field.moves, seen[3], (np.einsum("bti,btj->ij", real[:, :-1], real[:, 1:]) - pair.sum(axis=(0, 1))) / pair[..., 0, 0].size, rate=0.05)
            by_word = np.zeros((len(used), k))
            np.add.at(by_word, index.ravel(), step.reshape(-1, k) / len(batch))
            climb(field.lexical, seen[1], typical[used].T @ by_word, rate=0.05)
            owners = np.repeat(np.arange(len(used)), size)
            spots, place = np.unique(bucket[cells], return_inverse=True)
            gradient = np.stack([np.bincount(place, by_word[owners, j], len(spots)) for j in range(k)], axis=1) - 1e-5 * field.weights[spots]
            climb(field.weights, seen[0], gradient, spots)
    return field


# ---- labelling -----------------------------------------------------------------


def label_texts(field: Field, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each label for each word, and the first word of each text (one more than texts)."""
    words = words_of(texts)
    if not len(words.index) or not field.labels:
        return np.zeros((len(words.index), len(field.labels))), words.first
    psi = _potentials(field.evidence(words, word_features(words)))[words.index]
    return marginals(psi, words.first, field.start, field.moves), words.first


def _runs(texts: pa.Array, k: int) -> Iterator[tuple[int, int]]:
    """Runs of rows whose text and block matrices together stay small; a longer text is a run of its own."""
    size = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in texts], np.int64)
    most = max(1 << 14, SLICE_CHARS * 16 // max(16, k * k))
    a, total = 0, 0
    for b, own in enumerate(size):
        if b > a and total + own > most:
            yield a, b
            a, total = b, 0
        total += own
    if len(size):
        yield a, len(size)


def _predicted(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            text = batch.column("text")
            for a, b in _runs(text, len(field.labels)):
                chance, first = label_texts(field, text.slice(a, b - a).to_pylist())
                n = np.diff(first)
                total = np.concatenate([np.zeros((1, chance.shape[1])), np.cumsum(chance, axis=0)])
                mean = (total[first[1:]] - total[first[:-1]]) / np.maximum(n, 1)[:, None]
                if field.labels:
                    best = mean.argmax(axis=1)
                    name = [field.labels[j] if m else UNKNOWN for j, m in zip(best, n)]
                    score = np.where(n > 0, np.clip(mean[np.arange(len(n)), best], 0, 1), 0.0)
                else:
                    name, score = [UNKNOWN] * (b - a), np.zeros(b - a)
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, pa.array(name, pa.string()), pa.array(score)], names=[*batch.schema.names, "lang_pred", "score"])

    return run


def predict_languages(docs: DataFrame, field: Field) -> DataFrame:
    """The rows of ``docs`` (with a text column) with lang_pred and score, the mean probability of that language.

    A null text, or one without any letter, is ``und`` with score 0, as is every text where no language was learned. Rows
    are judged alone, so repeated rows, other columns and an empty table are kept as they are; own columns named lang_pred
    or score are replaced. Ties go to the language that sorts first.
    """
    docs = docs.drop("lang_pred", "score")
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.mapInArrow(_predicted(docs.sparkSession.sparkContext.broadcast(field)), schema)


def _labelled(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            text = batch.column("text")
            for a, b in _runs(text, len(field.labels)):
                chance, first = label_texts(field, text.slice(a, b - a).to_pylist())
                if not len(chance) or not field.labels:
                    continue
                best, owner = chance.argmax(axis=1), np.repeat(np.arange(b - a), np.diff(first))
                new = np.ones(len(best), bool)
                new[1:] = (best[1:] != best[:-1]) | (owner[1:] != owner[:-1])
                opens = np.flatnonzero(new)
                closes = np.append(opens[1:], len(best))
                mean = np.add.reduceat(chance[np.arange(len(best)), best], opens) / (closes - opens)
                row = owner[opens]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a).take(pa.array(row)), pa.array(opens - first[row]), pa.array(closes - first[row]),
                        pa.array([field.labels[j] for j in best[opens]], pa.string()), pa.array(mean),
                    ],
                    names=["doc_id", "word_from", "word_to", "lang", "score"],
                )

    return run


def label_words(docs: DataFrame, field: Field) -> DataFrame:
    """Runs of neighbouring words of one language in each text: (doc_id, word_from, word_to, lang, score), words from 0.

    A text without letters gives no row; repeated rows give theirs each.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_labelled(docs.sparkSession.sparkContext.broadcast(field)), "doc_id bigint, word_from bigint, word_to bigint, lang string, score double")
