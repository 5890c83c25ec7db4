import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spectrel.llm.columns import mix
from spectrel.llm.periodic_runs import WaveletMatrix, find_runs, runs_of
from spectrel.llm.queries import QUERIES

from .helpers import WORD, prose


def brute(words):
    """All runs by trying every period."""
    best = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q):
                best.setdefault((i, length), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in best.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def by_numpy(texts):
    ids = {}
    hashes = [mix(np.array([ids.setdefault(w, len(ids)) for w in t], np.uint64)) for t in texts]
    first = np.cumsum([0] + [len(t) for t in texts])
    doc, start, length, period = runs_of(np.concatenate(hashes) if texts else np.zeros(0, np.uint64), first)
    out = [[] for _ in texts]
    for d, *run in zip(doc.tolist(), start.tolist(), length.tolist(), period.tolist()):
        out[d].append(tuple(run))
    return [sorted(r, key=lambda r: (r[0], r[2])) for r in out]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60), max_size=4))
def test_two_letters(texts):
    assert by_numpy(texts) == [sorted(brute(t), key=lambda r: (r[0], r[2])) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=12), st.integers(1, 9), st.integers(0, 11)), max_size=6))
def test_powers(parts):
    text = [w for unit, times, more in parts for w in (unit * times + unit[: more % len(unit)])]
    assert by_numpy([text, text]) == [sorted(brute(text), key=lambda r: (r[0], r[2]))] * 2


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 70))
def test_range_successor(seed, n):
    random = np.random.default_rng(seed)
    values = random.permutation(n)
    low = random.integers(0, n, 20)
    high = np.minimum(n, low + random.integers(0, n + 1, 20))
    least = random.integers(0, n + 3, 20)
    expected = [min((v for v in values[a:b] if v >= x), default=-1) for a, b, x in zip(low, high, least)]
    assert WaveletMatrix(values).successor(low, high, least).tolist() == expected


def test_rows_of_every_kind(spark):
    random = np.random.default_rng(1)
    loop = "x y z " * 9 + "x"
    texts = [None, "", " \t\n", "one", "go " * 6, "go " * 5, "é è\n" * 4, prose(random, 50) + " " + loop + " " + prose(random, 30)]
    texts += ["word " * 60_000, " ".join(["a b"] * 3 + ["c"]) + " " + " ".join(["a b a b a b c"] * 5), prose(random, 30_000) + " tail" * 7]
    rows = [(i if i != 3 else None, t, "r", 1) for i, t in enumerate(texts)] + [(4, texts[4], "r", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs string, best int")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.best and tuple(r.best), r.collapsed) for r in find_runs(docs.repartition(3)).collect()), key=str)
    expected = []
    for doc, text, *_ in rows:
        words = WORD.findall(text or "")
        runs = [(0, 60_000, 1)] if len(words) == 60_000 else brute(words) if len(words) < 3000 else [(30_000, 7, 1)]
        runs.sort(key=lambda r: (r[0], r[2]))
        top = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        expected.append((doc, len(words), runs, top, collapsed(words, runs)))
    assert got == sorted(expected, key=str)
    assert find_runs(docs.where("false")).collect() == []


def planted(doc, words):
    h = zlib.crc32(str(doc).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_against_plain_python(spark, sf):
    docs = {r.doc_id: WORD.findall(r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, sf).collect()}
    assert set(got) == set(docs)
    some = 0
    for doc, words in docs.items():
        words = planted(doc, words)
        runs = sorted(brute(words), key=lambda r: (r[0], r[2]))
        some += len(runs)
        row = got[doc]
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row.n_runs == len(runs)
        assert row.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
        top = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        assert (row.start, row.length, row.period) == top
        assert row.exponent_milli == (1000 * top[1] // top[2] if runs else None)
    assert some > 10
