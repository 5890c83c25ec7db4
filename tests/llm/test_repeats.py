import hashlib

import numpy as np
import pyarrow as pa
import pytest

from spectrel.llm.columns import flat
from spectrel.llm.repeats import Strings, _answer_grams, _intervals, _names, _send_grams, cut_repeats, merge_transforms, suffix_order, symbol_steps, window_runs

from .helpers import prose


def cut(rows, width=50):
    """doc_id, n_bytes, n_removed, n_spans, sha of what is left."""
    least = {}
    for doc, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - width + 1):
            if doc is not None:
                least[data[i : i + width]] = min(doc, least.get(data[i : i + width], doc))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - width + 1):
            if doc is not None and least[data[i : i + width]] < doc:
                gone[i : i + width] = True
        left = bytes(b for b, g in zip(data, gone) if not g)
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out.append((doc, len(data), int(gone[:-1].sum()), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def rows_of(random):
    passage = prose(random, 60)
    rows = []
    for i in range(30):
        parts = [prose(random, 20), passage[i : i + 200], prose(random, 10), "é" * int(random.integers(80))]
        rows.append(((i * 11) % 97, " ".join(parts)))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, rows[3][1][:49]), (203, rows[3][1][:50]), (204, "a" * 400), (205, "ab" * 300), (206, "a" * 90)]
    rows += [(207, None), (208, ""), (209, rows[5][1]), (209, rows[5][1]), (None, rows[5][1]), (210, prose(random, 30_000)), (211, "x" + passage)]
    return rows


@pytest.mark.parametrize("shard_bytes, hot_runs", [(1 << 22, 1 << 16), (5000, 1 << 16), (5000, 1)])
def test_against_every_window(spark, shard_bytes, hot_runs):
    rows = rows_of(np.random.default_rng(1))
    docs = spark.createDataFrame([(d, t, 5, "s") for d, t in rows], "doc_id bigint, text string, shard int, hash string").repartition(3)
    got = cut_repeats(docs, shard_bytes=shard_bytes, hot_runs=hot_runs).cache()
    facts = got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted((tuple(r) for r in facts.collect()), key=str) == cut(rows)
    assert {r.shard for r in got.select("rest.shard").collect()} == {5}
    whole = {r.doc_id: r.kept_text for r in got.collect()}
    assert whole[204] == "a" * 400 and whole[206] == "" and whole[207] == ""


def test_other_widths(spark):
    rows = rows_of(np.random.default_rng(2))[:20]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = cut_repeats(docs, width=33, with_text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=str) == cut(rows, 33)


def test_a_gram_held_once_by_one_text_and_often_by_the_other(spark):
    random = np.random.default_rng(3)
    rows = []
    for k in range(282):
        shared, dash = prose(random, 20)[:34], chr(33 + k % 94)
        for length in (16, 20) if k % 2 else (20, 16):
            rows.append((len(rows), prose(random, 8) + shared + dash * length + prose(random, 8)))
    got = cut_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), with_text=False)
    facts = got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted((tuple(r) for r in facts.collect()), key=str) == cut(rows)


def test_hot_grams_are_known_by_all_their_runs():
    random = np.random.default_rng(5)
    texts = ["the template of this line is the same in all and is filled with " + prose(random, 5) for _ in range(800)]
    shards = [pa.table({"shard": [k] * 400, "doc_id": range(400 * k, 400 * k + 400), "text": texts[400 * k : 400 * k + 400]}) for k in range(2)]
    gram, times = np.unique(window_runs(*flat(pa.array(texts)), 50)[2], return_counts=True)
    sent = pa.concat_tables([_send_grams(50, 1)(shard) for shard in shards])
    assert times.max() > 400
    for hot_runs in (100, 300, int(times.max()) - 1, int(times.max())):
        named = {int(n) for cell in _answer_grams(hot_runs)(sent)["hot"].to_pylist() for n in np.frombuffer(cell, np.uint64)}
        assert named == set(_names(gram[times > hot_runs], 1).tolist())


def test_empty_table(spark):
    assert cut_repeats(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def strings(random, n=40):
    texts = [bytes(random.integers(97, 100, int(random.integers(51, 80)))) for _ in range(n)]
    texts += [texts[0][5:] + b"abc" * 4, texts[1][:51], texts[2] + b"z"]
    return np.array([len(t) for t in texts]), np.frombuffer(b"".join(texts), np.uint8), texts


def test_the_interleave_sorts_rows_by_their_prefix():
    size, data, texts = strings(np.random.default_rng(4))
    made = Strings(size, data)
    half = int(made.begin[len(texts) // 2])
    orders = [suffix_order(made, 0, half, 50), suffix_order(made, half, len(made.symbols), 50)]
    step, codes = symbol_steps(made)
    before = codes[made.behind(step)]
    source, block = merge_transforms([[before[o] for o in orders]] * (48 // step))
    place = np.empty(len(made.symbols), np.int64)
    for k, order in enumerate(orders):
        place[source == k] = order

    def prefix(p):
        out, at = [], p
        for _ in range(48 // step * step):
            out.append(int(made.symbols[at]))
            at = int(made.ahead(1)[at])
        return tuple(out)

    found = [prefix(int(p)) for p in place[:400]]
    assert found == sorted(found)
    assert [a == b for a, b in zip(block[:400], block[1:400])] == [a == b for a, b in zip(found, found[1:])]


def test_intervals_find_windows_of_smaller_owners():
    size, data, texts = strings(np.random.default_rng(6))
    owner = np.arange(len(texts))[::-1].copy()
    of, low, high = _intervals(size, data, owner, 50)
    got = {(int(s), i) for s, a, b in zip(of, low, high) for i in range(a, b)}
    least = {}
    for t, o in zip(texts, owner):
        for i in range(len(t) - 49):
            least[t[i : i + 50]] = min(o, least.get(t[i : i + 50], o))
    assert got == {(s, i) for s, t in enumerate(texts) for i in range(len(t) - 49) if least[t[i : i + 50]] < owner[s]}
