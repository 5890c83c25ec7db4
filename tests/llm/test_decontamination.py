import numpy as np

from spectrel.llm.decontamination import contaminations, shingles_of

from .helpers import prose, shingles, words


def held(docs, items, percent=80):
    out = set()
    for item, text in items:
        own = shingles(text)
        if not own:
            continue
        size = min(5, len(words(text)))
        for doc, other in docs:
            there = words(other)
            found = len(own & {tuple(there[i : i + size]) for i in range(len(there) - size + 1)})
            if 100 * found >= percent * len(own):
                out.add((doc, item, len(own), found))
    return sorted(out, key=str)


def test_against_all_pairs(spark):
    random = np.random.default_rng(8)
    items = [(i, prose(random, n)) for i, n in enumerate([1, 3, 4, 5, 6, 9, 14, 40, 41, 300, 300])]
    items += [(20, None), (21, ""), (22, items[5][1]), (None, items[6][1]), (6, items[6][1])]
    docs = [(100 + i, prose(random, 300)) for i in range(5)]
    for k, (_, text) in enumerate(items[:11]):
        parts = text.split()
        for edits in (0, 1, 2, 8):
            own = list(parts)
            for _ in range(edits):
                own[random.integers(len(own))] = "edited"
            docs.append((1000 + 10 * k + edits, prose(random, 50) + "\n" + " ".join(own).upper() + " " + prose(random, 5)))
    docs += [(2000, prose(random, 40_000) + " " + items[7][1]), (2001, None), (2002, ""), (None, items[8][1]), (2003, items[4][1]), (2003, items[4][1])]
    docs += [(2004, items[9][1]), (2004, items[10][1])]
    frame = spark.createDataFrame([(d, t, 1, "k") for d, t in docs], "doc_id bigint, text string, item bigint, key string").repartition(3)
    found = contaminations(frame, spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted((tuple(r) for r in found.collect()), key=str) == held(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")
    assert contaminations(docs, items).count() == 1
    assert contaminations(docs.where("false"), items).count() == 0
    assert contaminations(docs, items.where("false")).count() == 0


def test_shingles_agree_with_the_plain_form():
    for text in ("A b\tC\x0bd e f", "x y", "", None, "É é z"):
        assert {tuple(w.decode() for w in s) for s in shingles_of(text, 5)[1]} == shingles(text)
