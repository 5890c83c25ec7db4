import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from spectrel.llm.near_duplicates import SYMBOLS, chunk_keys, chunk_starts, near_duplicates

from .helpers import prose, shingles


def classes(rows, percent, size=5):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    every = {g: k for k, g in enumerate({g for s in sets for g in s})}
    held = np.zeros((len(rows), len(every)), np.float32)
    for i, s in enumerate(sets):
        held[i, [every[g] for g in s]] = 1
    common, size = held @ held.T, np.array([len(s) for s in sets])
    for i, j in np.argwhere((common > 0) & (100 * common >= percent * (size[:, None] + size - common))).tolist():
        parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    out = []
    for i, (doc, _) in enumerate(rows):
        component = least.get(find(i)) if sets[i] else doc
        out.append((doc, len(sets[i]), component, doc == component))
    return sorted(out, key=str)


def run(spark, rows, percent=85):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id bigint, text string, node string, label int")
    return sorted((tuple(r) for r in near_duplicates(docs.repartition(3), percent).collect()), key=str)


def family(random):
    rows, n = [], 0
    for size in (4, 9, 30, 120, 700):
        base = prose(random, size).split()
        for edits in (0, 0, 1, 1, 2, 3, 5, 9):
            own = list(base)
            for _ in range(edits):
                own[random.integers(len(own))] = f"e{random.integers(5)}"
            rows.append((n * 7 % 1000, " ".join(own) if edits % 2 else "\t".join(own).upper()))
            n += 1
    return rows


def test_against_all_pairs(spark):
    random = np.random.default_rng(3)
    rows = family(random) + [(2000 + i, prose(random, 40)) for i in range(20)]
    rows += [(3000, None), (3001, ""), (3002, " \t\n"), (3003, "one"), (3004, "ONE"), (3005, "é è"), (3006, "word " * 30_000)]
    assert run(spark, rows) == classes(rows, 85)
    assert run(spark, rows, 80) == classes(rows, 80)


def test_repeated_rows_and_null_ids(spark):
    text = prose(np.random.default_rng(5), 50)
    rows = [(7, text), (7, text), (None, text), (9, text + " end"), (None, "alone here"), (11, "other"), (11, "words")]
    assert run(spark, rows) == classes(rows, 85)


def test_texts_without_id_link_their_neighbours(spark):
    base = prose(np.random.default_rng(7), 100).split()

    def edited(*places):
        return " ".join("e" if i in places else w for i, w in enumerate(base))

    rows = [(7, edited()), (None, edited(20)), (None, edited(20)), (9, edited(20, 70)), (None, "x " + edited(1, 50)), (None, edited(1, 50))]
    got = run(spark, rows)
    assert got == classes(rows, 85)
    assert (9, 96, 7, False) in got


def test_empty_table(spark):
    assert run(spark, []) == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([80, 85, 90]), st.data())
def test_every_pair_within_the_distance_shares_a_key(seed, percent, data):
    starts = chunk_starts(percent)
    random = np.random.default_rng(seed)
    one = random.integers(0, 1 << 16, SYMBOLS).astype(np.uint16)
    wrong = data.draw(st.lists(st.integers(0, SYMBOLS - 1), max_size=2 * len(starts) - 1, unique=True))
    two = one.copy()
    two[wrong] ^= 1
    keys = chunk_keys(np.stack([one, two]), starts)
    assert set(keys[0]) & set(keys[1])


def test_a_large_group_of_near_copies(spark):
    """2,000 copies with their own edits, most pairs just above or below the threshold."""
    random = np.random.default_rng(17)
    base = prose(random, 110).split()
    rows = []
    for i in range(2000):
        own = list(base)
        for place in random.choice(110, int(random.integers(1, 4)), replace=False):
            own[place] = f"e{random.integers(1000)}"
        rows.append((i, " ".join(own)))
    for percent in (80, 85):
        assert run(spark, rows, percent) == classes(rows, percent)
