import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from spectrel.llm.columns import mix
from spectrel.llm.linking import links_within
from spectrel.llm.parity_join import band_ends, parity_join, parity_keys

from .helpers import prose
from .test_near_duplicates import classes, family


def as_set(numbers):
    return np.sort(mix(np.array(sorted(numbers), np.uint64)))


def linked(x, y, percent):
    common = len(np.intersect1d(x, y))
    return 100 * common >= percent * (len(x) + len(y) - common)


def test_linked_sizes_are_in_neighbouring_bands():
    for percent in (50, 80, 85, 97, 100):
        ends = band_ends(percent, 5000)
        sizes = np.arange(1, 4000)
        partner = np.minimum(100 * sizes // percent, 5000)
        step = np.searchsorted(ends, partner) - np.searchsorted(ends, sizes)
        assert ((step == 0) | (step == 1)).all()


@settings(max_examples=400, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([60, 80, 85, 95]), st.integers(1, 90), st.integers(0, 30), st.integers(0, 30))
def test_every_linked_pair_shares_a_key(seed, percent, common, more, others):
    random = np.random.default_rng(seed)
    base = random.choice(10**6, common + more + others, replace=False)
    one, two = as_set(base[: common + more]), as_set(np.concatenate([base[:common], base[common + more :]]))
    key, owner = parity_keys([one, as_set([5]), two], percent)
    assert len(key) < 3 * (len(one) + len(two)) + 20
    if linked(one, two, percent) and len(np.union1d(one, two)) > common:
        assert set(key[owner == 0].tolist()) & set(key[owner == 2].tolist())


def components_of(n, pairs):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in pairs:
        parent[find(i)] = find(j)
    return [min(k for k in range(n) if find(k) == find(i)) for i in range(n)]


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([60, 80, 85]), st.integers(1, 40), st.integers(1, 3), st.integers(1, 12))
def test_links_within_a_cell(seed, percent, n, bases, edits):
    random = np.random.default_rng(seed)
    sets = []
    for i in range(n):
        own = set(range(1000 * int(random.integers(bases)), 0) or range(1000 * (k := int(random.integers(bases))), 1000 * k + 40 + 10 * k))
        for _ in range(int(random.integers(edits + 1))):
            own.discard(random.choice(sorted(own)))
            own.add(int(10**6 + random.integers(300)))
        sets.append(as_set(own))
    roots = random.integers(0, n, n) if random.random() < 0.3 else np.arange(n)
    same = [(i, j) for i in range(n) for j in range(i) if roots[i] == roots[j]]
    found = links_within(sets, roots, percent)
    assert len(found) < n and all(linked(sets[i], sets[j], percent) for i, j in found)
    every = [(i, j) for i in range(n) for j in range(i) if linked(sets[i], sets[j], percent)]
    assert components_of(n, same + found) == components_of(n, same + every)


def run(spark, rows, percent=85, size=4):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id bigint, text string, node string, label int")
    return sorted((tuple(r) for r in parity_join(docs.repartition(3), percent, size).collect()), key=str)


def expected(rows, percent=85, size=4):
    return sorted((r[:3] for r in classes(rows, percent, size)), key=str)


def test_against_all_pairs(spark):
    rows = family(np.random.default_rng(11)) + [(2000 + i, prose(np.random.default_rng(i), 40)) for i in range(20)]
    rows += [(3000, None), (3001, ""), (3002, " \t\n"), (3003, "one"), (3004, "ONE"), (3005, "é è"), (3006, "word " * 30_000)]
    base = prose(np.random.default_rng(12), 20).split()
    rows += [(4000 + i, " ".join(base[: 20 - i])) for i in range(20)]
    rows += [(7, rows[4][1]), (7, "other"), (None, rows[9][1] + " end"), (None, "alone here")]
    assert run(spark, rows) == expected(rows)
    assert run(spark, rows, 70, 3) == expected(rows, 70, 3)
    assert run(spark, []) == []


def test_a_large_group_of_near_copies(spark):
    random = np.random.default_rng(13)
    base = prose(random, 100).split()
    rows = []
    for i in range(700):
        own = list(base)
        for place in random.choice(100, int(random.integers(1, 5)), replace=False):
            own[place] = f"e{random.integers(400)}"
        rows.append((i, " ".join(own)))
    assert run(spark, rows) == expected(rows)
