"""Digest, modifications and fragments by arrays: the same rows as one row at a time, and no expression for each residue."""

import math
from collections import Counter

import numpy as np
import pytest

from spectrel.functions.fixed_values import PROTON, WATER
from spectrel.functions.masses import residue_table
from spectrel.plans import digest as dg
from spectrel.plans import semi_digest as sd

MASS = residue_table()


def test_digest_keeps_places_of_odd_letters(spark):
    rows = [("a", "AAAAAAKÄGGGGGGGGRPMMMMMM"), ("b", None), ("c", ""), ("d", "GGGGGGGG|AAAAAAAAK|TTTTTTTT"), (None, "mmSSSSSSSSKWWWWWW"), ("e", "LLLLLLLLK")]
    proteins = spark.createDataFrame(rows, "accession string, sequence string").coalesce(1)
    got = sorted((str(r.accession), r.start, r.end, r.sequence, r.missed, r.prev, r.next) for r in dg.digest(proteins, missed=1).collect())
    assert got == [
        ("None", 1, 11, "mmSSSSSSSSK", 0, "-", "W"), ("None", 1, 17, "mmSSSSSSSSKWWWWWW", 1, "-", "-"), ("None", 12, 17, "WWWWWW", 0, "K", "-"),
        ("a", 1, 24, "AAAAAAKÄGGGGGGGGRPMMMMMM", 1, "-", "-"), ("a", 8, 24, "ÄGGGGGGGGRPMMMMMM", 0, "K", "-"),
        ("d", 1, 17, "GGGGGGGGAAAAAAAAK", 1, "-", "T"), ("d", 9, 17, "AAAAAAAAK", 0, "G", "T"), ("d", 9, 25, "AAAAAAAAKTTTTTTTT", 1, "G", "-"),
        ("d", 18, 25, "TTTTTTTT", 0, "K", "-"), ("e", 1, 9, "LLLLLLLLK", 0, "-", "-"),
    ]
    plan = dg.digest(proteins)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "MapInArrow" in plan


@pytest.mark.parametrize("most", [7, 200_000])
def test_digest_in_groups_of_proteins(spark, monkeypatch, most):
    random = np.random.default_rng(3)
    rows = [(f"p{i}", "".join(random.choice(list("AGSTLVDEFMKRP"), int(random.integers(0, 90))))) for i in range(40)]
    monkeypatch.setattr(dg, "RESIDUES_AT_ONCE", most)
    whole = Counter(tuple(r) for r in dg.digest(spark.createDataFrame(rows, "accession string, sequence string").coalesce(1)).collect())
    single = Counter(tuple(r) for row in rows for r in dg.digest(spark.createDataFrame([row], "accession string, sequence string")).collect()) if most == 7 else whole
    assert whole == single and sum(whole.values()) > 200


def test_a_long_protein_gives_each_sequence_once(spark):
    random = np.random.default_rng(5)
    unit = "".join(random.choice(list("AGSTLVDEFMK"), 9_000))
    proteins = spark.createDataFrame([("long", unit * 3)], "accession string, sequence string")
    got = [r.sequence for r in sd.semi_digest(proteins, places=False).collect()]
    every = {r.sequence for r in sd.semi_digest(proteins).select("sequence").collect()}
    assert len(got) == len(set(got)) and set(got) == every and len(got) > 20_000


def test_groups_of_windows_hold_all_copies(monkeypatch):
    random = np.random.default_rng(6)
    codes = np.frombuffer("".join(random.choice(list("AGK"), 400)).encode(), np.uint8)
    s = np.repeat(np.arange(300), 12)
    e = s + np.tile(np.arange(3, 15), 300)
    monkeypatch.setattr(sd, "ROWS_OUT", 500)
    groups = sd.distinct_groups(codes, s, e)
    texts = [{codes[a:b].tobytes() for a, b in zip(s[g], e[g])} for g in groups]
    assert len(groups) == 8 and sum(len(g) for g in groups) == len(s)
    assert sum(map(len, texts)) == len(set().union(*texts))


@pytest.mark.parametrize("width, offset", [(1.0005, 0.4), (0.02, 0.0), (0.00001, 0.0)])
def test_fragment_lists(width, offset):
    random = np.random.default_rng(9)
    peptides = ["".join(random.choice(list("AGGSTLVDEFmKX"), int(random.integers(1, 25)))) for _ in range(60)]
    total = [sum(MASS.get(c, 0) for c in p) + WATER + PROTON for p in peptides]
    text = np.frombuffer("".join(peptides).encode(), np.uint8)
    start, bins, charges = dg.fragment_lists(text, np.cumsum([len(p) for p in peptides]), np.array(total), 3, width, offset)
    for i, p in enumerate(peptides):
        expected = {}
        for z in (3, 2, 1):
            for k in range(1, len(p)):
                b = sum(MASS.get(c, 0) for c in p[:k])
                for single in (b + PROTON, total[i] - b):
                    expected[math.floor(((single + (z - 1) * PROTON) // z) / 1e6 / width + (1.0 - offset))] = z
        own = slice(start[i], start[i + 1])
        assert list(zip(bins[own].tolist(), charges[own].tolist())) == sorted(expected.items())


def test_modified_forms_of_many_peptides(spark):
    random = np.random.default_rng(2)
    rows = [("".join(random.choice(list("MMAG"), int(random.integers(4, 9)))), 700_000_000 + i, f"p{i}") for i in range(300)]
    rows += [("MÄM", 700_000_000, "odd"), (None, 700_000_000, "none"), ("MMMM", None, "no mass")]
    got = Counter(tuple(r) for r in dg.variable_mods(spark.createDataFrame(rows, "sequence string, mass_uda bigint, accession string")).collect())
    expected = Counter()
    for sequence, mass, accession in rows:
        if mass is None:
            continue
        forms = {(sequence, 0)}
        for _ in range(3):
            forms |= {(t[:i] + "m" + t[i + 1 :], n + 1) for t, n in forms if t and n < 3 for i, c in enumerate(t) if c == "M"}
        expected.update((t, mass + n * 15_994_900, n, accession) for t, n in forms)
    assert got == expected
