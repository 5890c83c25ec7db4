import hashlib
import itertools
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from spectrel.llm.conversations import answer, combined, parsed, repair_conversations, repaired_turns
from spectrel.llm.queries import QUERIES

BLANKS = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit, turns) by Dijkstra-like search over (row, state), one edit at a time; rows are (role, text, fault)."""
    nexts = {("B", "s"): "Y", ("B", "u"): "U", ("Y", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}
    best = {(0, "B"): (0, "", ())}
    todo = {(0, "B")}
    while todo:  # relax until nothing changes: insertions stay on a row
        i, state = todo.pop()
        cost, audit, turns = best[i, state]
        options = []
        for c in "ua":
            if (state, c) in nexts:
                role = {"u": "user", "a": "assistant"}[c]
                options.append((i, nexts[state, c], cost + 2, audit + "I", turns + ((role, ""),)))
                if i < len(rows) and rows[i][2] not in ("blank", "duplicate"):
                    more = rows[i][2] == "truncated"
                    options.append((i + 1, nexts[state, c], cost + 2 + more, audit + "R", turns + ((role, rows[i][1]),)))
        if i < len(rows):
            role, text, fault = rows[i]
            options.append((i + 1, state, cost + 3, audit + "D", turns))
            if fault not in ("blank", "duplicate") and (state, role[:1]) in nexts:
                options.append((i + 1, nexts[state, role[:1]], cost + (fault == "truncated"), audit + "K", turns + ((role, text),)))
        for j, to, *found in options:
            if (j, to) not in best or tuple(found) < best[j, to]:
                best[j, to] = tuple(found)
                todo.add((j, to))
    return min(best[len(rows), s] for s in "BA" if (len(rows), s) in best)


def brute(rows):
    """The row of the answer for one conversation; rows are (turn, role, text) in order."""
    seen, judged = set(), []
    for _, role, text in rows:
        inside = text.strip(BLANKS)
        fault = "blank" if not inside else "duplicate" if (role, text) in seen else "" if inside[-1] in ".!?" else "truncated"
        seen.add((role, text))
        judged.append((role, text, fault))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
    cost, audit, out = cheapest(judged)
    faults = [f for _, _, f in judged]
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, digest), list(out)


FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
KINDS = "conv_id bigint, turn bigint, role string, text string, mark int, cost int"


def by_spark(spark, rows, parts=3):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], KINDS).repartition(parts)
    return {r.conv_id: tuple(r[f] for f in FIELDS) for r in repair_conversations(docs).collect()}


@settings(max_examples=300, deadline=None)
@given(st.text("xsua-SUA_", min_size=1, max_size=14))
def test_parse(symbols):
    rows = []
    for c in symbols:
        role = {"s": "system", "u": "user", "a": "assistant"}.get(c.lower(), "tool")
        rows.append((role, c, "blank" if c == "x" else "truncated" if c.isupper() or c == "_" else ""))
    assert answer(parsed(symbols)) == cheapest(rows)[:2]
    assert parsed(symbols) == combined([parsed(c) for c in symbols])


def test_every_short_conversation():
    for n in (1, 2, 3):
        for symbols in itertools.product("xsua_U", repeat=n):
            rows = [({"s": "system", "u": "user", "a": "assistant"}.get(c.lower(), "tool"), c, "blank" if c == "x" else "truncated" if c in "_U" else "") for c in symbols]
            assert answer(parsed("".join(symbols))) == cheapest(rows)[:2]


def conversation(random, conv, n, start=0):
    roles = ["system", "user", "assistant", "assistant", "user", "tool", ""]
    texts = ["Hello.", "ok", "", " \t", "Fine!", "why?", "no end"]
    return [
        (conv, start + i + int(random.integers(0, 2)) * 0 if random.random() > 0.1 else start + i + 1000, roles[random.integers(7)], texts[random.integers(7)] + str(i if random.random() < 0.7 else "") + "." * int(random.integers(0, 2)))
        for i in range(n)
    ]


def by_turn(rows):
    return sorted(((t, r, x) for _, t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def test_conversations_of_many_sizes(spark):
    random = np.random.default_rng(4)
    rows = []
    for conv, n in enumerate([1, 2, 3, 5, 8, 9, 20, 63, 64, 65, 130, 700]):
        rows += [(c, t * 3 + i % 3 if n > 60 else t, r, x) for i, (c, t, r, x) in enumerate(conversation(random, conv * 7, n))]
    rows = list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())  # one row a turn, so that the order is fixed
    got = by_spark(spark, rows)
    for conv in {r[0] for r in rows}:
        expected, turns = brute(by_turn([r for r in rows if r[0] == conv]))
        assert got[conv] == expected, conv
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], KINDS)
    out = sorted((r.conv_id, r.place, r.role, r.text) for r in repaired_turns(docs).collect())
    assert out == sorted((c, i, *t) for c in {r[0] for r in rows} for i, t in enumerate(brute(by_turn([r for r in rows if r[0] == c]))[1]))


def test_nulls_copies_and_long_texts(spark):
    rows = [
        (1, None, None, None), (1, None, "user", "Hi."), (1, 4, "assistant", None), (1, 9, "assistant", "x" * 3_000_000 + ". "),
        (None, 1, "user", "a."), (None, 2, "assistant", "b."), (None, 2, "assistant", "b."), (None, 5, "user", "open"),
        (3, 1, "system", "s."), (4, 1, "user", ""), (5, 7, "user", "é?\x0b "), (5, 7, "user", "é?\x0b "), (6, None, "assistant", "ok."),
    ]
    rows += [(None, 10 + i, "user" if i % 2 else "assistant", f"t{i}.") for i in range(200)]
    rows += [(8, 1, "user", "same.")] * 300 + [(8, 2, "assistant", "end.")]
    got = by_spark(spark, rows)
    for conv in {r[0] for r in rows}:
        own = by_turn([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv])
        assert got[conv] == brute(own)[0], conv
    assert got[8][2] == 299 and got[None][0] == 6
    assert by_spark(spark, []) == {}


def test_query_against_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    hurt = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        hurt += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    got = {r.conv_id: tuple(r[f] for f in FIELDS) for r in QUERIES["op12_repaired_conversations"](spark, sf).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        assert got[conv] == brute(by_turn([r for r in hurt if r[0] == conv]))[0]
