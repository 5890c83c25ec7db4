"""Repair of conversations by weighted interval parsing (CYK).

Rows of a conversation are edited so that the initials of their roles read ``(s?(ua)+)?``. The states of that expression
are B (start), Y (after s), U (after u) and A (after a); the nonterminal (p, q) derives the rows of a span that lead from
state p to state q. In Chomsky normal form the grammar has the rules (p, q) -> (p, r) (r, q) for a span that is split in
two and (p, q) -> one edited row. A cell keeps the least (cost, audit) of each nonterminal of a span, where the audit is
the initials of the edits in order; the insertion closure adds, on both sides of a row, the turns that can be inserted.
Audits of equal cost are never one the beginning of the other (they would edit the same rows and differ by insertions,
which cost), so the least audit of a span is made of least audits of its parts.

Spans of up to ``LEAF`` rows are parsed bottom-up by span length, and longer ones from the cells of neighbouring spans,
always twice as long. Rows are sorted by range and cut into blocks of bounded size; a conversation within one block, that
is nearly every one, is repaired where it is. The blocks of longer conversations are parsed apart, their cells are
combined ``FAN`` at a time, and the audit goes back to the blocks in pieces, so no task holds the rows of a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spectrel.operators.batching import index_within
from spectrel.operators.shared import written

from .hashfilter import split_by_keys

LEAF = 8  # rows of a span that is parsed by all its splits
FAN = 64  # cells that are combined in one step
BLOCK_ROWS = 64
BLOCK_CHARS = 4 << 20  # a block is closed when its texts reach this; a longer text is a block of its own
BLANKS = " \t\n\x0b\x0c\r"
# Costs of the edits; keeping a row is free.
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
# The expression (s?(ua)+)? as moves between states: (from, initial, to); B and A end it.
MOVES = [("B", "s", "Y"), ("B", "u", "U"), ("Y", "u", "U"), ("U", "a", "A"), ("A", "u", "U")]
STATES = "BYUA"
LEGAL = {"su", "ua", "au"}

Cell = dict[str, tuple[int, str]]  # nonterminal, as the two states -> (cost, audit)


def product(one: Cell, two: Cell) -> Cell:
    """The cell of two neighbouring spans: (p, q) -> (p, r) (r, q)."""
    out: Cell = {}
    for pr, (cost_1, audit_1) in one.items():
        for rq, (cost_2, audit_2) in two.items():
            if pr[1] == rq[0]:
                found, key = (cost_1 + cost_2, audit_1 + audit_2), pr[0] + rq[1]
                if key not in out or found < out[key]:
                    out[key] = found
    return out


def _least(cells: Iterable[Cell]) -> Cell:
    out: Cell = {}
    for cell in cells:
        for key, found in cell.items():
            if key not in out or found < out[key]:
                out[key] = found
    return out


_NOTHING: Cell = {p + p: (0, "") for p in STATES}
_ONE_MORE = _least([_NOTHING, {p + q: (INSERT, "I") for p, initial, q in MOVES if initial in "ua"}])
#: Turns inserted at one place: more than two never pay, as u and a in turn lead back to the same state.
INSERTED = product(_ONE_MORE, _ONE_MORE)


def edited(symbol: str) -> Cell:
    """The cell of one row: s, u, a or - for its initial, the capital (or _) if it is truncated, x if it has to go."""
    cells: list[Cell] = [{p + p: (DELETE, "D") for p in STATES}]
    if symbol != "x":
        more = TRUNCATED if symbol.isupper() or symbol == "_" else 0
        cells.append({p + q: (more, "K") for p, initial, q in MOVES if initial == symbol.lower()})
        cells.append({p + q: (REROLE + more, "R") for p, initial, q in MOVES if initial in "ua"})
    return product(product(INSERTED, _least(cells)), INSERTED)


@lru_cache(1 << 16)
def leaf(symbols: str) -> Cell:
    """All spans of a few rows, from single rows to the whole, each as the least over its splits."""
    n = len(symbols)
    spans = {(i, i + 1): edited(c) for i, c in enumerate(symbols)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            spans[i, i + length] = _least(product(spans[i, k], spans[k, i + length]) for k in range(i + 1, i + length))
    return spans[0, n]


def combined(cells: list[Cell]) -> Cell:
    """The cell of neighbouring spans in order, combined in pairs."""
    while len(cells) > 1:
        cells = [product(*cells[i : i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


def parsed(symbols: str) -> Cell:
    return combined([leaf(symbols[i : i + LEAF]) for i in range(0, len(symbols), LEAF)])


def answer(cell: Cell) -> tuple[int, str]:
    """The least cost and its audit of whole conversations."""
    return min(cell[key] for key in ("BB", "BA") if key in cell)


# ---- rows and blocks -----------------------------------------------------------


def _faults(roles: list[str], texts: list[str], first: set[int] | None = None) -> tuple[list[str], str]:
    """The fault of each row ('' for none) and its symbol. ``first``: places of rows whose role and text are new."""
    seen: set[tuple[str, str]] = set()
    faults, symbols = [], []
    for i, (role, text) in enumerate(zip(roles, texts)):
        fresh = (role, text) not in seen if first is None else i in first
        if first is None:
            seen.add((role, text))
        inside = text.strip(BLANKS)
        fault = "blank" if not inside else "duplicate" if not fresh else "" if inside[-1] in ".!?" else "truncated"
        symbol = role[:1] if role[:1] in ("s", "u", "a") else "-"
        if fault == "truncated":
            symbol = symbol.upper() if symbol != "-" else "_"
        faults.append(fault)
        symbols.append("x" if fault in ("blank", "duplicate") else symbol)
    return faults, "".join(symbols)


def _segment(turns: list, roles: list[str], texts: list[str], first: set[int] | None = None) -> dict:
    """What can be said of neighbouring rows of a conversation and combined with what stands beside them."""
    faults, symbols = _faults(roles, texts, first)
    known = [t for t in turns if t is not None]
    return {
        "n": len(roles),
        "blank": faults.count("blank"),
        "duplicate": faults.count("duplicate"),
        "truncated": faults.count("truncated"),
        "illegal": sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:])),
        "opens": roles[0][:1],
        "closes": roles[-1][:1],
        "least": min(known, default=None),
        "most": max(known, default=None),
        "distinct": len(set(known)),
        "cell": parsed(symbols),
    }


def _joined(parts: list[dict]) -> dict:
    """The segment of neighbouring segments in order. Turns are sorted, so two of them share at most one turn."""
    out = {c: sum(p[c] for p in parts) for c in ("n", "blank", "duplicate", "truncated", "illegal", "distinct")}
    out["illegal"] += sum(a["closes"] + b["opens"] not in LEGAL for a, b in zip(parts, parts[1:]))
    dated = [p for p in parts if p["most"] is not None]
    out["distinct"] -= sum(a["most"] == b["least"] for a, b in zip(dated, dated[1:]))
    out |= {"opens": parts[0]["opens"], "closes": parts[-1]["closes"]}
    out |= {"least": dated[0]["least"] if dated else None, "most": dated[-1]["most"] if dated else None}
    return out | {"cell": combined([p["cell"] for p in parts])}


FACTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _facts(segment: dict) -> dict:
    cost, audit = answer(segment["cell"])
    gaps = segment["most"] - segment["least"] + 1 - segment["distinct"] if segment["most"] is not None else 0
    return {c: segment[c] for c in FACTS[1:5]} | {"gaps": gaps, "cost": cost, "audit": audit}


def apply_edits(audit: str, roles: list[str], texts: list[str], place: int = 0, led: bool | None = None) -> list[dict]:
    """The repaired turns. ``place`` turns stand before them, and ``led`` says whether the conversation begins with s.

    A whole conversation begins with s just if its number of turns is odd.
    """
    led = (len(audit) - audit.count("D")) % 2 == 1 if led is None else led
    out, rows = [], iter(zip(roles, texts))
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = "user" if (place + len(out) - led) % 2 == 0 else "assistant"
        out.append({"role": role, "text": text})
    return out


def _lines(turns: list[dict]) -> str:
    return "\n".join(f"{t['role']}:{t['text']}" for t in turns)


_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
_TURNS = "turns array<struct<role: string, text: string>>"
_CELL = pa.list_(pa.struct([("span", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))
_BLOCKS = "conv_id bigint, block bigint, turns array<bigint>, roles array<string>, texts array<string>"
_SUMMARY = "conv_id bigint, " + ", ".join(f"{c} bigint" for c in FACTS) + ", audit string"
_SEGMENT = [("conv_id", "bigint"), ("place", "bigint"), ("n", "bigint"), ("blank", "bigint"), ("duplicate", "bigint"), ("truncated", "bigint")]
_SEGMENT += [("illegal", "bigint"), ("opens", "string"), ("closes", "string"), ("least", "bigint"), ("most", "bigint"), ("distinct", "bigint")]
_SEGMENT += [("cell", "array<struct<span: string, cost: bigint, audit: string>>"), ("blocks", "array<struct<block: bigint, n: bigint>>")]
_SEGMENT_DDL = ", ".join(f"{name} {kind}" for name, kind in _SEGMENT)
_ARROW = {"bigint": pa.int64(), "string": pa.string()}
_SEGMENT_ARROW = pa.schema(
    [(name, _ARROW[kind]) for name, kind in _SEGMENT[:-2]]
    + [("cell", _CELL), ("blocks", pa.list_(pa.struct([("block", pa.int64()), ("n", pa.int64())])))]
)
_SUMMARY_ARROW = [("conv_id", pa.int64()), *((c, pa.int64()) for c in FACTS), ("audit", pa.string())]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to blocks of neighbouring rows of one conversation; block numbers follow the order of the rows."""
    number = TaskContext.get().partitionId() << 33
    kinds = [("conv_id", pa.int64()), ("block", pa.int64()), ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]

    def rows():
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                yield from zip(*(part.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")))

    def blocks():
        for conv, members in groupby(rows(), key=lambda r: r[0]):
            turns, roles, texts, chars = [], [], [], 0
            for _, turn, role, text in members:
                if roles and (len(roles) == BLOCK_ROWS or chars + len(text) > BLOCK_CHARS):
                    yield conv, turns, roles, texts
                    turns, roles, texts, chars = [], [], [], 0
                turns.append(turn)
                roles.append(role)
                texts.append(text)
                chars += len(text)
            yield conv, turns, roles, texts

    held, chars = [], 0
    for conv, turns, roles, texts in blocks():
        held.append((conv, number, turns, roles, texts))
        number += 1
        chars += sum(map(len, texts))
        if len(held) == 2000 or chars > BLOCK_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*held), kinds)], names=[n for n, _ in kinds])
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*held), kinds)], names=[n for n, _ in kinds])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of one block each: their facts, their repaired turns and the digest of these."""
    kinds = [*_SUMMARY_ARROW, ("repaired_sha256", pa.string()), ("turns", pa.list_(_TURN))]
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            out = []
            for row in batch.slice(start, 500).to_pylist():
                facts = _facts(_segment(row["turns"], row["roles"], row["texts"]))
                turns = apply_edits(facts["audit"], row["roles"], row["texts"])
                digest = hashlib.sha256(_lines(turns).encode()).hexdigest()
                out.append(facts | {"conv_id": row["conv_id"], "repaired_sha256": digest, "turns": turns})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(kinds))


def _as_row(segment: dict) -> dict:
    return segment | {"cell": [{"span": k, "cost": c, "audit": a} for k, (c, a) in segment["cell"].items()]}


def _as_segment(row: dict) -> dict:
    return row | {"cell": {c["span"]: (c["cost"], c["audit"]) for c in row["cell"]}}


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 100):
            out = []
            for row in batch.slice(start, 100).to_pylist():
                segment = _segment(row["turns"], row["roles"], row["texts"], set(row["first"] or []))
                own = {"conv_id": row["conv_id"], "place": row["place"], "blocks": [{"block": row["block"], "n": segment["n"]}]}
                out.append(_as_row(segment) | own)
            yield pa.RecordBatch.from_pylist(out, schema=_SEGMENT_ARROW)


def _merged(table: pa.Table) -> pa.Table:
    parts = sorted(table.to_pylist(), key=lambda r: r["place"])
    segment = _as_row(_joined([_as_segment(p) for p in parts]))
    segment |= {"conv_id": parts[0]["conv_id"], "place": parts[0]["place"] // FAN, "blocks": [b for p in parts for b in p["blocks"]]}
    return pa.Table.from_pylist([segment], schema=_SEGMENT_ARROW)


def _summed_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            yield pa.RecordBatch.from_pylist([_facts(_as_segment(row)) | {"conv_id": row["conv_id"]}], schema=pa.schema(_SUMMARY_ARROW))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The part of the audit that belongs to each block of a conversation; insertions go with the row after them."""
    schema = pa.schema([("block", pa.int64()), ("audit", pa.string()), ("before", pa.int64()), ("led", pa.bool_())])
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            _, audit = answer(_as_segment(row)["cell"])
            led, at, before, out = (len(audit) - audit.count("D")) % 2 == 1, 0, 0, []
            for k, block in enumerate(row["blocks"]):
                end, rows = at, 0
                while end < len(audit) and rows < block["n"]:
                    rows += audit[end] != "I"
                    end += 1
                piece = audit[at:] if k + 1 == len(row["blocks"]) else audit[at:end]
                out.append({"block": block["block"], "audit": piece, "before": before, "led": led})
                at, before = end, before + len(piece) - piece.count("D")
            for start in range(0, len(out), 10_000):
                yield pa.RecordBatch.from_pylist(out[start : start + 10_000], schema=schema)


def _repaired_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("first", pa.int64()), ("turns", pa.list_(_TURN))])
    for batch in batches:
        for start in range(0, batch.num_rows, 50):
            out = []
            for row in batch.slice(start, 50).to_pylist():
                turns = apply_edits(row["audit"], row["roles"], row["texts"], row["before"], row["led"])
                if turns:
                    out.append({"conv_id": row["conv_id"], "first": row["before"], "turns": turns})
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of the lines of each conversation, from its sorted pieces one after the other."""

    def rows():
        for batch in batches:
            for i in range(batch.num_rows):
                yield batch.slice(i, 1).to_pylist()[0]

    for conv, pieces in groupby(rows(), key=lambda r: r["conv_id"]):
        digest = hashlib.sha256()
        for piece in pieces:
            digest.update((("\n" if piece["first"] else "") + _lines(piece["turns"])).encode())
        yield pa.record_batch({"conv_id": pa.array([conv], pa.int64()), "repaired_sha256": pa.array([digest.hexdigest()])})


def _parse(rows: DataFrame, columns: tuple[str, str, str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Conversations of one block, with their turns; the summary of the longer ones; the repaired turns of these."""
    conv, turn, role, text = (F.col(c) for c in columns)
    rows = rows.select(
        conv.cast("bigint").alias("conv_id"), turn.cast("bigint").alias("turn"),
        F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"),
    ).withColumns({"mark": F.xxhash64("text"), "copy": F.monotonically_increasing_id()})
    order = ["conv_id", "turn", "role", "mark"]
    # the number of the row keeps even equal rows from being one piece of the range
    ordered = rows.repartitionByRange(*order, "copy").sortWithinPartitions(*order, "text").select("conv_id", "turn", "role", "text")
    blocks = written(ordered.mapInArrow(_cut, _BLOCKS), "blocks")

    counted = blocks.groupBy("conv_id").agg(F.count("*").alias("c")).where("c > 1").select("conv_id")
    short, long = split_by_keys(blocks.where("conv_id IS NOT NULL"), counted, "conv_id")
    done = short.mapInArrow(_whole, f"{_SUMMARY}, repaired_sha256 string, {_TURNS}")

    long = written(long.unionByName(blocks.where("conv_id IS NULL")), "long")
    each = long.select("conv_id", "block", F.posexplode(F.arrays_zip("roles", "texts")).alias("i", "r"))
    mark = F.sha2(F.concat(F.length("r.roles").cast("string"), F.lit(":"), "r.roles", "r.texts"), 256)
    news = each.groupBy("conv_id", mark.alias("mark")).agg(F.min(F.struct("block", "i")).alias("at"))
    news = news.groupBy("at.block").agg(F.collect_list("at.i").alias("first"))
    places = index_within(long.select("conv_id", "block"), ["conv_id"], [F.col("block")], "place", unique=True)
    places = places.select("block", "place").unionByName(_without_conversation(long))
    segments = written(long.join(news, "block", "left").join(places, "block").mapInArrow(_described, _SEGMENT_DDL), "segments")
    while (segments.agg(F.max("place")).first()[0] or 0) > 0:
        step = segments.groupBy("conv_id", F.floor(F.col("place") / FAN).alias("span"))
        segments = written(step.applyInArrow(_merged, _SEGMENT_DDL), "segments")
    summary = segments.mapInArrow(_summed_up, _SUMMARY)
    pieces = segments.mapInArrow(_pieces, "block bigint, audit string, before bigint, led boolean")
    turns = long.drop("turns").join(pieces, "block").mapInArrow(_repaired_blocks, f"conv_id bigint, first bigint, {_TURNS}")
    return done, summary, turns


def _without_conversation(long: DataFrame) -> DataFrame:
    """Places of the blocks without conversation id, which are one conversation (a join on keys passes nulls by)."""
    own = long.where("conv_id IS NULL").select(F.lit(0).alias("conv_id"), "block")
    return index_within(own, ["conv_id"], [F.col("block")], "place", unique=True).select("block", "place")


def repair_conversations(rows: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """The faults of each conversation, the cheapest repair and a digest of the repaired turns.

    The rows of a conversation are taken by turn (nulls first, then by role and by a hash of the text). A row is blank
    without a byte other than space, tab, line and page feeds, a duplicate if its role and text were seen earlier,
    truncated if its last such byte is none of ``.!?``; only the first of these counts. Blank rows and duplicates must be
    deleted. Edits: keep (free), rerole to user or assistant (2), delete (3), insert an empty turn (2); a truncated row
    that stays adds 1. A row may be kept where the first letter of its role fits; a role without letter never fits.

    Returns a row for each conversation: conv_id, gaps (missing turns between the least and the greatest), blank,
    duplicate, truncated, illegal (neighbouring initials other than su, ua, au), cost, audit (K, R, D, I in order; of
    equally cheap ones the least), repaired_sha256 (of the lines ``role:text``).

    Null role or text: one space. Null turn: first, and no part of ``gaps``. Null id: one conversation. Repeated rows are
    duplicates. Other columns are ignored. An empty table gives no row. A text of any length is one row; the digest of a
    conversation is taken by one task, which reads its blocks one after the other.
    """
    done, summary, turns = _parse(rows, (conv_column, turn_column, role_column, text_column))
    sorted_turns = turns.repartition("conv_id").sortWithinPartitions("conv_id", "first")
    digests = sorted_turns.mapInArrow(_digests, "conv_id bigint, repaired_sha256 string")
    long = summary.alias("s").join(digests.alias("d"), F.expr("s.conv_id <=> d.conv_id"), "left")
    columns = ["conv_id", *FACTS, "audit"]
    digest = F.coalesce("d.repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
    return done.select(*columns, "repaired_sha256").unionByName(long.select(*(f"s.{c}" for c in columns), digest.alias("repaired_sha256")))


def repaired_turns(rows: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """The turns after the repair of ``repair_conversations``: conv_id, place (from 0), role, text."""
    done, _, turns = _parse(rows, (conv_column, turn_column, role_column, text_column))
    both = done.select("conv_id", F.lit(0).cast("bigint").alias("first"), "turns").unionByName(turns)
    each = both.select("conv_id", "first", F.posexplode("turns").alias("i", "t"))
    return each.select("conv_id", (F.col("first") + F.col("i")).alias("place"), "t.role", "t.text")


def damaged(rows: DataFrame, kind: Column) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults put in: kind 0 drops a row, 1 empties its text, 2 takes its end marks,
    3 repeats it, 4 makes it a user's."""
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(kind == 3, 2).otherwise(1)
    out = rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
    return out.drop("copy")
