import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from spectrel.llm.packing import encoder, fullest, pack, slack_plan

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(1, 6)), max_size=8), st.integers(1, 60))
def test_the_fullest_combination(items, room):
    counts = np.zeros(61, np.int64)
    for length, times in items:
        counts[length] += times
    totals = {0}
    for length in np.flatnonzero(counts):
        totals = {t + length * k for t in totals for k in range(counts[length] + 1)}
    chosen = fullest(counts, room)
    assert all(times <= counts[length] for length, times in chosen)
    assert sum(length * times for length, times in chosen) == max(t for t in totals if t <= room)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_the_plan_places_every_piece_once(lengths):
    counts = np.bincount(np.array(lengths, int), minlength=65).astype(np.int64)
    plan = slack_plan(counts, 64)
    seen, fill = set(), {}
    for length in np.flatnonzero(counts):
        own = plan[plan[:, 0] == length]
        for number in range(counts[length]):
            _, first, sequence, times, offset = own[np.searchsorted(own[:, 1], number, side="right") - 1]
            bins, place = divmod(number - first, times)
            cells = [(sequence + bins, offset + place * length + i) for i in range(length)]
            assert not seen & set(cells)
            seen |= set(cells)
            fill[sequence + bins] = max(fill.get(sequence + bins, 0), offset + (place + 1) * length)
    assert len(seen) == sum(fill.values()) == sum(lengths) and all(v <= 64 for v in fill.values())


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80) | st.sampled_from(["", "<|endoftext|>", "a <|endoftext|> b", "x" * 3000, " \n\t ", "don't  STOP 123"]))
def test_ids_are_those_of_tokenizers(text):
    assert encoder(PATH)(text).tolist() == WHOLE.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("sign", [" ", "\n", "\t", "a", " \n", "é", "1", "-"])
def test_a_million_of_one_sign(sign):
    text = sign * 1_000_000 + "end"
    assert encoder(PATH)(text).tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def test_a_run_that_the_fast_engine_gives_up_on(spark):
    docs = spark.createDataFrame([(1, " " * 1_000_000), (2, "x")], "doc_id bigint, text string")
    got = pack(docs, PATH).toPandas()
    n = len(WHOLE.encode(" " * 1_000_000, add_special_tokens=False).ids) + 1
    assert got.length[got.doc_id == 1].sum() == n and got.sequence_id.nunique() == -(-(n + 2) // 2048)


def test_pieces_and_places(spark):
    texts = {1: "hello world", 2: None, 3: "", 4: "word " * 5000, 5: "tok " * 2047, 6: "tok " * 2046, 7: "same text", 8: "same text"}
    rows = [(k, v, 1, "s") for k, v in texts.items()] + [(8, "same text", 1, "s"), (None, "null id", 1, "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, length int, salt string").repartition(3)
    got = pack(docs, PATH).toPandas()
    ids = {k: np.array([*WHOLE.encode(v or "", add_special_tokens=False).ids, 0], "<u4") for k, v in texts.items()}
    ids[None] = np.array([*WHOLE.encode("null id", add_special_tokens=False).ids, 0], "<u4")
    for r in got.itertuples():
        own = ids[None if r.doc_id != r.doc_id else int(r.doc_id)]
        assert r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
    assert got.length.sum() == sum(map(len, ids.values())) + len(ids[8])
    long = got[got.doc_id == 4].sort_values("piece")
    assert long.piece.tolist() == list(range(len(long))) and (long.length.iloc[1:] == 2048).all()
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]] and own.length.sum() <= 2048
    assert got.sequence_id.nunique() == -(-got.length.sum() // 2048)


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id bigint, text string"), PATH).count() == 0
