import gzip
import hashlib
import io
import tempfile

import numpy as np
import pytest

from spectrel.llm.queries import QUERIES
from spectrel.llm.warc import archive_round_trip, read_archives, record, salvage, write_archives


def archive(n=40, packed=True, seed=0):
    random = np.random.default_rng(seed)
    out = []
    for i in range(n):
        body = random.integers(97, 123, int(random.integers(0, 9000))).astype(np.uint8).tobytes()
        raw = record(i, f"http://h/{i}", body, hashlib.sha256(body).hexdigest(), None)
        out.append(gzip.compress(raw) if packed else raw)
    return out


def read(data):
    return list(salvage(io.BytesIO(data)))


def ids(found):
    return [int(f.headers["warc-record-id"][10:-1]) for f in found if f.reason is None]


def tiles(found, size):
    place = 0
    for f in found:
        assert f.start == place and f.size > 0
        place += f.size
    assert place == size


@pytest.mark.parametrize("packed", [True, False])
def test_whole_archive(packed):
    parts = archive(packed=packed)
    found = read(b"".join(parts))
    assert ids(found) == list(range(40)) and all(f.reason is None for f in found)
    tiles(found, sum(map(len, parts)))


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("seed", range(6))
def test_damage_costs_the_damaged_records_only(packed, seed):
    random = np.random.default_rng(seed)
    parts = archive(packed=packed, seed=seed)
    hurt = set(map(int, random.choice(40, 4, replace=False)))
    for k in hurt:
        own = bytearray(parts[k])
        how = random.integers(3)
        if how == 0:
            own[len(own) // 2] ^= 0x55
        elif how == 1:
            del own[len(own) // 2 :]
        else:
            own = bytearray(b"garbage \x1f\x8b\x08 WARC/1.1 junk") + own[30:]
        parts[k] = bytes(own)
    data = b"".join(parts)
    found = read(data)
    tiles(found, len(data))
    assert set(range(40)) - hurt <= set(ids(found))
    assert any(f.reason for f in found)


def test_gaps_between_and_at_the_ends():
    parts = archive(3)
    data = b"junk before" + parts[0] + b"\0" * (3 << 20) + parts[1] + parts[2][:-20]
    found = read(data)
    assert ids(found) == [0, 1] and [f.reason is None for f in found] == [False, True, False, True, False]
    tiles(found, len(data))
    assert read(b"") == [] and [f.size for f in read(b"nothing here")] == [12]


def test_splits_share_no_record():
    parts = archive(20)
    places = np.cumsum([0, *map(len, parts)])
    data = io.BytesIO(b"".join(parts))
    assert ids([f for a, b in ((0, 7), (7, 8), (8, 20)) for f in salvage(data, int(places[a]), int(places[b]))]) == list(range(20))


def test_round_trip_of_edge_rows(spark):
    same = "x" * 100
    rows = [(5, "u", same, 1), (3, "u", same, 1), (3, "v", same, 1), (9, None, same, 1), (1, "a\r\nWARC-Type: bad", "short", 1), (2, "u", "short", 1)]
    rows += [(4, "u", None, 1), (6, "u", "", 1), (None, "u", same, 1), (7, "u", "WARC/1.1\r\n\r\n" * 50, 1), (8, "u", "é\0" * 300_000, 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, first int").repartition(3)
    got = archive_round_trip(pages).collect()
    assert all(r.reason is None for r in got) and len(got) == len(rows)
    seen = sorted((r.record_id[10:-1], r.record_type, (r.refers_to or "")[10:-1], r.payload_bytes, r.payload_digest) for r in got)
    expected = []
    for page, _, html, _ in rows:
        data = (html or "").encode()
        revisit = html == same and page is not None and page > 3
        expected.append(("" if page is None else str(page), "revisit" if revisit else "response", "3" if revisit else "", len(data), hashlib.sha256(data).hexdigest()))
    assert seen == sorted(expected)
    assert archive_round_trip(pages.where("false")).count() == 0


def test_a_damaged_file_is_read_by_spark(spark, tmp_path):
    parts = archive(10)
    parts[4] = parts[4][:50]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(parts))
    splits = spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz", 0, None)], "path string, start bigint, stop bigint")
    got = read_archives(splits).collect()
    assert sum(r.reason is None for r in got) == 9 and sum(r.size for r in got) == sum(map(len, parts))


def test_query(spark):
    assert QUERIES["op4_archived_pages"](spark, "/root/testdata/sf0.001").count() > 0


def test_torn_records_cost_nothing_and_splits_are_read_apart(spark, monkeypatch):
    monkeypatch.setattr("spectrel.llm.warc.SPLIT_BYTES", 1 << 12)
    random = np.random.default_rng(2)
    bodies = ["x" * 200, "small", None, *("".join(map(chr, random.integers(97, 123, 300))) for _ in range(97))]
    rows = [(i, f"http://h/{i}", bodies[i % 100], "d", 1) for i in range(400)] + [(None, None, "x" * 200, "d", 1), (3, "again", bodies[3], "d", 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, payload_digest string, first int").repartition(3)
    splits = spark.createDataFrame(write_archives(pages, tempfile.mkdtemp(), torn_every=7).collect())
    assert splits.count() > 6
    found = read_archives(splits)
    assert found.rdd.getNumPartitions() == splits.count()
    found = found.collect()
    got = sorted(((r.record_id, r.record_type, r.refers_to, r.payload_bytes) for r in found if r.reason is None), key=str)
    expected = []
    for page, _, body, *_ in rows:
        size = len(body or "")
        first = page % 100 if page is not None and page >= 100 and size >= 100 else None
        expected.append((f"<urn:page:{'' if page is None else page}>", "response" if first is None else "revisit", first if first is None else f"<urn:page:{first}>", size))
    assert got == sorted(expected, key=str)
    assert 40 < sum(r.reason is not None for r in found) < 60
