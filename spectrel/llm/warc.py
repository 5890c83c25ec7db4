"""WARC archives: a writer with one gzip member for each record, and a reader that salvages damaged files.

Archives are files in a folder that all executors share (any file system that ``pyarrow.fs`` can open). Each write
attempt has a file of its own name; the table that Spark returns lists those that count, so a lost executor leaves
nothing behind that is read. Readers work on splits that begin at a record, in a window of bounded size. A record that
fails a check (member checksum, length, end mark, payload digest) is put aside as a byte gap; the reader goes on at the
next place that holds a valid member or version line.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spectrel.operators.shared import new_path, written

from .hashfilter import split_by_keys

LEAST_SHARED = 100  # bytes of a payload from which equal ones are written once
SPLIT_BYTES = 8 << 20
MOST_TASKS = 10_000  # of a read
CHUNK = 1 << 20
MAGIC, VERSION = b"\x1f\x8b\x08", b"WARC/1."
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_SPLITS = "path string, start bigint, stop bigint"
_RECORDS = (
    "path string, start bigint, size bigint, reason string, record_type string, record_id string, refers_to string, target string,"
    " payload_bytes bigint, payload_digest string"
)


def _line(text: str | None) -> bytes:
    """Header values hold no line ends."""
    return (text or "").replace("\r", "%0D").replace("\n", "%0A").encode()


def record(page_id, url: str | None, payload: bytes, digest: str, first) -> bytes:
    """A response, or with ``first`` (the id of the record that holds the same payload) a revisit of it."""
    head = HTTP % len(payload)
    block = head if first is not None else head + payload
    fields = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"response" if first is None else b"revisit"),
        b"WARC-Record-ID: <urn:page:%s>" % (b"" if page_id is None else b"%d" % page_id),
        b"WARC-Target-URI: " + _line(url),
        b"WARC-Date: 1970-01-01T00:00:00Z",
        b"WARC-Payload-Digest: sha256:" + digest.encode(),
        b"X-Payload-Length: %d" % len(payload),
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    if first is not None:
        fields += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: <urn:page:%d>" % first]
    return b"\r\n".join(fields) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _write(folder: str, torn_every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pyarrow.fs.FileSystem.from_uri(folder)
        path, out, starts, place, n = f"part-{uuid.uuid4().hex}.warc.gz", None, [0], 0, 0
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "payload_digest", "first"))):
                page_id, url, payload, digest, first = (cell.as_py() for cell in row)
                packer = zlib.compressobj(3, zlib.DEFLATED, 31)
                member = packer.compress(record(page_id, url, payload, digest, first)) + packer.flush()
                if out is None:
                    system.create_dir(root, recursive=True)
                    out = system.open_output_stream(f"{root}/{path}", compression=None)  # members are packed here
                if place - starts[-1] >= SPLIT_BYTES:
                    starts.append(place)
                n += 1
                if torn_every and n % torn_every == 0:
                    member += member[: len(member) // 2]
                out.write(member)
                place += len(member)
        if out is not None:
            out.close()
            rows = [(f"{folder}/{path}", a, b) for a, b in zip(starts, [*starts[1:], place])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["path", "start", "stop"])

    return run


def write_archives(pages: DataFrame, folder: str, torn_every: int = 0) -> DataFrame:
    """Write a record for each row (page_id, url, html) into ``folder``; returns the splits (path, start, stop).

    Of rows with equal payloads of ``LEAST_SHARED`` bytes or more, that with the smallest page_id is a response and the
    others revisit it; all others are responses. Only ids and digests are grouped, and only rows that may be a revisit are
    joined, by their id; payloads of popular pages stay where they are. After every ``torn_every``-th record of a file its
    first half is written once more, as by a writer that was cut off (0: never).

    Null html is an empty payload, a null url an empty one. Rows with a null page_id, and rows that repeat the smallest id,
    are responses. Other columns are ignored; an empty table writes nothing.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    names = rows.where(f"octet_length(payload) >= {LEAST_SHARED} AND page_id IS NOT NULL").select("page_id", "payload_digest")
    names = written(names.distinct(), "digests")
    firsts = names.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    revisits = written(names.join(firsts, "payload_digest").where("page_id > first"), "revisits")
    alone, rest = split_by_keys(rows, revisits, "page_id")
    rest = rest.join(revisits, ["page_id", "payload_digest"], "left").select(*rows.columns, "first")
    marked = alone.withColumn("first", F.lit(None).cast("bigint")).unionByName(rest)
    return marked.mapInArrow(_write(folder, torn_every), _SPLITS)


# ---- reading -------------------------------------------------------------------


class Window:
    """Bytes of a file from a moving place, read in chunks."""

    def __init__(self, file):
        file.seek(0, 2)
        self.file, self.start, self.data, self.end = file, 0, b"", file.tell()
        file.seek(0)

    def at(self, place: int, size: int) -> bytes:
        """Up to ``size`` bytes from ``place``; fewer only at the end of the file."""
        if place < self.start or place > self.start + len(self.data):
            self.file.seek(place)
            self.start, self.data = place, b""
        while self.start + len(self.data) < place + size:
            more = self.file.read(max(CHUNK, size))
            if not more:
                break
            self.data = self.data[max(0, place - self.start) :] + more
            self.start = max(self.start, place)
        return self.data[place - self.start : place - self.start + size]


class Found(NamedTuple):
    start: int
    size: int
    reason: str | None  # of a gap; None for a record
    headers: dict[str, str]
    payload: bytes


def _member(window: Window, place: int) -> tuple[bytes, int]:
    """The content and size of the gzip member at a place; raises ValueError where there is no whole one."""
    opener, parts, size, room = zlib.decompressobj(31), [], 0, 1 << 12
    try:
        while not opener.eof:
            data = window.at(place + size, room)
            room = min(2 * room, CHUNK)
            if not data:
                raise ValueError("cut off")
            parts.append(opener.decompress(data))
            size += len(data) - len(opener.unused_data)
            if len(parts) == 1 and not b"".join(parts).startswith(VERSION[: len(parts[0])]):
                raise ValueError("no record")
    except zlib.error as error:
        raise ValueError("member checksum" if "check" in str(error) or "length" in str(error) else "member data") from None
    return b"".join(parts), size


def _parsed(head: bytes) -> dict[str, str]:
    """The headers by small name; raises ValueError without a plain version line or a header that every record has."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    if not re.fullmatch(r"WARC/1\.\d+", lines[0]) or not {"warc-type", "warc-record-id"} <= set(headers) or not headers.get("content-length", "").isdigit():
        raise ValueError("headers")
    return headers


def _checked(headers: dict[str, str], block: bytes) -> bytes:
    """The payload; raises ValueError where the digest is another one."""
    payload = block.partition(b"\r\n\r\n")[2] if headers.get("content-type", "").startswith("application/http") else block
    kind, _, digest = headers.get("warc-payload-digest", "").partition(":")
    if headers.get("warc-type") == "response" and kind == "sha256" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("payload digest")
    return payload


def record_at(window: Window, place: int) -> Found:
    """The record at a place, packed or plain; raises ValueError where it fails a check."""
    opening = window.at(place, 8)
    if opening.startswith(MAGIC):
        text, size = _member(window, place)
        head, _, rest = text.partition(b"\r\n\r\n")
        headers = _parsed(head)
        length = int(headers["content-length"])
        if rest[length:] != b"\r\n\r\n":
            raise ValueError("length")
        return Found(place, size, None, headers, _checked(headers, rest[:length]))
    if not opening.startswith(VERSION):
        raise ValueError("no record")
    room = 1 << 16
    while (end := (text := window.at(place, room)).find(b"\r\n\r\n")) < 0:
        if len(text) < room or room > 1 << 24:
            raise ValueError("headers")
        room *= 2
    headers = _parsed(text[:end])
    length = int(headers["content-length"])
    if place + end + 8 + length > window.end:  # a damaged length is not read
        raise ValueError("length")
    block = window.at(place + end + 4, length + 4)
    if block[length:] != b"\r\n\r\n":
        raise ValueError("length")
    return Found(place, end + 8 + length, None, headers, _checked(headers, block[:length]))


def _next(window: Window, place: int) -> tuple[int, Found | None]:
    """The next place from ``place`` on that holds a valid record, or the end of the file."""
    while True:
        data = window.at(place, CHUNK)
        if not data:
            return place, None
        spots = [s for s in (data.find(MAGIC), data.find(VERSION)) if s >= 0]
        if not spots:
            if len(data) < CHUNK:
                return place + len(data), None
            place += len(data) - len(VERSION)
            continue
        place += min(spots)
        try:
            return place, record_at(window, place)
        except ValueError:
            place += 1


def salvage(file, start: int = 0, stop: int | None = None) -> Iterator[Found]:
    """Records that begin in [start, stop) and the gaps between them.

    ``start`` is the file's begin or the begin of a record. Search after a failed record starts one byte further, so the
    records inside a broken member's range are found. A gap ends at the next valid record or the end of the file.
    """
    window, place = Window(file), start
    while stop is None or place < stop:
        if not window.at(place, 1):
            return
        try:
            found = record_at(window, place)
        except ValueError as error:
            end, found = _next(window, place + 1)
            yield Found(place, end - place, str(error), {}, b"")
            place = end
            if found is None:
                return
            if stop is not None and place >= stop:
                return
        yield found
        place += found.size


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["path", "start", "size", "reason", "record_type", "record_id", "refers_to", "target", "payload_bytes", "payload_digest"]
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for split in batch.to_pylist():
            system, path = pyarrow.fs.FileSystem.from_uri(split["path"])
            rows = []
            with system.open_input_file(path) as file:
                for found in salvage(file, split["start"], split["stop"]):
                    h = found.headers
                    revisit = h.get("warc-type") == "revisit"
                    digest = h.get("warc-payload-digest", "").partition(":")[2] if revisit else hashlib.sha256(found.payload).hexdigest()
                    size = int(h.get("x-payload-length", "0") if revisit else len(found.payload))
                    facts = (None,) * 6 if found.reason else (h.get("warc-type"), h.get("warc-record-id"), h.get("warc-refers-to"), h.get("warc-target-uri"), size, digest)
                    rows.append((split["path"], found.start, found.size, found.reason, *facts))
                    if len(rows) == 5000:
                        yield table(rows)
                        rows = []
            if rows:
                yield table(rows)


def read_archives(splits: DataFrame) -> DataFrame:
    """Records and quarantined gaps of the splits (path, start, stop; stop null: to the end of the file).

    A row has path, start, size and either reason (a gap) or record_type, record_id, refers_to, target, payload_bytes and
    payload_digest (SHA-256 in hex). The payload of a revisit is that of the record it refers to; its size and digest come
    from its headers. An empty table or an empty file gives no row.
    """
    # rows of a split are tiny and what is read for them is not, so the number of tasks is given
    tasks = max(1, min(MOST_TASKS, splits.count()))
    return splits.select("path", "start", "stop").repartition(tasks, "path", "start").mapInArrow(_read, _RECORDS)


def archive_round_trip(pages: DataFrame, torn_every: int = 0) -> DataFrame:
    """Write the pages into archives in the shared folder and read those back: the rows of ``read_archives``."""
    folder = new_path(pages.sparkSession, "archives")
    return read_archives(written(write_archives(pages, folder, torn_every), "splits"))
