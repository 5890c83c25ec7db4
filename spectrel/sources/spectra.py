"""MGF and mzXML sources and sinks, and peak arrays."""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import MAX_BAD_LINES, SPECTRA_PER_BATCH
from ..functions.text import extract_attr, mgf_title, pep_mass
from ..operators.batching import index_rows
from ..operators.scans import index_block
from .text_files import Paths, read_delimited, read_records, text_reader

PEAKS = "array<struct<mz:double,intensity:double>>"
_HEADER_LINE = r"^[A-Za-z][A-Za-z0-9_]*="


def _first_line(lines: str, start: str):
    return F.get(F.filter(lines, lambda l: l.startswith(start)), F.lit(0))


def read_mgf(spark: SparkSession, path: Paths, glob: str | None = None) -> DataFrame:
    """One row per ``BEGIN IONS`` block; text before the first block of a file is skipped, header lines too.

    A block without ``END IONS`` goes on to the next block or the end of the file.
    A line that is neither a header nor a peak is counted in ``bad_lines``. A block
    without title is named by the split of the file and its place there.
    """
    block = F.substring_index("value", "END IONS", 1)
    blocks = (
        read_records(spark, path, "BEGIN IONS", glob)
        .where(F.col("value").contains("END IONS") | F.col("value").rlike(r"(?m)^(PEPMASS|TITLE|CHARGE)="))
        .select("source_file", "block", "place", F.filter(F.transform(F.split(block, "\r?\n"), lambda l: F.trim(l)), lambda l: l != "").alias("lines"))
    )
    fields = blocks.select(
        "source_file",
        "block",
        "place",
        F.filter("lines", lambda l: l.rlike(_HEADER_LINE)).alias("headers"),
        F.transform(
            F.filter("lines", lambda l: ~l.rlike(_HEADER_LINE)), lambda l: F.split(l, r"[ \t]+")
        ).alias("cells"),
    )
    peaks = F.transform(
        "cells", lambda c: F.struct(F.get(c, F.lit(0)).try_cast("double").alias("mz"), F.get(c, F.lit(1)).try_cast("double").alias("intensity"))
    )
    parsed = fields.select(
        "source_file", "block", "place", "headers", F.filter(peaks, lambda p: p["mz"].isNotNull() & p["intensity"].isNotNull()).alias("peaks"), F.size("cells").alias("n_lines")
    )
    title = mgf_title(_first_line("headers", "TITLE="))
    charge = F.regexp_extract(_first_line("headers", "CHARGE="), r"(\d+)", 1).try_cast("int")
    scan = F.regexp_extract(_first_line("headers", "SCANS="), r"(\d+)", 1).try_cast("int")
    return parsed.select(
        F.coalesce(title, F.concat_ws("-", F.lit("untitled"), F.col("block").cast("string"), F.col("place").cast("string"))).alias("spectrum_id"),
        title.alias("title"),
        F.lit(2).alias("ms_level"),
        pep_mass(_first_line("headers", "PEPMASS=")).alias("precursor_mz"),
        charge.alias("charge"),
        scan.alias("scan_num"),
        "peaks",
        (F.col("n_lines") - F.size("peaks")).alias("bad_lines"),
        "source_file",
    )


class BadLines:
    """Counts unreadable lines as the spectra are read, without a pass of its own.

    ``counted(spectra)`` is what to work on; after an action on it ``check`` raises where there were too many.
    """

    def __init__(self, limit: int = MAX_BAD_LINES):
        self.limit = limit
        self.seen = Observation()

    def counted(self, spectra: DataFrame) -> DataFrame:
        return spectra.observe(self.seen, F.sum("bad_lines").alias("n"))

    def check(self) -> int:
        total = self.seen.get["n"] or 0
        if total > self.limit:
            raise ValueError(f"{total} lines could not be read, more than {self.limit}")
        return total


def check_bad_lines(spectra: DataFrame, limit: int = MAX_BAD_LINES) -> int:
    """Total of unparsable lines; raises above the limit."""
    total = spectra.agg(F.sum("bad_lines").alias("n")).first()["n"] or 0
    if total > limit:
        raise ValueError(f"{total} lines could not be read, more than {limit}")
    return total


def mgf_block(spectra: DataFrame) -> DataFrame:
    """MGF text of each spectrum."""
    peak_lines = F.transform("peaks", lambda p: F.concat_ws(" ", p["mz"].cast("string"), p["intensity"].cast("string")))
    head = F.concat_ws(
        "\n",
        F.lit("BEGIN IONS"),
        F.concat(F.lit("TITLE="), F.col("spectrum_id")),
        F.concat(F.lit("PEPMASS="), F.col("precursor_mz").cast("string")),
        F.concat(F.lit("CHARGE="), F.col("charge").cast("string"), F.lit("+")),
    )
    return spectra.select("spectrum_id", F.concat_ws("\n", head, F.array_join(peak_lines, "\n"), F.lit("END IONS\n")).alias("value"))


def write_mgf(spectra: DataFrame, path: str) -> None:
    mgf_block(spectra).select("value").write.mode("overwrite").text(path)


def read_scan_chunks(spark: SparkSession, path: Paths, glob: str | None = None) -> DataFrame:
    """Text between ``<scan `` marks in file order, nested scans included; the first chunk is the header."""
    return read_delimited(spark, path, "<scan ", glob)


def is_header_chunk():
    return F.col("value").rlike(r"<(mzXML|msRun|\?xml)\b")


def read_mzxml_headers(spark: SparkSession, path: str) -> DataFrame:
    """Header text of every file; a file that is not mzXML raises."""
    chunks = read_scan_chunks(spark, path).where(is_header_chunk() | (F.col("block") == 0))
    per_file = chunks.groupBy("source_file").agg(F.min_by("value", F.struct("block", "place")).alias("header"))
    bad = F.raise_error(F.concat(F.lit("not an mzXML file: "), F.col("source_file"))).cast("string")
    return per_file.select(
        "source_file", F.when(F.col("header").contains("<mzXML"), F.col("header")).otherwise(bad).alias("header")
    )


def read_scans(spark: SparkSession, path: Paths, glob: str | None = None) -> DataFrame:
    """One row per scan at any nesting level, peaks still encoded."""
    opening = F.regexp_extract("value", r"(?s)^([^>]*)>", 1)
    chunks = read_scan_chunks(spark, path, glob).where(~is_header_chunk()).withColumn("tag", F.concat(F.lit(" "), opening))
    precursor = F.regexp_extract("value", r"(?s)<precursorMz\b([^>]*)>", 1)
    peak_tag = F.regexp_extract("value", r"(?s)<peaks\b([^>]*)>", 1)
    own = F.rtrim(F.regexp_replace("value", r"(?s)</scan>.*$", ""))
    return chunks.select(
        extract_attr("tag", "num").try_cast("int").alias("scan_num"),
        extract_attr("tag", "msLevel").try_cast("int").alias("ms_level"),
        extract_attr("tag", "peaksCount").try_cast("int").alias("peaks_count"),
        F.trim(F.regexp_extract("value", r"(?s)<precursorMz\b[^>]*>([^<]*)<", 1)).try_cast("double").alias("precursor_mz"),
        extract_attr(precursor, "precursorCharge").try_cast("int").alias("charge"),
        extract_attr(precursor, "precursorScanNum").try_cast("int").alias("parent_num"),
        F.coalesce(extract_attr(peak_tag, "precision").try_cast("int"), F.lit(32)).alias("precision"),
        F.coalesce(extract_attr(peak_tag, "compressionType") == "zlib", F.lit(False)).alias("compressed"),
        F.regexp_replace(F.regexp_extract("value", r"(?s)<peaks\b[^>]*>([^<]*)<", 1), r"\s", "").alias("encoded"),
        F.concat(F.lit("<scan "), own, F.lit("</scan>\n")).alias("scan_text"),
        "source_file",
        "block",
        "place",
    ).where("scan_num is not null")


def peak_arrays(column: pa.ListArray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Peaks of a batch as two flat arrays, and where the peaks of each row start."""
    flat = column.flatten()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    values = {name: flat.field(name).to_numpy(zero_copy_only=False) for name in ("mz", "intensity")}
    return values, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def _decoded(text: str, precision: int, compressed: bool) -> np.ndarray | None:
    """Peaks of one scan, or None where the text is damaged."""
    try:
        raw = base64.b64decode(text or "", validate=True)
        if compressed:
            raw = zlib.decompress(raw)
        return np.frombuffer(raw, dtype=">f8" if precision == 64 else ">f4").astype("float64").reshape(-1, 2)
    except (ValueError, zlib.error):
        return None


def decode_peaks(scans: DataFrame) -> DataFrame:
    """Base64 peak text to an array of peaks: big-endian 32 or 64 bit pairs, zlib where marked.

    Damaged text gives no peaks and 1 in ``bad_lines``.
    """
    keep = [f for f in scans.schema if f.name not in ("encoded", "precision", "compressed")]
    names = [f.name for f in keep]

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            cells = (batch.column(n).to_pylist() for n in ("encoded", "precision", "compressed"))
            tried = [_decoded(*row) for row in zip(*cells)]
            decoded = [np.zeros((0, 2)) if d is None else d for d in tried]
            bad = pa.array([int(d is None) for d in tried], pa.int32())
            offsets = np.cumsum([0, *map(len, decoded)]).astype(np.int32)
            flat = np.concatenate([np.zeros((0, 2)), *decoded])
            pairs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["mz", "intensity"])
            column = pa.ListArray.from_arrays(pa.array(offsets), pairs)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], column, bad], names=[*names, "peaks", "bad_lines"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return scans.mapInArrow(batches, f"{fields}, peaks {PEAKS}, bad_lines int")


def encode_peaks(spectra: DataFrame, precision: int = 32, compressed: bool = False) -> DataFrame:
    """Peaks to base64 text, the inverse of ``decode_peaks``."""
    dtype = ">f8" if precision == 64 else ">f4"
    keep = [f for f in spectra.schema if f.name != "peaks"]
    names = [f.name for f in keep]

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            peaks, starts = peak_arrays(batch.column("peaks"))
            pairs = np.column_stack([peaks["mz"], peaks["intensity"]]).astype(dtype)
            raw = (pairs[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:]))
            texts = [base64.b64encode(zlib.compress(r) if compressed else r).decode("ascii") for r in raw]
            column = pa.array(texts, type=pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], column], names=[*names, "encoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return spectra.mapInArrow(batches, f"{fields}, encoded string")


def scan_xml(encoded: DataFrame, precision: int = 32, compressed: bool = False) -> DataFrame:
    """mzXML scan text from encoded spectra."""
    kind = ' compressionType="zlib"' if compressed else ""
    precursor = F.when(
        F.col("precursor_mz").isNotNull(),
        F.format_string(
            '<precursorMz precursorCharge="%d">%s</precursorMz>\n', F.col("charge"), F.col("precursor_mz").cast("string")
        ),
    ).otherwise("")
    text = F.concat(
        F.format_string(
            '<scan num="%d" msLevel="%d" peaksCount="%d">\n', F.col("scan_num"), F.col("ms_level"), F.col("peaks_count")
        ),
        precursor,
        F.lit(f'<peaks precision="{precision}" byteOrder="network"{kind} contentType="m/z-int">'),
        F.col("encoded"),
        F.lit("</peaks>\n</scan>\n"),
    )
    return encoded.select("scan_num", text.alias("scan_text"))


def mzxml_shards(scans: DataFrame, header: str, per_shard: int = SPECTRA_PER_BATCH, order: list[str] = ("scan_num",)) -> DataFrame:
    """Whole mzXML documents of at most ``per_shard`` scans, each with its own offset index."""
    numbered = index_rows(scans.select(*dict.fromkeys([*order, "scan_num", "scan_text"])), [F.col(c) for c in order], "_index")
    start = len(header.encode())
    end = "  </msRun>\n"
    shards = (
        numbered.withColumn("shard_id", F.floor(F.col("_index") / per_shard))
        .groupBy("shard_id")
        .agg(
            F.count("*").alias("n_scans"),
            F.array_sort(F.collect_list(F.struct("_index", "scan_num", "scan_text"))).alias("scans"),
        )
    )
    empty = F.array().cast("array<struct<scan_num:int,byte_offset:bigint>>")
    placed = F.aggregate(
        "scans",
        F.struct(F.lit(start).cast("bigint").alias("at"), empty.alias("seen")),
        lambda acc, s: F.struct(
            (acc["at"] + F.octet_length(s["scan_text"])).alias("at"),
            F.concat(acc["seen"], F.array(F.struct(s["scan_num"].alias("scan_num"), acc["at"].alias("byte_offset")))).alias("seen"),
        ),
    )
    placed_shards = shards.withColumn("placed", placed)
    body = F.array_join(F.transform("scans", lambda s: s["scan_text"]), "")
    text = F.concat(F.lit(header), body, F.lit(end))
    index_at = F.col("placed.at") + F.lit(len(end) + 4)
    return placed_shards.select(
        "shard_id",
        "n_scans",
        F.concat(text, index_block(F.col("placed.seen"), index_at, text)).alias("value"),
    )


def write_mzxml_shards(scans: DataFrame, path: str, header: str, per_shard: int = SPECTRA_PER_BATCH) -> None:
    """One file per shard."""
    shards = mzxml_shards(scans, header, per_shard)
    shards.select("value").write.mode("overwrite").option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)


def files_by_kind(spark: SparkSession, path: str, glob: str | None = None) -> dict[str, list[str]]:
    """The files of a path by kind, from the listing that every scan needs anyway; a file of neither kind raises."""
    kinds: dict[str, list[str]] = {}
    for file in text_reader(spark, "\n", glob).text(path).inputFiles():
        found = re.search(r"\.(mgf|mzxml)(?:\.gz)?$|\.(mgf|mzxml)/[^/]*$", file.lower())
        if not found:
            raise ValueError(f"neither an MGF nor an mzXML file: {file}")
        kinds.setdefault(found[1] or found[2], []).append(unquote(file))
    return kinds


def read_spectra(spark: SparkSession, path: str, glob: str | None = None, bad_lines: BadLines | None = None) -> DataFrame:
    """Spectra of all MGF and mzXML files of a path; each file is read once, by its own name, and any other raises.

    Nothing is read yet. Unreadable lines and damaged peak lists are counted by ``bad_lines`` as the rows are read. A
    spectrum is named by ``source_file`` and ``spectrum_id``.
    """
    kinds = files_by_kind(spark, path, glob)
    if not kinds:
        raise ValueError(f"no spectrum files in {path}")
    # one kind is read as the path says, two kinds are read by their own lists of files
    own = {kind: (path, glob) if len(kinds) == 1 else (files, None) for kind, files in kinds.items()}
    parts = []
    if "mgf" in kinds:
        parts.append(read_mgf(spark, *own["mgf"]))
    if "mzxml" in kinds:
        parts.append(
            decode_peaks(read_scans(spark, *own["mzxml"])).select(
                F.concat(F.lit("scan-"), F.col("scan_num").cast("string")).alias("spectrum_id"),
                F.lit(None).cast("string").alias("title"),
                "ms_level",
                "precursor_mz",
                "charge",
                "scan_num",
                "peaks",
                "bad_lines",
                "source_file",
            )
        )
    spectra = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return (bad_lines.counted(spectra) if bad_lines else spectra).drop("bad_lines")
