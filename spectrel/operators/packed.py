"""Rows that travel together: the rows of a key in one task become one compressed row, which is what a shuffle moves."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Rows that a task holds before it packs them; the rows of a key among them become one row.
ROWS_HELD = 1_000_000
PACKED_AT_ONCE = 500

_WHOLE = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64()}


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length of each text (-1: null), where each begins and the last ends, and all bytes."""
    column = pa.concat_arrays([column.cast(pa.string())])
    whole = pc.fill_null(column, "")
    _, offsets, data = whole.buffers()
    at = np.frombuffer(offsets, np.int32)[whole.offset : whole.offset + len(whole) + 1].astype(np.int64)
    lengths = np.where(pc.is_null(column).to_numpy(zero_copy_only=False), -1, np.diff(at)).astype(np.int32)
    return lengths, at, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def pack(table: pa.Table, keys: list[str]) -> Iterator[pa.RecordBatch]:
    """One row for each key: its number of rows, and for each column some compressed parts.

    Texts are lengths and letters; numbers are their bytes, the first of all rows, then the second ... A column of numbers in
    order is kept as differences. Keys are whole numbers; rows of a key stay in their order.
    """
    columns = [table[k].to_numpy() for k in keys]
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    edge = np.logical_or.reduce([c[1:] != c[:-1] for c in columns]) if len(order) else np.zeros(0, bool)
    edges = np.concatenate([[0], np.flatnonzero(edge) + 1, [len(order)]])
    rows, zip_up = table.drop_columns(keys).take(pa.array(order)).combine_chunks(), pa.Codec("zstd").compress
    parts = []
    for column in rows.columns:
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
        if pa.types.is_string(column.type):
            parts.append((None, *_texts(column)))
        else:
            parts.append((pc.is_null(column).to_numpy(zero_copy_only=False) if column.null_count else None, pc.fill_null(column.cast(pa.int64()), 0).to_numpy()))

    def packed_row(s: int, e: int) -> list[bytes]:
        out = []
        for absent, first, *text in parts:
            if text:
                out += [zip_up(np.ascontiguousarray(first[s:e]), asbytes=True), zip_up(np.ascontiguousarray(text[1][text[0][s] : text[0][e]]), asbytes=True)]
            else:
                steps = np.diff(first[s:e], prepend=0)
                rising = bool((steps[1:] >= 0).all())
                planes = np.ascontiguousarray((steps if rising else first[s:e]).astype(np.int64)).view(np.uint8).reshape(-1, 8).T
                out += [bytes([rising]) + zip_up(planes.tobytes(), asbytes=True), b"" if absent is None else zip_up(absent[s:e].tobytes(), asbytes=True)]
        return out

    for a in range(0, len(edges) - 1 if len(order) else 0, PACKED_AT_ONCE):
        bounds = edges[a : a + PACKED_AT_ONCE + 1]
        values = pa.array([packed_row(s, e) for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.list_(pa.binary()))
        kinds = [pa.array(c[bounds[:-1]]) for c in columns]
        yield pa.RecordBatch.from_arrays([*kinds, pa.array(np.diff(bounds).astype(np.int32)), values], names=[*keys, "n_packed", "packed"])


def unpack(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """The rows of all packed rows, which have the columns of ``schema``."""
    unzip, sizes, values = pa.Codec("zstd").decompress, table["n_packed"].to_pylist(), table["packed"].to_pylist()

    def numbers(value: bytes, n: int) -> np.ndarray:
        whole = np.ascontiguousarray(np.frombuffer(unzip(value[1:], 8 * n, asbytes=True), np.uint8).reshape(8, n).T).view(np.int64).ravel()
        return np.cumsum(whole) if value[0] else whole

    columns = []
    for i, kind in enumerate(schema.types):
        first = [v[2 * i] for v in values]
        second = [v[2 * i + 1] for v in values]
        if pa.types.is_string(kind):
            lengths = [np.frombuffer(unzip(x, 4 * n, asbytes=True), np.int32) for x, n in zip(first, sizes)]
            text = b"".join(unzip(x, int(own.sum(where=own > 0)), asbytes=True) for x, own in zip(second, lengths))
            lengths = np.concatenate([np.zeros(0, np.int32), *lengths])
            ends = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])
            column = pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(text)).cast(kind)
            absent = lengths < 0
        else:
            column = pa.array(np.concatenate([np.zeros(0, np.int64), *[numbers(x, n) for x, n in zip(first, sizes)]])).cast(kind)
            absent = np.concatenate([np.zeros(0, bool), *[np.frombuffer(unzip(x, n, asbytes=True), bool) if x else np.zeros(n, bool) for x, n in zip(second, sizes)]])
        columns.append(pc.if_else(pa.array(absent), pa.scalar(None, kind), column) if absent.any() else column)
    return pa.Table.from_arrays(columns, schema=schema)


def packed(
    df: DataFrame,
    keys: list[str],
    combine: Callable[[pa.Table], pa.Table] | None = None,
    expand: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None,
    columns: list[str] | None = None,
    most: int = ROWS_HELD,
) -> tuple[DataFrame, pa.Schema]:
    """The rows of ``df`` (texts and whole numbers) as packed rows by ``keys`` (bigint, not null), and the schema for ``unpack``.

    ``combine`` may take rows of one key together before they travel; it keeps the columns. ``expand`` makes the rows and
    their keys from the batches of ``df``; ``columns`` names those of ``df`` that it leaves.
    """
    names = columns or [c for c in df.columns if c not in keys]
    schema = pa.schema([(f.name, pa.string() if isinstance(f.dataType, T.StringType) else _WHOLE[f.dataType.simpleString()]) for f in df.select(*names).schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            yield from pack(combine(table) if combine else table, keys)

        for batch in expand(batches) if expand else batches:
            held.append(batch)
            n += batch.num_rows
            if n >= most:
                yield from flush()
                held, n = [], 0
        if n:
            yield from flush()

    kinds = ", ".join([*[f"`{k}` bigint" for k in keys], "n_packed int, packed array<binary>"])
    return (df if expand else df.select(*keys, *names)).mapInArrow(run, kinds), schema
