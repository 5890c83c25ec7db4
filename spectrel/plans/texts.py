"""Texts of Arrow columns as flat arrays of bytes, so that a batch is cut and marked without a Python string for each row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows and the place where each row begins, with the end of the last; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.string():
        column = column.cast(pa.string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    text = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return text, at - at[0]


def runs_of(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all runs that begin at ``starts``, one run after the other, and the place where each ends."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths), ends


def string_array(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Strings that lie one after the other in ``data``, by the place where each ends."""
    offsets = np.zeros(len(ends) + 1, np.int32)
    offsets[1:] = ends
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data, np.uint8)))


def cut_texts(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The strings from ``starts`` to ``ends`` of a flat text of ASCII letters."""
    places, until = runs_of(starts, ends - starts)
    return string_array(text[places], until)


def single_letters(codes: np.ndarray) -> pa.Array:
    return string_array(codes.astype(np.uint8), np.arange(1, len(codes) + 1))
