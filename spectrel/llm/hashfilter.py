"""A filter of fixed size for the keys of a distributed table.

It never loses a key. It only spares later shuffles; when the table outgrows it, more rows pass it and the exact join
that follows it drops them, so results don't depend on its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 24


def key_filter(keys: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """Words of 64 bits with a set bit for each key of a bigint column: at most ``2**bits / 8`` bytes on the driver."""
    place = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    words = (
        keys.where(F.col(column).isNotNull())
        .groupBy(F.shiftright(place, 6).alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, CAST({column} & 63 AS INT))")).alias("set"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words["word"].to_numpy()] = words["set"].to_numpy()
    return out.view(np.uint64)


def passes(filter_words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys (any 64-bit integers) may be in the table."""
    keys = keys.view(np.uint64) if keys.dtype == np.int64 else keys
    place = keys & np.uint64(len(filter_words) * 64 - 1)
    return (filter_words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _rows(column: str, words, wanted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(column)
            hit = passes(words.value, keys.fill_null(0).to_numpy(zero_copy_only=False)) & keys.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(hit == wanted))

    return run


def split_by_keys(df: DataFrame, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose bigint ``column`` is surely not among ``keys`` (null is not), and those where it may be.

    Only the second part, about as large as what has a key, needs a join and its shuffle.
    """
    words = df.sparkSession.sparkContext.broadcast(key_filter(keys, column))
    return df.mapInArrow(_rows(column, words, False), df.schema), df.mapInArrow(_rows(column, words, True), df.schema)
