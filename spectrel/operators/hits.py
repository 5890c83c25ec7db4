"""Merging, ranking and sorting of scored hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import natural_order


def merge_hits(hits: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Set union of the hits of all documents: exact duplicates are kept once.

    The shuffle is on the whole hit, so the hits of one busy spectrum spread
    over all tasks, and copies are dropped before the shuffle as well.
    """
    return hits.dropDuplicates(columns) if columns else hits.distinct()


def top_hits(hits: DataFrame, key: list[str], score: str, ties: list[str], n: int = 5, rank: str = "hit_rank") -> DataFrame:
    """Best ``n`` hits per key, ranked from 1; ties in score go by the tie columns.

    Every task cuts its own rows to ``n`` per key before the shuffle.
    """
    order = [F.col(score).desc(), *[F.col(t).asc() for t in ties]]
    window = Window.partitionBy(*key).orderBy(*order)
    return hits.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def sort_hits(hits: DataFrame, key: str, then: list[str] | None = None, natural: bool = False) -> DataFrame:
    """Global order by key as text, or by number where the key is one."""
    keys = natural_order(key) if natural else [F.col(key)]
    return hits.orderBy(*keys, *[F.col(c) for c in then or []])


def choose_one(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """One value per key, always the same one: the first in the given order."""
    return df.groupBy(key).agg(F.min_by(F.col(value), F.struct(*order)).alias(value))
