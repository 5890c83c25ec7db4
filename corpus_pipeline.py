"""From raw documents to packed sequences: five stages, each of which sees what the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet and read again as the docs
of the next stage. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.core import table
from spectrel.llm.decontamination import contaminated_rows, full_items, row_name
from spectrel.llm.hashfilter import split_by_keys
from spectrel.llm.near_duplicates import duplicate_classes, with_nodes
from spectrel.llm.packing import pack
from spectrel.llm.quality import fit_quality, score_quality
from spectrel.llm.repeats import cut_repeats
from spectrel.llm.session import ready
from spectrel.operators.shared import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.3


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier scores below ``LEAST_SCORE``."""
    ready(spark)
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs.select(COLUMNS), model).where(F.col("score") >= LEAST_SCORE).select(COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that with the smallest id, of each class of near duplicates (similarity 0.8 or more).

    Rows that repeat an id are judged by their own texts: of those in one class one row stays, the first by node and then
    by all columns. Rows without id are never compared away, and rows without words are in no class.
    """
    ready(spark)
    classes = written(duplicate_classes(docs, percent=80).where("doc_id IS NOT NULL"), "classes")
    away = F.coalesce(F.col("doc_id") != F.col("component_id"), F.lit(False))
    ids = written(classes.groupBy("doc_id").agg(F.count("*").alias("rows"), F.count_if(away).alias("away")).where("rows > 1 OR away > 0"), "ids")
    gone, repeated = ids.where("away = rows").select("doc_id"), ids.where("away < rows").select("doc_id")
    clear, rest = split_by_keys(docs.select(COLUMNS), ids, "doc_id")
    rest = rest.join(gone, "doc_id", "left_anti")
    once = rest.join(repeated, "doc_id", "left_anti")
    told = with_nodes(rest.join(repeated, "doc_id", "left_semi"))
    stays = classes.join(repeated, "doc_id", "left_semi").where("doc_id = component_id").select("doc_id", "node", "root").distinct()
    first = told.join(stays, ["doc_id", "node"]).groupBy("doc_id", "root").agg(F.min(F.struct("node", *COLUMNS[1:])).alias("first"))
    wordless = told.where("node IS NULL").select(COLUMNS)
    return clear.unionByName(once).unionByName(first.select("doc_id", "first.*").select(COLUMNS)).unionByName(wordless)


def cut_repeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut strings of 50 bytes that a document with a smaller id holds as well; ``n_chars`` follows the text."""
    ready(spark)
    cut = cut_repeats(docs.select(COLUMNS))
    text = F.col("kept_text")
    return cut.select("doc_id", text.alias("text"), "rest.lang", "rest.source", F.length(text).cast("bigint").alias("n_chars"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that contain at least 0.8 of the shingles of a benchmark item.

    Items with fewer than five words ('yes', 'the answer') drop nothing, as clean documents hold them too;
    ``op6_benchmark_leaks`` reports them all the same.
    """
    ready(spark)
    items = full_items(table(spark, sf_dir, "benchmark"))
    found = written(contaminated_rows(docs, items).select("row").distinct(), "found")
    clear, rest = split_by_keys(docs.select(*COLUMNS, row_name().alias("row")), found, "row")
    return clear.unionByName(rest.join(found, "row", "left_anti")).select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 2048 tokens."""
    ready(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("repeats", cut_repeated),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Scores of a trained model, byte strings and token ids: SQL can't express the stages.
ORACLE_SQL = None
