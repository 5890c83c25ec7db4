"""Registry, table access and the proteins and spectra derived from the tables."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spectrel.functions.fixed_values import AMINO_ACIDS, LENGTH_RANGE, MASS_RANGE, PROTON, WATER
from spectrel.functions.masses import MICRO, residue_table
from spectrel.operators.batching import at_least_partitions
from spectrel.plans.digest import digest, prefix_masses

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make the packages importable in Python workers, wherever the driver was started."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="spectrel-")) / "spectrel_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for package in ("spectrel", "catalog"):
            for source in sorted((root / package).rglob("*.py")):
                out.write(source, source.relative_to(root))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def query(name: str, sql: str | None = None):
    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table in one small file is one task; heavy row work needs more."""
    return at_least_partitions(df, df.sparkSession.sparkContext.defaultParallelism)


# ---- proteins ----------------------------------------------------------------


def amino_letters(text: str) -> Column:
    return F.regexp_replace(F.upper(F.regexp_replace(text, "[^A-Za-z]", "")), f"[^{AMINO_ACIDS}]", "")


def document_proteins(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(table(spark, sf, "documents").select("doc_id", "lang", "source", "text"))
    accession = F.concat(F.lit("sp|D"), F.lpad(F.col("doc_id").cast("string"), 8, "0"), F.lit("|"), F.col("lang"))
    return docs.select(accession.alias("accession"), F.col("source").alias("description"), amino_letters("text").alias("sequence"))


def benchmark_proteins(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "benchmark")
    accession = F.concat(F.lit("B"), F.lpad(F.col("item_id").cast("string"), 6, "0"))
    return items.select(accession.alias("accession"), F.lit("").alias("description"), amino_letters("text").alias("sequence"))


def _letters_sql(text: str) -> str:
    return f"regexp_replace(upper(regexp_replace({text},'[^A-Za-z]','','g')),'[^{AMINO_ACIDS}]','','g')"


PROTEIN_SQL = {
    "documents": f"""prot AS (SELECT concat('sp|D', lpad(doc_id::VARCHAR,8,'0'), '|', lang) AS accession,
        source AS description, {_letters_sql('text')} AS sequence FROM documents)""",
    "letters": """prot AS (SELECT concat('D', doc_id::VARCHAR) AS accession, '' AS description,
        upper(regexp_replace(text,'[^A-Za-z]','','g')) AS sequence FROM documents)""",
    "benchmark": f"""prot AS (SELECT concat('B', lpad(item_id::VARCHAR,6,'0')) AS accession,
        '' AS description, {_letters_sql('text')} AS sequence FROM benchmark)""",
}


def mass_sql(sequence: str, modified: bool = False) -> str:
    terms = [
        f"(length({sequence})-length(replace({sequence},'{r}','')))::BIGINT*{m}"
        for r, m in residue_table().items()
        if modified or r.isupper()
    ]
    return f"({'+'.join(terms)}+{WATER + PROTON})"


LOW, HIGH = int(MASS_RANGE[0] * MICRO), int(MASS_RANGE[1] * MICRO)


def digest_sql(source: str, missed: int = 2, prefix: str = "") -> str:
    """CTEs ending in ``pep``: the digest of a protein table."""
    runs, texts = [], ["piece", "piece||p1", "piece||p1||p2"]
    nexts = ["p1", "p2", "p3"]
    for k in range(missed + 1):
        where = f" WHERE p{k} IS NOT NULL" if k else ""
        runs.append(
            f"SELECT accession, {texts[k]} AS sequence, {k} AS missed, start, coalesce(right(before,1),'-') AS prev,"
            f" coalesce(left({nexts[k]},1),'-') AS next FROM placed{where}"
        )
    return f"""{PROTEIN_SQL[source]},
    parts AS (SELECT accession, list_filter(string_split(regexp_replace(regexp_replace(sequence,'([KR])','\\1|','g'),
        '\\|P','P','g'),'|'), lambda x: x <> '') AS l FROM prot),
    pieces AS (SELECT accession, unnest(l) AS piece, generate_subscripts(l,1) AS i FROM parts),
    placed AS (SELECT accession, piece,
        (1 + coalesce(sum(length(piece)) OVER (PARTITION BY accession ORDER BY i
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::INTEGER AS start,
        lag(piece) OVER w AS before, lead(piece,1) OVER w AS p1, lead(piece,2) OVER w AS p2, lead(piece,3) OVER w AS p3
        FROM pieces WINDOW w AS (PARTITION BY accession ORDER BY i)),
    runs AS ({' UNION ALL '.join(runs)}),
    pep AS (SELECT accession, sequence, mass_uda, missed, start, (start + length(sequence) - 1)::INTEGER AS "end", prev, next
        FROM (SELECT *, {mass_sql('sequence')} AS mass_uda FROM runs)
        WHERE mass_uda BETWEEN {LOW} AND {HIGH} AND length(sequence) BETWEEN {LENGTH_RANGE[0]} AND {LENGTH_RANGE[1]})"""


# ---- spectra -----------------------------------------------------------------

NOISE_PEAKS = 20


def benchmark_spectra(spark: SparkSession, sf: str) -> DataFrame:
    """One synthetic spectrum per distinct uncut peptide of the benchmark texts."""
    peptides = digest(benchmark_proteins(spark, sf), missed=0, places=False).select("sequence", "mass_uda").distinct()
    # few rows, but each costs a vector: keep them spread
    peptides = peptides.repartition(spark.sparkContext.defaultParallelism)
    peptides = peptides.withColumn("prefix", prefix_masses()).withColumn("charge", 2 + F.length("sequence") % 3)
    mass = F.col("mass_uda")
    weight = mass % 1000

    def peak(mz, intensity):
        return F.struct(mz.cast("double").alias("mz"), intensity.cast("double").alias("intensity"))

    def b(m, i):
        return peak((m + PROTON).cast("double") / 1e6, 100 + ((i + 1) * 37 + weight) % 900)

    def y(m, i):
        return peak((mass - m).cast("double") / 1e6, 100 + ((F.length("sequence") - i - 1) * 37 + weight) % 900)

    def noise(j):
        return peak(100 + (F.floor(mass / 1000) * 31 + j * 7919) % 1400, 1 + (mass + j * 13) % 50)

    peaks = F.concat(
        F.transform("prefix", b),
        F.transform("prefix", y),
        F.transform(F.sequence(F.lit(0), F.lit(NOISE_PEAKS - 1)), noise),
    )
    precursor = (mass + (F.col("charge") - 1) * PROTON).cast("double") / F.col("charge").cast("double") / 1e6
    return peptides.select(
        F.col("sequence").alias("spectrum_id"),
        F.col("sequence").alias("title"),
        F.lit(2).alias("ms_level"),
        precursor.alias("precursor_mz"),
        F.col("charge").cast("int").alias("charge"),
        F.lit(None).cast("int").alias("scan_num"),
        peaks.alias("peaks"),
        F.lit("").alias("source_file"),
    )


_CODES = ",".join(str(residue_table().get(chr(c), 0)) for c in range(128))


def prefix_sql(source: str, out: str, key: str = "sequence") -> str:
    """CTE of running masses (key, mass_uda, i from 1 to length - 1, m)."""
    return f"""{out} AS (SELECT sequence, mass_uda, i, m FROM (SELECT sequence, mass_uda, i,
        (sum(([{_CODES}]::BIGINT[])[ascii(substr(sequence, i, 1)) + 1]) OVER (PARTITION BY sequence ORDER BY i))::BIGINT AS m
        FROM (SELECT sequence, mass_uda, unnest(range(1, length(sequence) + 1))::INTEGER AS i FROM {source}))
        WHERE i < length(sequence))"""


def spectra_sql() -> str:
    """CTEs ending in ``spec`` (one row per spectrum) and ``peak`` (one row per peak)."""
    inner = digest_sql("benchmark", missed=0).replace("pep AS", "bpep AS").replace("prot AS", "bprot AS")
    inner = inner.replace("FROM prot)", "FROM bprot)").replace("parts", "bparts").replace("pieces", "bpieces")
    inner = inner.replace("placed", "bplaced").replace("runs", "bruns")
    return f"""{inner},
    uncut AS (SELECT DISTINCT sequence, mass_uda FROM bpep),
    {prefix_sql('uncut', 'bprefix')},
    spec AS (SELECT sequence AS spectrum_id, 2 AS ms_level, (2 + length(sequence) % 3)::INTEGER AS charge, mass_uda,
        (mass_uda + (1 + length(sequence) % 3) * {PROTON})::DOUBLE / (2 + length(sequence) % 3)::DOUBLE / 1000000.0::DOUBLE
            AS precursor_mz FROM uncut),
    peak AS (
        SELECT sequence AS spectrum_id, (m + {PROTON})::DOUBLE / 1000000.0::DOUBLE AS mz,
            (100 + (i * 37 + mass_uda % 1000) % 900)::DOUBLE AS intensity FROM bprefix
        UNION ALL
        SELECT sequence, (mass_uda - m)::DOUBLE / 1000000.0::DOUBLE,
            (100 + ((length(sequence) - i) * 37 + mass_uda % 1000) % 900)::DOUBLE FROM bprefix
        UNION ALL
        SELECT sequence, (100 + ((mass_uda // 1000) * 31 + j * 7919) % 1400)::DOUBLE, (1 + (mass_uda + j * 13) % 50)::DOUBLE
            FROM uncut, unnest(range({NOISE_PEAKS})) AS t(j))"""


# ---- spectra of the embeddings: 64 peaks each, whole numbers ------------------


def vector_spectra(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    peaks = F.transform(
        "embedding",
        lambda v, i: F.struct(
            (100 + 10 * (i + 1) + F.col("label")).cast("double").alias("mz"),
            F.floor(F.abs(v.cast("double")) * 1e6).cast("double").alias("intensity"),
        ),
    )
    return vectors.select(
        F.concat(F.lit("V"), F.col("vec_id").cast("string")).alias("spectrum_id"),
        F.lit(2).alias("ms_level"),
        (F.lit(400.5) + F.col("vec_id") % 100).alias("precursor_mz"),
        (2 + F.col("label") % 2).cast("int").alias("charge"),
        (F.col("vec_id") + 1).cast("int").alias("scan_num"),
        peaks.alias("peaks"),
    )


VECTOR_SQL = """vspec AS (SELECT concat('V', vec_id) AS spectrum_id, 2 AS ms_level, (400.5 + vec_id % 100)::DOUBLE AS precursor_mz,
        (2 + label % 2)::INTEGER AS charge, (vec_id + 1)::INTEGER AS scan_num, embedding, label FROM embeddings),
    vpeak AS (SELECT spectrum_id, scan_num, i::INTEGER AS i, (100 + 10 * i + label)::DOUBLE AS mz,
        floor(abs(v::DOUBLE) * 1000000.0::DOUBLE)::DOUBLE AS intensity
        FROM (SELECT spectrum_id, scan_num, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM vspec))"""
