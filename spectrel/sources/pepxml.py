"""pepXML source and sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import NUM_OUTPUT, PROTON
from ..functions.masses import MICRO, residue_table
from ..functions.text import escape_xml, extract_attr, extract_elements
from ..operators.hits import top_hits
from .text_files import read_delimited

FOOTER = " </msms_run_summary>\n</msms_pipeline_analysis>"


def header(**parameters) -> str:
    """Document start with the parameters of the job that writes it."""
    rows = "\n".join(f'  <parameter name="{k}" value="{v}"/>' for k, v in sorted(parameters.items()))
    return (
        '<?xml version="1.0" encoding="UTF-8"?>\n<msms_pipeline_analysis>\n <msms_run_summary>\n'
        f" <search_summary>\n{rows}\n </search_summary>"
    )


def _attribute(name: str, column: str, columns: list[str]) -> Column:
    """An attribute for a column that the hits may have; nothing where it is missing or null."""
    if column not in columns:
        return F.lit("")
    return F.coalesce(F.concat(F.lit(f' {name}="'), escape_xml(F.col(column).cast("string")), F.lit('"')), F.lit(""))


def _shown(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit("null"))


def _score(name: str, column: str, columns: list[str]) -> Column:
    if column not in columns:
        return F.lit("")
    return F.coalesce(F.concat(F.lit(f'<search_score name="{name}" value="'), F.col(column).cast("string"), F.lit('"/>')), F.lit(""))


def _sites(added: list[int] | None) -> Column:
    """Places (from 1) and masses of the modified residues of a peptide: small letters, or residues with a mark."""
    table = {r: m for r, m in residue_table().items()}
    text = F.col("peptide").cast("string")
    if added is None:
        masses = F.create_map(*[F.lit(x) for r, m in table.items() if r.islower() for x in (r, m)])
        letters = F.transform(F.split(text, ""), lambda r, i: F.struct((i + 1).alias("i"), r.alias("r")))
        small = F.filter(letters, lambda s: s["r"].between("a", "z") & (F.length(s["r"]) == 1))
        return F.transform(small, lambda s: F.struct(s["i"].alias("i"), F.element_at(masses, s["r"]).alias("m")))
    masses = F.create_map(*[F.lit(x) for r, m in table.items() if r.isupper() for x in (r, m)])
    extra = F.create_map(*[F.lit(x) for k, m in enumerate(added, start=1) for x in (str(k), m)])
    residues = F.regexp_extract_all(F.regexp_replace(text, "(^n[0-9])|(c[0-9]$)", ""), F.lit("[A-Z][0-9]?"), F.lit(0))
    cells = F.transform(
        residues,
        lambda r, i: F.struct((i + 1).alias("i"), (F.element_at(masses, F.left(r, F.lit(1))) + F.element_at(extra, F.substring(r, 2, 1))).alias("m"), (F.length(r) > 1).alias("on")),
    )
    return F.filter(cells, lambda s: s["on"])


def _modifications(added: list[int] | None = None) -> Column:
    """The modified residues of a peptide with their masses, and the additions at its ends."""
    sites = _sites(added)
    rows = F.transform(
        sites,
        lambda s: F.concat(
            F.lit('<mod_aminoacid_mass position="'), s["i"].cast("string"), F.lit('" mass="'),
            F.coalesce((s["m"] / MICRO).cast("decimal(20,6)").cast("string"), F.lit("0")), F.lit('"/>'),
        ),
    )
    ends = F.lit("")
    if added is not None:
        extra = F.create_map(*[F.lit(x) for k, m in enumerate(added, start=1) for x in (str(k), f"{m / MICRO:.6f}")])
        for name, pattern in (("mod_nterm_mass", "^n([0-9])"), ("mod_cterm_mass", "c([0-9])$")):
            value = F.element_at(extra, F.regexp_extract(F.col("peptide"), pattern, 1))
            ends = F.concat(ends, F.coalesce(F.concat(F.lit(f' {name}="'), value, F.lit('"')), F.lit("")))
    text = F.concat(F.lit("<modification_info"), ends, F.lit(">"), F.array_join(rows, ""), F.lit("</modification_info>"))
    # the sites are made once, and only where there is one
    some = F.col("peptide").cast("string").rlike("[a-z]") if added is None else (F.size(sites) > 0) | (ends != "")
    return F.when(some, text).otherwise("")


def query_text(hits: DataFrame, key: str = "spectrum_id", added: list[int] | None = None) -> DataFrame:
    """One ``spectrum_query`` element per spectrum, and per file where hits have ``source_file``, from its ranked hits.

    ``charge``, ``mass_uda``, ``expect``, ``n_proteins`` and ``other_proteins`` (an array) are written where the hits have
    them. A peptide is written in capitals; its modified residues follow as a list of places and masses. ``added`` has the
    masses of the marks of modified residues, in micro-daltons; without it these are small letters.
    """
    columns = hits.columns
    keys = [c for c in ("_frame", "source_file", key) if c in columns]
    mass = F.concat(F.lit(' calc_neutral_pep_mass="'), ((F.col("mass_uda") - PROTON) / MICRO).cast("decimal(20,6)").cast("string"), F.lit('"'))
    more = F.lit("")
    if "other_proteins" in columns:
        others = F.transform("other_proteins", lambda p: F.concat(F.lit('<alternative_protein protein="'), escape_xml(p), F.lit('"/>')))
        more = F.coalesce(F.array_join(others, ""), F.lit(""))
    hit = F.concat(
        F.lit('<search_hit hit_rank="'),
        _shown(F.col("hit_rank")),
        F.lit('" peptide="'),
        _shown(escape_xml(F.upper(F.col("peptide").cast("string") if added is None else F.regexp_replace("peptide", "[nc0-9]", "")))),
        F.lit('" protein="'),
        _shown(escape_xml(F.col("accession").cast("string"))),
        F.lit('"'),
        _attribute("assumed_charge", "charge", columns),
        _attribute("num_tot_proteins", "n_proteins", columns),
        F.coalesce(mass, F.lit("")) if "mass_uda" in columns else F.lit(""),
        F.lit(">"),
        more,
        _modifications(added),
        _score("xcorr", "xcorr", columns),
        _score("expect", "expect", columns),
        F.lit("</search_hit>"),
    )
    rows = F.array_sort(F.collect_list(F.struct(F.col("hit_rank").alias("r"), hit.alias("x"))))
    file = _attribute("source_file", "source_file", columns)
    return (
        hits.groupBy(*keys)
        .agg(rows.alias("_rows"))
        .select(
            *keys,
            F.concat(
                F.lit('<spectrum_query spectrum="'),
                escape_xml(F.col(key).cast("string")),
                F.lit('"'),
                file,
                F.lit(">\n<search_result>\n"),
                F.array_join(F.transform("_rows", lambda r: r["x"]), "\n"),
                F.lit("\n</search_result>\n</spectrum_query>"),
            ).alias("value"),
        )
    )


def write_pepxml(hits: DataFrame, path: str, n: int = NUM_OUTPUT, key: str = "spectrum_id", modifications: list | None = None, **parameters) -> None:
    """Best ``n`` hits per spectrum, sorted by spectrum, inside one document header and footer.

    ``modifications`` are those of the search, where it had several.
    """
    added = None if modifications is None else [m.added_uda for m in modifications]
    keys = [c for c in ("source_file", key) if c in hits.columns]
    ranked = top_hits(hits, keys, "xcorr", ["peptide", "accession"], n)
    # hits are put in order before they become text: texts are long, and a sort makes its rows twice, to sample them and to move them
    ends = hits.sparkSession.createDataFrame([(0,), (2,)], "_frame int")
    rows = ranked.withColumn("_frame", F.lit(1)).unionByName(ends, allowMissingColumns=True).repartitionByRange("_frame", *keys)
    top, frame = header(num_output_lines=n, **parameters), F.col("_frame")
    value = F.when(frame == 0, F.lit(top)).when(frame == 2, F.lit(FOOTER)).otherwise(F.col("value"))
    texts = query_text(rows, key, added).withColumn("value", value).sortWithinPartitions("_frame", *keys)
    texts.select("value").write.mode("overwrite").text(path)


def unescape_xml(text: Column) -> Column:
    for plain, entity in (("<", "&lt;"), (">", "&gt;"), ("'", "&apos;"), ('"', "&quot;"), ("&", "&amp;")):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """``spectrum_query`` elements with their spectrum; an unclosed one gives no row."""
    end = "</spectrum_query>"
    whole = F.concat(F.lit("<spectrum_query "), F.substring_index("value", end, 1), F.lit(end))
    return (
        read_delimited(spark, path, "<spectrum_query ")
        .where(F.col("value").contains(end))
        .select(whole.alias("query"), "source_file")
        .select(extract_attr("query", "spectrum").alias("spectrum_id"), "query", "source_file")
    )


def read_pepxml(spark: SparkSession, path: str) -> DataFrame:
    """One row per search hit; ``marked_peptide`` has its modified residues in small letters."""
    hits = read_queries(spark, path).select("spectrum_id", F.explode(extract_elements("query", "search_hit")).alias("hit_xml"))

    def score(name: str) -> Column:
        return F.regexp_extract("hit_xml", rf'(?s)<search_score[^>]*name="{name}"[^>]*value="([^"]*)"', 1).try_cast("double")

    peptide = unescape_xml(extract_attr("hit_xml", "peptide"))
    places = F.transform(
        F.regexp_extract_all(F.col("hit_xml"), F.lit(r'<mod_aminoacid_mass position="(\d+)"'), F.lit(1)), lambda p: p.try_cast("int")
    )
    marked = F.aggregate(places, peptide, lambda text, i: F.overlay(text, F.lower(F.substring(text, i, F.lit(1))), i, F.lit(1)))
    mass = F.regexp_extract("hit_xml", r'calc_neutral_pep_mass="([^"]*)"', 1).try_cast("decimal(20,6)")
    return hits.select(
        unescape_xml(F.col("spectrum_id")).alias("spectrum_id"),
        F.regexp_extract("hit_xml", r'assumed_charge="(\d+)"', 1).try_cast("int").alias("charge"),
        extract_attr("hit_xml", "hit_rank").try_cast("int").alias("hit_rank"),
        peptide.alias("peptide"),
        marked.alias("marked_peptide"),
        unescape_xml(extract_attr("hit_xml", "protein")).alias("accession"),
        score("xcorr").alias("xcorr"),
        score("expect").alias("expect"),
        ((mass * MICRO).cast("bigint") + PROTON).alias("mass_uda"),
        "hit_xml",
    )
