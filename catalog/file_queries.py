"""Sources and sinks: a table is written in a file format, read back and compared with the table.

The files go to a fresh folder under the shared folder of the session.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from spectrel.functions.text import fasta_record
from spectrel.operators import scans as sc
from spectrel.operators import batching
from spectrel.operators import stats as st
from spectrel.operators.batching import index_rows, index_within
from spectrel.operators.blocks import by_row_number
from spectrel.operators.hits import merge_hits, top_hits
from spectrel.operators.shared import new_path
from spectrel.sources import pepxml as px
from spectrel.sources import proteins as pr
from spectrel.sources import spectra as ss
from spectrel.sources import text_files as tf

from .core import PROTEIN_SQL, VECTOR_SQL, document_proteins, query, table, vector_spectra
from .search_queries import _TOP, lineitem_hits


def written(spark, name: str, df, suffix: str = "", **options) -> str:
    """A text folder holding the ``value`` column."""
    path = new_path(spark, name) + suffix
    writer = df.write
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.text(path)
    return path


# ---- FASTA -------------------------------------------------------------------


@query("fasta_scan", f"WITH {PROTEIN_SQL['documents']} SELECT accession, description, sequence FROM prot")
def fasta_scan(spark, sf):
    """Every file begins with a comment and an empty line, which are no record."""
    records = document_proteins(spark, sf).select(fasta_record("accession", "description", "sequence").alias("value"))
    path = new_path(spark, "fasta") + ".fasta"
    tf.write_framed_text(records.withColumn("k", F.col("value")), path, ["k"], "value", "; database of documents\n# version=1\n\n", "")
    return pr.read_proteins(spark, path).drop("source_file", "left_out")


@query(
    "fasta_shard_counts",
    f"""WITH {PROTEIN_SQL['documents']} SELECT count(*) AS n_records, count(DISTINCT accession) AS n_accessions, true AS within_limit,
    sum(length(sequence))::BIGINT AS residues FROM prot""",
)
def fasta_shard_counts(spark, sf):
    path = new_path(spark, "shards")
    pr.write_proteins(document_proteins(spark, sf), path, per_file=50)
    per_file = (
        pr.read_proteins(spark, path)
        .groupBy("source_file")
        .agg(F.count("*").alias("n"), F.collect_set("accession").alias("a"), F.sum(F.length("sequence")).alias("r"))
    )
    return per_file.agg(
        F.sum("n").alias("n_records"),
        F.sum(F.size("a")).alias("n_accessions"),
        (F.max("n") <= 50).alias("within_limit"),
        F.sum("r").alias("residues"),
    )


# ---- MGF ---------------------------------------------------------------------


def write_vectors_mgf(spark, sf) -> str:
    """MGF whose files begin with header lines, with a comment before each block and one inside those of charge 3."""
    blocks = ss.mgf_block(vector_spectra(spark, sf)).select(
        F.concat(
            F.lit("COM=run\nCHARGE=2+ and 3+\n# search parameters\n"),
            F.when(F.col("value").contains("CHARGE=3+"), F.replace("value", F.lit("CHARGE=3+\n"), F.lit("CHARGE=3+\nnot a peak\n"))).otherwise(
                F.col("value")
            ),
        ).alias("value")
    )
    return written(spark, "mgf", blocks, ".mgf")


@query(
    "mgf_scan",
    f"""WITH {VECTOR_SQL} SELECT s.spectrum_id, s.precursor_mz, s.charge, p.i - 1 AS pos, p.mz, p.intensity
    FROM vspec s JOIN vpeak p USING (spectrum_id)""",
)
def mgf_scan(spark, sf):
    spectra = ss.read_spectra(spark, write_vectors_mgf(spark, sf), bad_lines=ss.BadLines(1 << 40))
    rows = spectra.select("spectrum_id", "precursor_mz", "charge", F.posexplode("peaks").alias("pos", "p"))
    return rows.select("spectrum_id", "precursor_mz", "charge", "pos", "p.mz", "p.intensity")


@query(
    "bad_line_count",
    f"WITH {VECTOR_SQL} SELECT charge, count(*) AS n_spectra, (count(*) * (charge - 2))::BIGINT AS n_bad FROM vspec GROUP BY charge",
)
def bad_line_count(spark, sf):
    spectra = ss.read_mgf(spark, write_vectors_mgf(spark, sf))
    return spectra.groupBy("charge").agg(F.count("*").alias("n_spectra"), F.sum("bad_lines").alias("n_bad"))


# ---- mzXML -------------------------------------------------------------------

HEADER = '<?xml version="1.0"?>\n<mzXML>\n <msRun scanCount="0">\n'


def encoded_vectors(spark, sf, precision=32, compressed=False):
    spectra = vector_spectra(spark, sf).withColumn("peaks_count", F.size("peaks"))
    return ss.encode_peaks(spectra, precision, compressed)


def write_vectors_mzxml(spark, sf, precision=32, compressed=False) -> str:
    texts = ss.scan_xml(encoded_vectors(spark, sf, precision, compressed), precision, compressed)
    path = new_path(spark, "vectors") + ".mzXML"
    tf.write_framed_text(texts, path, ["scan_num"], "scan_text", HEADER, " </msRun>\n</mzXML>")
    return path


@query(
    "mzxml_scan",
    f"WITH {VECTOR_SQL} SELECT scan_num, ms_level, 64::INTEGER AS peaks_count, precursor_mz, charge, 32::INTEGER AS precision FROM vspec",
)
def mzxml_scan(spark, sf):
    return ss.read_scans(spark, write_vectors_mzxml(spark, sf)).select(
        "scan_num", "ms_level", "peaks_count", "precursor_mz", "charge", "precision"
    )


@query(
    "decode_peaks",
    f"""WITH {VECTOR_SQL}, a AS (SELECT scan_num, i - 1 AS pos, mz, intensity FROM vpeak)
    SELECT 'plain' AS form, scan_num, pos, mz::FLOAT::DOUBLE AS mz, intensity::FLOAT::DOUBLE AS intensity FROM a
    UNION ALL SELECT 'zlib', scan_num, pos, mz, intensity FROM a""",
)
def decode_peaks(spark, sf):
    out = None
    for form, precision, compressed in (("plain", 32, False), ("zlib", 64, True)):
        decoded = ss.read_spectra(spark, write_vectors_mzxml(spark, sf, precision, compressed))
        rows = decoded.select(F.lit(form).alias("form"), "scan_num", F.posexplode("peaks").alias("pos", "p"))
        rows = rows.select("form", "scan_num", "pos", "p.mz", "p.intensity")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "mzxml_header",
    f"SELECT ((count(*) + 99) // 100)::BIGINT AS n_files, '{HEADER.strip()}' AS header FROM embeddings",
)
def mzxml_header(spark, sf):
    headers = ss.read_mzxml_headers(spark, write_shards(spark, sf))
    return headers.groupBy(F.trim(F.regexp_replace("header", r"\s+$", "")).alias("header")).agg(F.count("*").alias("n_files"))


def write_shards(spark, sf) -> str:
    """The vector scans as indexed documents of 100 scans."""
    scans = ss.scan_xml(encoded_vectors(spark, sf))
    path = new_path(spark, "run") + ".mzXML"
    ss.write_mzxml_shards(scans, path, HEADER, per_shard=100)
    return path


@query(
    "scan_flatten_dedup",
    f"""WITH {VECTOR_SQL} SELECT scan_num, 1 + (scan_num % 2)::INTEGER AS ms_level, 'second' AS version FROM vspec WHERE scan_num % 5 = 0
    UNION ALL SELECT scan_num, 1 + (scan_num % 2)::INTEGER, 'first' FROM vspec WHERE scan_num % 5 <> 0""",
)
def scan_flatten_dedup(spark, sf):
    """Odd scans nest in the even scan before them; every fifth scan is there twice."""
    def scan(version, close):
        return F.concat(
            F.format_string('<scan num="%d"\n msLevel="%d">\n<note v="', F.col("scan_num"), 1 + F.col("scan_num") % 2),
            F.lit(f'{version}"/>\n'),
            F.when(F.col("scan_num") % 2 == 0, F.lit(close)).otherwise(F.lit("</scan>\n")),
        )

    spectra = vector_spectra(spark, sf)
    first = spectra.select(F.col("scan_num").alias("at"), scan("first", "").alias("text"))
    second = spectra.where("scan_num % 5 = 0").select((F.col("scan_num") + 10_000_000).alias("at"), scan("second", "").alias("text"))
    path = new_path(spark, "nested") + ".mzXML"
    tf.write_framed_text(first.unionByName(second), path, ["at"], "text", HEADER, "</msRun></mzXML>")
    # part files of one run: name the run, and order by part
    scans = ss.read_scans(spark, path).withColumn("block", F.struct("source_file", "block")).withColumn("source_file", F.lit("run"))
    return sc.last_of_each_scan(scans).select(
        "scan_num", "ms_level", F.regexp_extract("scan_text", 'note v="([a-z]+)"', 1).alias("version")
    )


@query(
    "mzxml_shards",
    f"""WITH {VECTOR_SQL}, n AS (SELECT row_number() OVER (ORDER BY scan_num) - 1 AS i, scan_num FROM vspec)
    SELECT i // 60 AS shard_id, count(*) AS n_scans, count(*) AS n_index, true AS offsets_right, true AS index_right FROM n GROUP BY 1""",
)
def mzxml_shards(spark, sf):
    shards = ss.mzxml_shards(ss.scan_xml(encoded_vectors(spark, sf)), HEADER, per_shard=60)
    entries = sc.parse_index(shards, "value", ["shard_id", "n_scans", "value"])
    at = F.substring("value", F.col("byte_offset").cast("int") + 1, F.lit(40))
    right = at.startswith(F.concat(F.lit('<scan num="'), F.col("scan_num").cast("string"), F.lit('"')))
    index_right = F.substring("value", F.col("index_offset").cast("int") + 1, F.lit(6)) == "<index"
    return entries.groupBy("shard_id", "n_scans").agg(
        F.count("*").alias("n_index"), F.every(right).alias("offsets_right"), F.every(index_right).alias("index_right")
    )


@query(
    "scan_offset_index",
    f"""WITH {VECTOR_SQL} SELECT scan_num, true AS same FROM vspec""",
)
def scan_offset_index(spark, sf):
    """Offsets computed from the chunks of each file against those in the file's own index."""
    path = write_shards(spark, sf)
    offsets = sc.chunk_offsets(ss.read_scan_chunks(spark, path), len("<scan "))
    ours = offsets.where(~ss.is_header_chunk()).select(
        "source_file",
        F.regexp_extract("value", r'^num="(\d+)"', 1).cast("int").alias("scan_num"),
        # a chunk begins after its mark
        (F.col("byte_offset") - len("<scan ")).alias("ours"),
    )
    lines = tf.read_lines(spark, path).where(F.col("value").contains("<offset "))
    theirs = lines.select(
        "source_file",
        F.regexp_extract("value", r'id="(\d+)"', 1).cast("int").alias("scan_num"),
        F.regexp_extract("value", r">(\d+)<", 1).cast("bigint").alias("theirs"),
    )
    return ours.join(theirs, ["source_file", "scan_num"]).select("scan_num", (F.col("ours") == F.col("theirs")).alias("same"))


@query(
    "scan_index_parse",
    """SELECT o_orderkey AS file_no, (i + 1)::INTEGER AS scan_num, o_orderkey * 10 + i AS byte_offset, o_custkey AS index_offset
    FROM orders, (VALUES (0), (1), (2)) AS t(i)""",
)
def scan_index_parse(spark, sf):
    orders = table(spark, sf, "orders")
    entries = F.transform(
        F.sequence(F.lit(0), F.lit(2)),
        lambda i: F.struct((i + 1).cast("int").alias("scan_num"), (F.col("o_orderkey") * 10 + i).alias("byte_offset")),
    )
    texts = orders.select(F.col("o_orderkey").alias("file_no"), sc.index_block(entries, F.col("o_custkey")).alias("text"))
    return sc.parse_index(texts, "text", ["file_no"])


@query(
    "repair_scan_tags",
    """WITH r AS (SELECT l_returnflag AS f, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
        row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS i FROM lineitem),
    t AS (SELECT f, i, CASE WHEN l_partkey % 3 = 0 THEN 'open' WHEN l_partkey % 3 = 1 THEN 'close' ELSE 'loc' END AS kind FROM r),
    p AS (SELECT *, last_value(CASE WHEN kind <> 'loc' THEN kind END IGNORE NULLS) OVER (PARTITION BY f ORDER BY i
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
        row_number() OVER (PARTITION BY f, kind ORDER BY i) AS k FROM t)
    SELECT f AS source_file, i AS place, 0::INTEGER AS sub_place, '</scan>' AS value FROM p WHERE kind = 'open' AND prev = 'open'
    UNION ALL SELECT f, i, CASE WHEN prev = 'open' THEN 1 ELSE 0 END::INTEGER, concat('<scan num="', i, '">') FROM p WHERE kind = 'open'
    UNION ALL SELECT f, i, 0, '</scan>' FROM p WHERE kind = 'close' AND coalesce(prev, '') <> 'close'
    UNION ALL SELECT f, i, 0, CASE WHEN k = 1 THEN '<mzXML  v="1">' ELSE '<mzXML xsi:schemaLocation="u r l" v="1">' END FROM p WHERE kind = 'loc'""",
)
def repair_scan_tags(spark, sf):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("source_file"), *order)
    rows = index_within(rows, ["source_file"], [F.col(c) for c in order], "i")
    kind = F.col("l_partkey") % 3
    line = (
        F.when(kind == 0, F.format_string('<scan num="%d">', F.col("i")))
        .when(kind == 1, F.lit("</scan>"))
        .otherwise(F.lit('<mzXML xsi:schemaLocation="u r l" v="1">'))
    )
    lines = by_row_number(rows.select("source_file", "i", line.alias("value")), "source_file", "i", rows=1000)
    return sc.repair_scan_tags(lines).select("source_file", "place", "sub_place", "value")


# ---- text --------------------------------------------------------------------


@query("delimited_scan", "SELECT page_id, md5(html) AS html FROM pages")
def delimited_scan(spark, sf):
    records = table(spark, sf, "pages").select(F.concat_ws("\t", F.col("page_id").cast("string"), "html").alias("value"))
    path = written(spark, "delimited", records, lineSep="\n%%RECORD%%\n")
    parts = F.split("value", "\t", 2)
    return tf.read_delimited(spark, path, "\n%%RECORD%%\n").select(
        parts[0].cast("bigint").alias("page_id"), F.md5(parts[1]).alias("html")
    )


@query(
    "whole_file_scan",
    "SELECT sum(length(html) + 1)::BIGINT AS n_chars, sum(len(regexp_extract_all(html, '<html')))::BIGINT AS n_pages, true AS all_named FROM pages",
)
def whole_file_scan(spark, sf):
    """Files of at most 20 pages, each read as one row."""
    path = written(spark, "whole", table(spark, sf, "pages").select(F.col("html").alias("value")), maxRecordsPerFile=20)
    files = tf.read_whole_files(spark, path, "*.txt")
    return files.agg(
        F.sum(F.length("text")).alias("n_chars"),
        F.sum(F.regexp_count("text", F.lit("<html"))).alias("n_pages"),
        F.every(F.col("file_name").endswith(".txt")).alias("all_named"),
    )


@query(
    "keyed_lines",
    """SELECT 'customers' AS key, c_name AS value FROM customer""",
)
def keyed_lines(spark, sf):
    path = written(spark, "lines", table(spark, sf, "customer").select(F.col("c_name").alias("value")))
    return batching.keyed_lines(tf.read_lines(spark, path), "customers")


@query(
    "size_table_scan",
    "SELECT p_size AS mass_bin, count(*) AS n FROM part GROUP BY 1",
)
def size_table_scan(spark, sf):
    counts = table(spark, sf, "part").groupBy("p_size").agg(F.count("*").alias("n"))
    good = counts.select(F.concat_ws("\t", "p_size", "n").alias("value"))
    bad = counts.select(F.concat_ws("\t", "p_size", "n", F.lit("x")).alias("value")).unionAll(counts.select(F.col("p_size").cast("string")))
    return tf.read_size_table(spark, written(spark, "sizes", good.unionAll(bad)))


@query(
    "size_table_write",
    """SELECT (row_number() OVER (ORDER BY p_size) - 1) AS line_no, concat(p_size, chr(9), n) AS value
    FROM (SELECT p_size, count(*) AS n FROM part GROUP BY 1)""",
)
def size_table_write(spark, sf):
    path = new_path(spark, "sizes")
    counts = table(spark, sf, "part").groupBy(F.col("p_size").alias("mass_bin")).agg(F.count("*").alias("n"))
    tf.write_size_table(counts, path)
    lines = index_rows(tf.read_lines(spark, path), ["source_file", "block", "place"], "line_no", unique=True)
    return lines.select("line_no", "value")


@query("bin_counter_scan", "SELECT p_partkey::INTEGER AS mz, p_size::BIGINT AS n FROM part WHERE p_size % 5 <> 0")
def bin_counter_scan(spark, sf):
    name = F.when(F.col("p_size") % 5 != 0, "Binning:MZ").otherwise("Other:MZ")
    counters = table(spark, sf, "part").select(
        F.concat(name, F.col("p_partkey").cast("string")).alias("name"), F.col("p_size").alias("value")
    )
    path = new_path(spark, "counters")
    tf.write_counters(counters, path)
    return tf.read_bin_counters(spark, path)


@query(
    "framed_text_write",
    """SELECT 0::BIGINT AS line_no, '<run>' AS value UNION ALL SELECT row_number() OVER (ORDER BY c_custkey), c_name FROM customer
    UNION ALL SELECT count(*) + 1, '</run>' FROM customer""",
)
def framed_text_write(spark, sf):
    path = new_path(spark, "framed")
    tf.write_framed_text(table(spark, sf, "customer"), path, ["c_custkey"], "c_name", "<run>", "</run>")
    lines = index_rows(tf.read_lines(spark, path), ["source_file", "block", "place"], "line_no", unique=True)
    return lines.select("line_no", "value")


@query(
    "scan_store_read",
    """SELECT l_orderkey, l_linenumber, l_partkey, floor(l_extendedprice / 10000)::INTEGER AS mass_bin FROM lineitem
    WHERE floor(l_extendedprice / 10000) BETWEEN 3 AND 5""",
)
def scan_store_read(spark, sf):
    path = new_path(spark, "store")
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.floor(F.col("l_extendedprice") / 10000).cast("int").alias("mass_bin")
    )
    tf.write_store(rows, path, then=["l_orderkey", "l_linenumber"])
    return tf.read_store(spark, path).where("mass_bin between 3 and 5")


# ---- pepXML ------------------------------------------------------------------

# Documents that only a later step reads; a part file is read by one task then, and there are as many as tasks that wrote.
ZIPPED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


@query("pepxml_roundtrip", f"WITH {_TOP} SELECT spectrum_id, hit_rank, peptide::VARCHAR AS peptide, accession::VARCHAR AS accession, xcorr FROM top")
def pepxml_roundtrip(spark, sf):
    path = new_path(spark, "pepxml")
    px.write_pepxml(merge_hits(lineitem_hits(spark, sf)), path)
    return px.read_pepxml(spark, path).select("spectrum_id", "hit_rank", "peptide", "accession", "xcorr")


@query(
    "pepxml_details",
    f"""WITH {_TOP} SELECT spectrum_id, (2 + l % 2)::INTEGER AS charge, hit_rank, upper(p) AS peptide, p AS marked_peptide,
        accession::VARCHAR AS accession, xcorr, xcorr / 7.0::DOUBLE AS expect, (l * 1000000)::BIGINT AS mass_uda
        FROM (SELECT *, peptide AS l, concat('AmK', repeat('mC', (peptide % 3)::INTEGER)) AS p FROM top)""",
)
def pepxml_details(spark, sf):
    """Charge, mass, modified residues and expect value go through the document."""
    path = new_path(spark, "pepxml")
    number = F.col("peptide")
    hits = merge_hits(lineitem_hits(spark, sf)).select(
        "spectrum_id", "accession", "xcorr", (2 + number % 2).cast("int").alias("charge"), (F.col("xcorr") / 7.0).alias("expect"),
        (number * 1000000).cast("bigint").alias("mass_uda"), F.lpad(number.cast("string"), 12, "0").alias("order"),
        F.concat(F.lit("AmK"), F.repeat(F.lit("mC"), (number % 3).cast("int"))).alias("peptide"),
    )
    ranked = top_hits(hits, ["spectrum_id"], "xcorr", ["order", "accession"], 5)
    texts = px.query_text(ranked).select("value")
    return px.read_pepxml(spark, written(spark, "queries", texts, **ZIPPED)).drop("hit_xml")


@query(
    "pepxml_scan",
    f"""WITH {_TOP} SELECT spectrum_id, count(*) AS n_hits, max(xcorr) AS best FROM top GROUP BY 1""",
)
def pepxml_scan(spark, sf):
    """Spectrum queries of documents; one that is cut off at the end of the file gives no row."""
    ranked = top_hits(merge_hits(lineitem_hits(spark, sf)), ["spectrum_id"], "xcorr", ["peptide", "accession"], 5)
    texts = px.query_text(ranked)
    broken = texts.select(F.replace("value", F.lit("</spectrum_query>"), F.lit("")).alias("value"))
    path = written(spark, "queries", texts.select("value").unionAll(broken))
    queries = px.read_queries(spark, path)
    score = F.transform(
        F.regexp_extract_all("query", F.lit('name="xcorr" value="([^"]*)"'), F.lit(1)), lambda v: v.cast("double")
    )
    return queries.select("spectrum_id", F.size(score).cast("bigint").alias("n_hits"), F.array_max(score).alias("best"))


@query(
    "marker_counts",
    f"""WITH {PROTEIN_SQL['documents']} SELECT count(*) AS n_proteins, 0::BIGINT AS n_queries,
    sum(1 + (length(sequence) + 79) // 80 + (CASE WHEN length(sequence) = 0 THEN 1 ELSE 0 END))::BIGINT AS n_lines FROM prot""",
)
def marker_counts(spark, sf):
    path = new_path(spark, "fasta")
    pr.write_proteins(document_proteins(spark, sf), path)
    per_file = st.marker_counts(spark, path, {"n_proteins": "^>", "n_queries": "<spectrum_query"})
    return per_file.agg(F.sum("n_proteins").alias("n_proteins"), F.sum("n_queries").alias("n_queries"), F.sum("n_lines").alias("n_lines"))


@query(
    "log_sequences",
    """SELECT DISTINCT upper(word) AS sequence FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) WHERE length(word) > 4""",
)
def log_sequences(spark, sf):
    words = table(spark, sf, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))
    verb = F.when(F.col("p_partkey") % 2 == 0, "  add Sequence ").otherwise("set Sequence ")
    lines = words.select(F.concat(verb, F.upper("word")).alias("value")).unionAll(
        words.select(F.concat(F.lit("other Sequence "), "word", F.lit("XX")).alias("value"))
    )
    return st.log_sequences(tf.read_lines(spark, written(spark, "log", lines)))
