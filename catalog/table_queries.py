"""Text, XML, binning, join, count, order and batch operators over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spectrel.functions import binning as bn
from spectrel.functions import masses as ms
from spectrel.functions import text as tx
from spectrel.operators import batching as ba
from spectrel.operators import hits as hi
from spectrel.operators import joins as jo
from spectrel.operators import scans as sc
from spectrel.operators import stats as st
from spectrel.sources.text_files import framed

from .core import PROTEIN_SQL, digest_sql, document_proteins, benchmark_proteins, query, spread, table
from spectrel.plans import digest as dg

# ---- projections and text ----------------------------------------------------


@query(
    "keyed_pairs",
    """SELECT o_custkey AS key, o_orderkey AS pair_key, o_totalprice AS pair_value, o_custkey::VARCHAR AS key_text FROM orders""",
)
def keyed_pairs(spark, sf):
    pairs = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("key"), F.struct(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v")).alias("pair")
    )
    return pairs.select(
        "key", F.col("pair.k").alias("pair_key"), F.col("pair.v").alias("pair_value"), F.col("key").cast("string").alias("key_text")
    )


@query(
    "tag_extract",
    r"""SELECT page_id, (i - 1)::INTEGER AS pos, element FROM (SELECT page_id, unnest(l) AS element, generate_subscripts(l, 1) AS i
    FROM (SELECT page_id, regexp_extract_all(html, '(?s)<li\b.*?</li>') AS l FROM pages))""",
)
def tag_extract(spark, sf):
    elements = tx.extract_elements(tx.require_closed("html", "li"), "li")
    return table(spark, sf, "pages").select("page_id", F.posexplode(elements).alias("pos", "element"))


def _attr_sql(name: str) -> str:
    exact = rf'(?:^|[^\w:.-]){name}="([^"]*)"'
    return f"""CASE WHEN regexp_matches(html, '{exact}') THEN regexp_extract(html, '{exact}', 1)
        WHEN regexp_matches(html, '(?i){exact}') THEN regexp_extract(html, '(?i){exact}', 1) END"""


@query(
    "attr_extract",
    f"""SELECT page_id, {_attr_sql('lang')} AS lang, {_attr_sql('HREF')} AS href, {_attr_sql('absent')} AS absent FROM pages""",
)
def attr_extract(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        tx.extract_attr("html", "lang", required=True).alias("lang"),
        tx.extract_attr("html", "HREF").alias("href"),
        tx.extract_attr("html", "absent").alias("absent"),
    )


@query(
    "attr_substitute",
    """SELECT page_id, md5(regexp_replace(html, '(?s)^(.*?href=")[^"]*"', '\\1/new"')) AS changed,
    md5(html) AS unchanged FROM pages""",
)
def attr_substitute(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        F.md5(tx.substitute_attr("html", "href", "/new")).alias("changed"),
        F.md5(tx.substitute_attr("html", "absent", "x")).alias("unchanged"),
    )


@query(
    "clean_xml",
    r"""SELECT doc_id, md5(c) AS cleaned, length(c)::BIGINT AS n FROM
    (SELECT doc_id, regexp_replace(text, '[\x00-\x1F\x7F-\x{9F}]', '', 'g') AS c FROM documents)""",
)
def clean_xml(spark, sf):
    cleaned = spread(table(spark, sf, "documents")).select("doc_id", tx.clean_xml("text").alias("c"))
    return cleaned.select("doc_id", F.md5("c").alias("cleaned"), F.length("c").cast("bigint").alias("n"))


_ESCAPED = "replace(replace(replace(replace(replace({0},'&','&amp;'),'<','&lt;'),'>','&gt;'),'''','&apos;'),'\"','&quot;')"


@query(
    "xml_escape",
    rf"""SELECT page_id, md5(array_to_string(list_transform(regexp_extract_all({_ESCAPED.format('html')}, '[\x20-\x{{FE}}]+|[^\x20-\x{{FE}}]'),
        lambda c: CASE WHEN regexp_matches(c, '^[\x20-\x{{FE}}]') THEN c ELSE concat('&#x', printf('%x', ascii(c)), ';') END), '')) AS escaped
    FROM pages""",
)
def xml_escape(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(tx.escape_xml("html")).alias("escaped"))


@query(
    "condition_label",
    r"""SELECT doc_id, md5(translate(regexp_replace(concat(source, '|', text), '[^\x20-\x7E]', '', 'g'), '|"''!;:,', '_      ')) AS label
    FROM documents""",
)
def condition_label(spark, sf):
    label = tx.condition_label(F.concat_ws("|", "source", "text"))
    return spread(table(spark, sf, "documents")).select("doc_id", F.md5(label).alias("label"))


@query(
    "ambiguous_seq_filter",
    r"""SELECT p_partkey, word FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)
    WHERE regexp_matches(upper(word), '[^ACDEFGHIKLMNPQRSTVWY]')""",
)
def ambiguous_seq_filter(spark, sf):
    words = table(spark, sf, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))
    return words.where(tx.is_ambiguous("word"))


_PREFIXES = ["", "###REV###", "###RND###", "RND_", "REV_", "REV1_", "DECOY_"]


@query(
    "decoy_label",
    """WITH l AS (SELECT c_custkey, concat((['', '###REV###', '###RND###', 'RND_', 'REV_', 'REV1_', 'DECOY_'])[c_custkey % 7 + 1], c_name)
        AS label FROM customer)
    SELECT c_custkey, CASE WHEN starts_with(label, 'DECOY_') THEN label WHEN c_custkey % 7 = 0 THEN NULL
        ELSE concat('DECOY_', substr(label, strpos(label, 'Customer'))) END AS decoy FROM l""",
)
def decoy_label(spark, sf):
    prefix = F.get(F.array(*[F.lit(p) for p in _PREFIXES]), (F.col("c_custkey") % 7).cast("int"))
    labels = table(spark, sf, "customer").select("c_custkey", F.concat(prefix, F.col("c_name")).alias("label"))
    return labels.select("c_custkey", tx.decoy_label("label").alias("decoy"))


@query(
    "alpha_id",
    """SELECT o_orderkey AS k, lpad(o_orderkey::VARCHAR, greatest(8, length(o_orderkey::VARCHAR))::INTEGER, '0') AS id FROM orders
    UNION ALL SELECT c_custkey, trim(concat('  ', c_name, ' ')) FROM customer""",
)
def alpha_id(spark, sf):
    numbers = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderkey").cast("string").alias("v"))
    names = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("v"))
    return numbers.unionByName(names).select("k", tx.alphabetical_id("v").alias("id"))


@query(
    "natural_sort",
    """SELECT v, row_number() OVER (ORDER BY try_cast(v AS BIGINT) NULLS LAST, v) - 1 AS place
    FROM (SELECT o_orderkey::VARCHAR AS v FROM orders UNION SELECT c_name FROM customer)""",
)
def natural_sort(spark, sf):
    numbers = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("v"))
    names = table(spark, sf, "customer").select(F.col("c_name").alias("v"))
    return ba.index_rows(numbers.unionByName(names).distinct(), tx.natural_order("v"), "place")


@query(
    "fasta_wrap",
    f"""WITH {PROTEIN_SQL['documents']} SELECT accession, md5(concat('>', accession, ' ', description, chr(10),
        rtrim(regexp_replace(sequence, '(.{{80}})', '\\1' || chr(10), 'g'), chr(10)))) AS record FROM prot""",
)
def fasta_wrap(spark, sf):
    return document_proteins(spark, sf).select(
        "accession", F.md5(tx.fasta_record("accession", "description", "sequence")).alias("record")
    )


@query(
    "mass_shift",
    """SELECT p_partkey, p_retailprice + 19.0178::DOUBLE AS matching, p_retailprice - 19.0178::DOUBLE AS plain FROM part""",
)
def mass_shift(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", ms.matching_mass("p_retailprice").alias("matching"), ms.mass_from_matching("p_retailprice").alias("plain")
    )


@query(
    "tolerance_filter",
    """SELECT l_returnflag, count(*) FILTER (abs(l_discount - l_tax) < 0.0001::DOUBLE) AS n_equal,
    count(*) FILTER (abs(l_discount - l_tax) < 0.025::DOUBLE) AS n_near,
    count(*) FILTER (abs(l_quantity - l_discount * 500) < greatest(abs(l_quantity), abs(l_discount * 500), 0.01::DOUBLE) / 300) AS n_close,
    count(*) FILTER (abs(l_extendedprice - trunc(l_extendedprice)) < 0.00001::DOUBLE) AS n_whole FROM lineitem GROUP BY l_returnflag""",
)
def tolerance_filter(spark, sf):
    rows = table(spark, sf, "lineitem")
    return rows.groupBy("l_returnflag").agg(
        F.count_if(ms.within("l_discount", "l_tax")).alias("n_equal"),
        F.count_if(ms.within("l_discount", "l_tax", 0.025)).alias("n_near"),
        F.count_if(ms.close_to("l_quantity", F.col("l_discount") * 500)).alias("n_close"),
        F.count_if(ms.near_integer("l_extendedprice")).alias("n_whole"),
    )


_SPACE_SQL = r"[\x{00}-\x{20}\x{7F}-\x{9F}\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}]"


@query(
    "equal_except_space",
    f"""SELECT doc_id, a = b AS same_spaced, a = regexp_replace(substr(text, 2), '{_SPACE_SQL}', '', 'g') AS same_cut, length(a)::BIGINT AS n
    FROM (SELECT doc_id, text, regexp_replace(text, '{_SPACE_SQL}', '', 'g') AS a,
        regexp_replace(replace(text, ' ', concat(' ', chr(10), chr(9))), '{_SPACE_SQL}', '', 'g') AS b FROM documents)""",
)
def equal_except_space(spark, sf):
    docs = spread(table(spark, sf, "documents"))
    spaced = F.replace("text", F.lit(" "), F.lit(" \n\t"))
    return docs.select(
        "doc_id",
        tx.equal_except_space("text", spaced).alias("same_spaced"),
        tx.equal_except_space("text", F.substring("text", F.lit(2), F.length("text"))).alias("same_cut"),
        F.length(tx.printing_only("text")).cast("bigint").alias("n"),
    )


@query(
    "mgf_fields",
    """SELECT event_id, value AS pep_mass, CASE WHEN event_id % 2 = 0 THEN concat('spot', user_id) ELSE concat(event_type, ' plain') END AS title
    FROM events""",
)
def mgf_fields(spark, sf):
    even = F.col("event_id") % 2 == 0
    mass_line = F.concat(F.lit("PEPMASS="), F.col("value").cast("string"), F.when(even, "\t").otherwise(" "), F.lit("8795.77"))
    title_line = F.when(even, F.concat(F.lit("TITLE=Label: x, Spot_Id: spot"), F.col("user_id").cast("string"), F.lit(", Run: 1"))).otherwise(
        F.concat(F.lit("TITLE="), F.col("event_type"), F.lit(" plain"))
    )
    return table(spark, sf, "events").select(
        "event_id", tx.pep_mass(mass_line).alias("pep_mass"), tx.mgf_title(title_line).alias("title")
    )


@query(
    "kv_comment_map",
    """SELECT p_partkey, p_name AS name, p_brand AS brand, p_size::VARCHAR AS size, NULL::VARCHAR AS absent FROM part""",
)
def kv_comment_map(spark, sf):
    line = F.format_string('Comment: Name="%s" Size=%d Brand=old Brand=%s', F.col("p_name"), F.col("p_size"), F.col("p_brand"))
    pairs = table(spark, sf, "part").select("p_partkey", tx.comment_map(line).alias("m"))
    return pairs.select(
        "p_partkey",
        F.regexp_replace(F.try_element_at("m", F.lit("Name")), '^"|"$', "").alias("name"),
        F.try_element_at("m", F.lit("Brand")).alias("brand"),
        F.try_element_at("m", F.lit("Size")).alias("size"),
        F.try_element_at("m", F.lit("Absent")).alias("absent"),
    )


@query("ms_level_filter", "SELECT event_id, user_id, value FROM events WHERE event_id % 3 + 1 = 2")
def ms_level_filter(spark, sf):
    scans = table(spark, sf, "events").withColumn("ms_level", F.col("event_id") % 3 + 1)
    return scans.where("ms_level = 2").select("event_id", "user_id", "value")


# ---- binning -----------------------------------------------------------------

_BIN = "least(floor((value - {lo}::DOUBLE) / 2.5::DOUBLE)::INTEGER, {n} - 1)"


@query(
    "linear_bin",
    f"""SELECT event_id, CASE WHEN value < 5 THEN 0 WHEN value > 30 THEN 9 ELSE {_BIN.format(lo='5.0', n=10)} END::INTEGER AS bin,
    CASE WHEN value < 5 OR value > 30 THEN -1 ELSE {_BIN.format(lo='5.0', n=10)} END::INTEGER AS strict_bin FROM events""",
)
def linear_bin(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        bn.linear_bin("value", 30.0, 2.5, 5.0).alias("bin"),
        bn.linear_bin("value", 30.0, 2.5, 5.0, overflow=False).alias("strict_bin"),
    )


@query(
    "linear_bin_label",
    f"""WITH b AS (SELECT event_id, CASE WHEN value < 5 OR value > 30 THEN -1 ELSE {_BIN.format(lo='5.0', n=10)} END AS bin FROM events)
    SELECT event_id, CASE WHEN bin >= 0 THEN printf('%.3f-%.3f', 5.0::DOUBLE + bin * 2.5::DOUBLE, 5.0::DOUBLE + bin * 2.5::DOUBLE + 2.5::DOUBLE) END AS label FROM b""",
)
def linear_bin_label(spark, sf):
    return table(spark, sf, "events").select("event_id", bn.bin_label("value", 30.0, 2.5, 5.0, overflow=False).alias("label"))


@query(
    "bin_midpoint",
    f"""WITH b AS (SELECT CASE WHEN value < 5 THEN 0 WHEN value > 30 THEN 9 ELSE {_BIN.format(lo='5.0', n=10)} END AS bin FROM events)
    SELECT (5.0::DOUBLE + bin * 2.5::DOUBLE + 1.25::DOUBLE)::DOUBLE AS middle, count(*) AS n FROM b GROUP BY 1""",
)
def bin_midpoint(spark, sf):
    bins = table(spark, sf, "events").select(bn.linear_bin("value", 30.0, 2.5, 5.0).alias("bin"))
    return bins.groupBy(bn.bin_midpoint("bin", 30.0, 2.5, 5.0).alias("middle")).agg(F.count("*").alias("n"))


@query(
    "half_offset_bin",
    f"""SELECT CASE WHEN value < 3.75 THEN 0 WHEN value > 30 THEN 10 ELSE {_BIN.format(lo='3.75', n=11)} END::INTEGER AS bin, count(*) AS n
    FROM events GROUP BY 1""",
)
def half_offset_bin(spark, sf):
    return table(spark, sf, "events").groupBy(bn.half_offset_bin("value", 30.0, 2.5, 5.0).alias("bin")).agg(F.count("*").alias("n"))


@query(
    "wide_bins",
    """WITH b AS (SELECT least(floor(l_extendedprice / 1000.0::DOUBLE)::INTEGER, 119) AS bin FROM lineitem)
    SELECT (bin + d)::INTEGER AS bin, count(*) AS n FROM b, (VALUES (-1),(0),(1)) AS t(d) GROUP BY 1""",
)
def wide_bins(spark, sf):
    # counting before the three-fold expansion leaves one row per bin to expand
    counts = table(spark, sf, "lineitem").groupBy(bn.linear_bin("l_extendedprice", 120000.0, 1000.0).alias("b")).agg(F.count("*").alias("c"))
    return counts.select(F.explode(bn.wide_bins("b")).alias("bin"), "c").groupBy("bin").agg(F.sum("c").alias("n"))


@query(
    "mass_bin_name",
    """SELECT p_partkey, printf('M%06d.peptide', trunc(p_retailprice)::INTEGER) AS name, trunc(p_retailprice)::INTEGER AS mass FROM part""",
)
def mass_bin_name(spark, sf):
    named = table(spark, sf, "part").select("p_partkey", bn.mass_bin_name("p_retailprice").alias("name"))
    return named.withColumn("mass", bn.mass_of_bin_name("name"))


# ---- joins -------------------------------------------------------------------


@query(
    "key_difference",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)",
)
def key_difference(spark, sf):
    mine = table(spark, sf, "events").select(F.col("user_id").alias("c_custkey"))
    return jo.key_difference(mine, table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey")


@query(
    "key_common",
    """SELECT 'events' AS side, user_id AS k, count(*) AS n FROM events WHERE user_id IN (SELECT o_custkey FROM orders) GROUP BY 2
    UNION ALL SELECT 'orders', o_custkey, count(*) FROM orders WHERE o_custkey IN (SELECT user_id FROM events) GROUP BY 2""",
)
def key_common(spark, sf):
    a = table(spark, sf, "events").select(F.col("user_id").alias("k"))
    b = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    left, right = jo.key_common(a, b, "k")
    sides = left.select(F.lit("events").alias("side"), "k").unionByName(right.select(F.lit("orders").alias("side"), "k"))
    return sides.groupBy("side", "k").agg(F.count("*").alias("n"))


@query(
    "prefix_lookup",
    f"""WITH {digest_sql('benchmark')}, w AS (SELECT DISTINCT sequence, mass_uda // 1000000 AS mass_bin FROM pep)
    SELECT w.sequence AS word, w.mass_bin, q.sequence AS prefix FROM w JOIN w q ON starts_with(w.sequence, q.sequence)""",
)
def prefix_lookup(spark, sf):
    words = dg.digest(benchmark_proteins(spark, sf), places=False).select(
        F.col("sequence").alias("word"), F.floor(F.col("mass_uda") / 1_000_000).alias("mass_bin")
    ).distinct()
    return jo.prefix_lookup(words, words.select(F.col("word").alias("prefix")), "word", "prefix")


@query(
    "pair_counts",
    """SELECT k, a.n AS n_left, b.n AS n_right, (a.n * b.n)::BIGINT AS n_pairs FROM
    (SELECT l_suppkey AS k, count(*) AS n FROM lineitem GROUP BY 1) a JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) b USING (k)""",
)
def pair_counts(spark, sf):
    a = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("k"))
    return jo.pair_counts(a, table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), "k")


@query(
    "table_equal",
    """SELECT 'customer' AS name, 0::BIGINT AS n_unequal, true AS is_equal
    UNION ALL SELECT 'changed', (SELECT count(*) FROM customer WHERE c_custkey % 10 = 0 OR c_custkey % 10 = 1), false""",
)
def table_equal(spark, sf):
    a = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    changed = a.where("c_custkey % 10 <> 1").withColumn(
        "c_acctbal", F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal"))
    )
    same = jo.tables_equal(a, a, "c_custkey", "c_acctbal").select(F.lit("customer").alias("name"), "*")
    return same.unionByName(jo.tables_equal(a, changed, "c_custkey", "c_acctbal").select(F.lit("changed").alias("name"), "*"))


# ---- aggregates --------------------------------------------------------------


@query(
    "group_to_list",
    """WITH r AS (SELECT l_suppkey, l_partkey,
        (row_number() OVER (PARTITION BY l_suppkey ORDER BY l_partkey) - 1) // 100 AS part_no FROM lineitem)
    SELECT l_suppkey, part_no, string_agg(l_partkey::VARCHAR, ',' ORDER BY l_partkey) AS items FROM r GROUP BY 1, 2""",
)
def group_to_list(spark, sf):
    lists = ba.group_to_lists(table(spark, sf, "lineitem"), "l_suppkey", "l_partkey", max_len=100)
    return lists.withColumn("items", F.array_join("items", ","))


@query(
    "choose_one",
    """SELECT l_orderkey, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS r FROM lineitem)
    WHERE r = 1""",
)
def choose_one(spark, sf):
    return hi.choose_one(table(spark, sf, "lineitem"), "l_orderkey", "l_partkey", ["l_linenumber", "l_partkey"])


@query(
    "top_counts",
    "SELECT l_partkey, count(*) AS n_rows FROM lineitem GROUP BY 1 ORDER BY n_rows DESC, l_partkey LIMIT 10",
)
def top_counts(spark, sf):
    return st.top_counts(table(spark, sf, "lineitem"), "l_partkey", 10)


@query(
    "key_skew",
    "SELECT l_orderkey % 16 AS bucket, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_keys FROM lineitem GROUP BY 1",
)
def key_skew(spark, sf):
    return st.key_skew(table(spark, sf, "lineitem"), "l_orderkey", 16)


@query(
    "row_counts",
    """SELECT 'lineitem' AS label, count(*) AS n_rows FROM lineitem UNION ALL SELECT 'documents', count(*) FROM documents
    UNION ALL SELECT 'pages', count(*) FROM pages""",
)
def row_counts(spark, sf):
    first, *others = [st.row_count(table(spark, sf, t), t) for t in ("lineitem", "documents", "pages")]
    for other in others:
        first = first.unionByName(other)
    return first


@query(
    "bin_size_stats",
    """SELECT sum(n)::BIGINT AS total, max(n) AS largest FROM
    (SELECT least(floor(l_extendedprice / 1000.0::DOUBLE)::INTEGER, 119) AS bin, count(*) AS n FROM lineitem GROUP BY 1)""",
)
def bin_size_stats(spark, sf):
    bins = bn.linear_bin("l_extendedprice", 120000.0, 1000.0).alias("bin")
    return st.bin_size_stats(table(spark, sf, "lineitem").groupBy(bins).agg(F.count("*").alias("n")))


@query(
    "run_statistics",
    """WITH c AS (SELECT (SELECT count(*) FROM part) AS p, (SELECT count(*) FROM orders) AS s)
    SELECT p AS n_proteins, s AS n_spectra, 1 + p // 2000 AS protein_batches, 1 + s // 500 AS spectra_batches,
    (1 + p // 2000) * (1 + s // 500) AS calls, p * s // 1000000 AS comparisons_millions FROM c""",
)
def run_statistics(spark, sf):
    return st.run_statistics(table(spark, sf, "part"), table(spark, sf, "orders"))


@query(
    "tag_histogram",
    """SELECT tag, count(*) AS n FROM (SELECT unnest(regexp_extract_all(html, '<([A-Za-z][A-Za-z0-9_:.-]*)', 1)) AS tag FROM pages) GROUP BY tag""",
)
def tag_histogram(spark, sf):
    return st.tag_histogram(table(spark, sf, "pages"), "html")


_GROUPS = {"error": "org.apache.hadoop.mapred.Task$Counter", "view": "org.apache.hadoop.mapred.JobInProgress$Counter"}


@query(
    "counter_rollup",
    """SELECT CASE WHEN event_type IN ('error', 'view') THEN concat('user', user_id) ELSE concat(event_type, ':user', user_id) END AS counter,
    sum(event_id)::BIGINT AS total FROM events GROUP BY 1""",
)
def counter_rollup(spark, sf):
    group = F.col("event_type")
    named = F.when(group == "error", _GROUPS["error"]).when(group == "view", _GROUPS["view"]).otherwise(group)
    counters = table(spark, sf, "events").select(
        named.alias("grp"), F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("name"), "event_id"
    )
    return st.counter_rollup(counters, "grp", "name", "event_id")


# ---- order, sample, numbering ------------------------------------------------

_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query(
    "index_by_order",
    f"SELECT {', '.join(_LINE)}, row_number() OVER (ORDER BY {', '.join(_LINE)}) - 1 AS row_index FROM lineitem",
)
def index_by_order(spark, sf):
    return ba.index_rows(table(spark, sf, "lineitem").select(*_LINE), [F.col(c) for c in _LINE])


@query("first_n", f"SELECT {', '.join(_LINE)} FROM lineitem ORDER BY l_extendedprice DESC, {', '.join(_LINE)} LIMIT 100")
def first_n(spark, sf):
    order = [F.desc("l_extendedprice"), *[F.col(c) for c in _LINE]]
    return ba.first_n(table(spark, sf, "lineitem").select(*_LINE), order, 100)


@query(
    "sample_fraction",
    """SELECT o_orderkey, o_custkey FROM orders
    WHERE (o_orderkey % 2147483648 * 2654435761) % 4294967296 < 429496729""",
)
def sample_fraction(spark, sf):
    return ba.sample_fraction(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 0.1)


def lineitem_scans(spark, sf):
    """Line items as scans of three files; the part number serves as scan number, with many repeats."""
    return table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("source_file"),
        F.col("l_partkey").alias("scan_num"),
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_extendedprice",
    )


_SCAN_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]


@query(
    "renumber_scans",
    """WITH s AS (SELECT l_returnflag AS source_file, l_partkey AS scan_num, l_orderkey, l_linenumber, l_suppkey, l_extendedprice,
        row_number() OVER (PARTITION BY l_returnflag, l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS r FROM lineitem),
    m AS (SELECT source_file, greatest(max(scan_num), 9999) AS top FROM s GROUP BY 1)
    SELECT s.source_file, scan_num, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, scan_num AS new_num FROM s WHERE r = 1
    UNION ALL SELECT s.source_file, scan_num, l_orderkey, l_linenumber, l_suppkey, l_extendedprice,
        top + row_number() OVER (PARTITION BY s.source_file ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice)
        FROM s JOIN m ON s.source_file = m.source_file WHERE r > 1""",
)
def renumber_scans(spark, sf):
    return sc.renumber_scans(lineitem_scans(spark, sf), _SCAN_ORDER)


@query(
    "head_scans",
    """SELECT source_file, scan_num, l_orderkey, l_linenumber FROM (SELECT l_returnflag AS source_file, l_partkey AS scan_num, l_orderkey, l_linenumber,
    row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_partkey) AS r FROM lineitem) WHERE r <= 50""",
)
def head_scans(spark, sf):
    heads = sc.head_scans(lineitem_scans(spark, sf), 50, [*_SCAN_ORDER, "scan_num"])
    return heads.select("source_file", "scan_num", "l_orderkey", "l_linenumber")


@query(
    "batch_rows",
    """WITH i AS (SELECT c_name, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer)
    SELECT i // 500 AS batch_id, count(*) AS n_rows, string_agg(c_name, chr(10) ORDER BY i) AS text FROM i GROUP BY 1""",
)
def batch_rows(spark, sf):
    return ba.batch_rows(table(spark, sf, "customer"), [F.col("c_custkey")], 500, "c_name")


@query("balanced_partitions", "SELECT 16::BIGINT AS n_partitions, count(*) AS n_rows, true AS balanced FROM lineitem")
def balanced_partitions(spark, sf):
    spreadout = ba.guarantee_partitions(table(spark, sf, "lineitem"), 16)
    sizes = spreadout.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("n"))
    return sizes.agg(
        F.count("*").alias("n_partitions"), F.sum("n").alias("n_rows"), (F.max("n") <= F.avg("n") * 1.25).alias("balanced")
    )


@query(
    "pairs_to_map",
    """WITH i AS (SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) - 1 AS i FROM part)
    SELECT i // 1000 AS map_no, count(*) AS n, string_agg(concat(p_partkey, '=', p_name), ',' ORDER BY p_partkey) AS entries FROM i GROUP BY 1""",
)
def pairs_to_map(spark, sf):
    maps = ba.pairs_to_maps(table(spark, sf, "part").select("p_partkey", "p_name"), "p_partkey", "p_name")
    entries = F.transform(F.array_sort(F.map_entries("pairs")), lambda e: F.concat_ws("=", e["key"].cast("string"), e["value"]))
    return maps.select("map_no", F.size("pairs").cast("bigint").alias("n"), F.array_join(entries, ",").alias("entries"))


@query(
    "framed_union",
    """SELECT '<run>' AS value UNION ALL SELECT c_name FROM customer UNION ALL SELECT '</run>'""",
)
def framed_union(spark, sf):
    return framed(table(spark, sf, "customer"), ["c_custkey"], "c_name", "<run>", "</run>")
