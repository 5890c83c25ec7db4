"""The registered queries of the operators, and the SQL that checks those that SQL can express."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.core import table

from .conversations import damaged, repair_conversations
from .decontamination import contaminations
from .language import fit_languages, predict_languages
from .licenses import BY_LINE, BY_MARK, CAPITALS, RULES, SENTENCES, SMALL, recognise_licenses
from .near_duplicates import near_duplicates
from .packing import pack
from .parity_join import parity_join
from .periodic_runs import find_runs
from .quality import fit_quality, score_quality
from .repeats import cut_repeats
from .session import ready
from .topk import scaled, top_k
from .url_rules import HOST_RULES, PATTERNS, host_rule, pattern_rule, filter_urls, rule_table
from .warc import archive_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ready(spark)
            return fn(spark, sf)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def remainder(divisor: int) -> Column:
    """The checksum of the id as text, by which rows are held out."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor


@query("op1_languages")
def languages(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    field = fit_languages(docs, remainder(4) != 2)
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    predicted = predict_languages(docs.select("doc_id", "text"), field)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def text_literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches(rules: list[tuple], subject: str) -> str:
    return " UNION ALL ".join(
        f"SELECT page_id, {text_literal(rule)} AS rule, {text_literal(verdict)} AS verdict, {rank} AS by_host FROM parts"
        f" WHERE regexp_matches({subject}, {text_literal(regex)})"
        for rule, verdict, rank, regex, _ in rules
    )


URL_SQL = f"""WITH parts AS (SELECT page_id, url,
        translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{CAPITALS}', '{SMALL}') AS host,
        regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    matches AS ({_matches([host_rule(*r) for r in HOST_RULES], "host || path")}
        UNION ALL {_matches([pattern_rule(*p) for p in PATTERNS], "url")}),
    best AS (SELECT page_id, rule, verdict, by_host FROM matches
        QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY by_host DESC, length(rule) DESC, rule DESC, verdict DESC) = 1)
    SELECT page_id, host, path, CASE WHEN by_host THEN rule END AS rule, CASE WHEN NOT by_host THEN rule END AS pattern,
        coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (page_id)"""


@query("op2_url_verdicts", URL_SQL)
def url_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    return filter_urls(pages, rule_table(spark)).select("page_id", "host", "path", "rule", "pattern", "verdict")


TOP_SQL = """WITH usable AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
        FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v))
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10"""


@query("op3_top_vectors", TOP_SQL)
def top_vectors(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", scaled(F.col("embedding")).alias("vector"))
    return top_k(vectors, F.col("vec_id") % 100 == 0)


WARC_SQL = """WITH facts AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
        sha256(coalesce(html, '')) AS payload_digest FROM pages),
    firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM facts)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to FROM firsts"""


@query("op4_archived_pages", WARC_SQL)
def archived_pages(spark: SparkSession, sf: str) -> DataFrame:
    def page(column: str) -> Column:
        return F.regexp_extract(column, r"<urn:page:(-?\d+)>", 1)

    # torn records stand between the others, so the reader has to find the next valid one each time
    records = archive_round_trip(table(spark, sf, "pages"), torn_every=100).where("reason IS NULL")
    return records.select(
        F.when(page("record_id") != "", page("record_id")).cast("bigint").alias("page_id"),
        "payload_bytes", "payload_digest", "record_type",
        F.when(page("refers_to") != "", page("refers_to")).cast("bigint").alias("refers_to"),
    )


@query("op5_quality_scores")
def quality_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf, "labels"), remainder(5) != 0)
    held_out = F.coalesce(remainder(5) == 0, F.lit(False))
    scored = score_quality(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS_SQL = f"regexp_extract_all({LOWER_SQL}, '[^\\x20\\x09-\\x0D]+')"


def near_sql(size: int, kept: str) -> str:
    """Classes of documents by links of 85 hundredths, from all pairs that share a shingle."""
    return f"""WITH RECURSIVE words AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
    sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= {size}
        THEN list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
    same AS (SELECT doc_id, len(s) AS n, s, min(doc_id) OVER (PARTITION BY list_sort(s)) AS label FROM sets),
    rep AS (SELECT doc_id, n, s FROM same WHERE doc_id = label AND n > 0),
    one AS (SELECT doc_id, n, unnest(s) AS g FROM rep),
    pairs AS (SELECT a.doc_id AS x, b.doc_id AS y FROM one a JOIN one b ON a.g = b.g AND a.doc_id < b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
    edges AS (SELECT x, y FROM pairs UNION SELECT y, x FROM pairs UNION SELECT doc_id, doc_id FROM rep),
    reach AS (SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
    least AS (SELECT x, min(y) AS m FROM reach GROUP BY x)
    SELECT doc_id, n::BIGINT AS n_shingles, (CASE WHEN n = 0 THEN doc_id ELSE m END)::BIGINT AS component_id{kept}
    FROM same LEFT JOIN least ON label = x"""


LEAK_SQL = f"""WITH texts AS (SELECT 0 AS kind, doc_id AS id, {WORDS_SQL} AS w FROM documents
        UNION ALL SELECT 1, item_id, {WORDS_SQL} FROM benchmark),
    items AS (SELECT DISTINCT id, w, least(len(w), 5) AS k FROM texts WHERE kind = 1 AND len(w) > 0),
    wanted AS (SELECT id, k, unnest(list_distinct(list_transform(range(1, len(w) - k + 2),
        lambda i: array_to_string(w[i:i + k - 1], ' ')))) AS g FROM items),
    sizes AS (SELECT id, k, count(*) AS n FROM wanted GROUP BY id, k),
    held AS (SELECT DISTINCT id, k, g FROM (SELECT id, k, unnest(list_transform(range(1, len(w) - k + 2),
        lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g
        FROM texts, (SELECT DISTINCT k FROM items) WHERE kind = 0 AND len(w) >= k))
    SELECT h.id AS doc_id, s.id AS item_id, s.n::BIGINT AS n_shingles, count(*)::BIGINT AS n_found
    FROM held h JOIN wanted t ON h.k = t.k AND h.g = t.g JOIN sizes s ON s.id = t.id AND s.k = t.k
    GROUP BY h.id, s.id, s.n HAVING 100 * count(*) >= 80 * s.n"""


@query("op6_benchmark_leaks", LEAK_SQL)
def benchmark_leaks(spark: SparkSession, sf: str) -> DataFrame:
    return contaminations(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op7_near_duplicates", near_sql(5, ", doc_id = (CASE WHEN n = 0 THEN doc_id ELSE m END) AS kept"))
def near_duplicate_classes(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"), percent=85)


def _licence_steps(name: str, ends: str) -> str:
    small = f"translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}')"
    ids = "".join(f" WHEN {text_literal(sentence)} THEN {text_literal(f'<{i}>')}" for i, sentence in SENTENCES)
    return (
        f"list_aggregate(list_transform(list_transform(string_split_regex({small}, {text_literal(ends)}),"
        f" lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))), lambda s: CASE s{ids} ELSE '' END), 'string_agg', '') AS {name}"
    )


def _licence_rules(column: str) -> str:
    for licence, sequence in RULES:
        column = f"replace({column}, {text_literal(''.join(f'<{i}>' for i in sequence))}, {text_literal(f'[{licence}]')})"
    return column


LICENCE_SQL = f"""WITH found AS (SELECT doc_id, {_licence_steps("a", BY_LINE)}, {_licence_steps("b", BY_MARK)} FROM documents),
    ruled AS (SELECT *, {_licence_rules("a")} AS ra, {_licence_rules("b")} AS rb FROM found)
    SELECT doc_id, CASE WHEN a <> '' THEN a ELSE b END AS sentence_ids,
        array_to_string(list_sort(list_distinct(regexp_extract_all(ra || rb, '\\[([^\\]]+)\\]', 1))), ',') AS licenses,
        array_to_string(regexp_extract_all(CASE WHEN a <> '' THEN ra ELSE rb END, '<([^>]+)>', 1), ',') AS unmatched_ids FROM ruled"""


@query("op8_license_scan", LICENCE_SQL)
def license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return recognise_licenses(table(spark, sf, "documents").select("doc_id", "text")).drop("text")


@query("op9_sequences")
def sequences(spark: SparkSession, sf: str) -> DataFrame:
    return pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


REPEAT_SQL = """WITH data AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
    windows AS (SELECT doc_id, unnest(range(0, n - 49)) AS i, h FROM data WHERE n >= 50),
    cut AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM windows),
    least AS (SELECT s, min(doc_id) AS d FROM cut GROUP BY s HAVING count(*) > 1),
    hits AS (SELECT doc_id, i FROM cut JOIN least USING (s) WHERE d < doc_id),
    opened AS (SELECT doc_id, i, coalesce(i > lag(i) OVER w + 50, true)::INTEGER AS fresh FROM hits WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
    numbered AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM opened),
    spans AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, k),
    before AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f FROM spans),
    pieces AS (SELECT doc_id, sum(b - a)::BIGINT AS removed, count(*) AS spans, max(b) AS last,
        string_agg(substr(h, 2 * f + 1, 2 * (a - f)), '' ORDER BY a) AS head FROM before JOIN data USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, n AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
        sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
    FROM data LEFT JOIN pieces USING (doc_id)"""


@query("op10_repeats", REPEAT_SQL)
def repeats(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return cut_repeats(docs, with_text=False).drop("rest", "kept_text")


@query("op11_similar_documents", near_sql(4, ""))
def similar_documents(spark: SparkSession, sf: str) -> DataFrame:
    return parity_join(table(spark, sf, "documents"), percent=85, size=4)


def checksum_sql(text: str) -> str:
    """The checksum (CRC-32) of an ASCII text: a fold over its bytes, each followed by eight shifts (-1)."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: list_prepend(ascii(c)::BIGINT, repeat([(-1)::BIGINT], 8))))"
    shift = "CASE WHEN x >= 0 THEN xor(r, x) ELSE xor(r >> 1, (r & 1) * 3988292384) END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda r, x: {shift}), 4294967295)"


def _looped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts whose ``h`` is a multiple of ten repeat a piece of themselves from some word on."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for k, h in enumerate(batch.column("h").to_pylist()):
            words = re.findall(r"[^\x20\x09-\x0D]+", texts[k] or "") if h is not None and h % 10 == 0 else []
            if words:
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                texts[k] = " ".join(words[:a] + [words[a + i % p] for i in range(n - a)])
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})


# Runs by joining equal strings of three words: q words apart along a run of 4 q words or more (6 where q is 1), there
# are at least three in a row.
RUNS_SQL = f"""WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        {checksum_sql("doc_id::VARCHAR")} AS h FROM documents),
    sized AS (SELECT doc_id, w, len(w) AS n, h, h % 10 = 0 AND len(w) > 0 AS loops, h // 10 AS g FROM split),
    placed AS (SELECT *, CASE WHEN loops THEN g % n END AS a, CASE WHEN loops THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM sized),
    words AS (SELECT doc_id, n, CASE WHEN loops THEN list_transform(range(0, n), lambda i:
        CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM placed),
    grams AS (SELECT doc_id, n, i, hash(w[i + 1], w[i + 2], w[i + 3]) AS s FROM (SELECT *, unnest(range(0, n - 2)) AS i FROM words WHERE n >= 6)),
    pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.s = y.s
        AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
    islands AS (SELECT doc_id, q, min(i) AS start, max(i) + 3 - min(i) + q AS length FROM (SELECT *,
        i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM pairs) GROUP BY doc_id, q, k),
    runs AS (SELECT doc_id, start, length, min(q) AS period FROM islands WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
    listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM runs GROUP BY doc_id),
    best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1),
    gone AS (SELECT doc_id, list(DISTINCT i) AS gone FROM (SELECT doc_id, unnest(range(start + period, start + length)) AS i FROM runs) GROUP BY doc_id),
    rest AS (SELECT doc_id, array_to_string(CASE WHEN gone IS NULL THEN w ELSE
        list_filter(w, lambda x, i: NOT list_contains(gone, i - 1)) END, ' ') AS kept FROM words LEFT JOIN gone USING (doc_id))
    SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
        (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
        sha256(kept) AS collapsed_sha256 FROM rest LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id)"""


@query("op13_periodic_runs", RUNS_SQL)
def periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    found = find_runs(docs.mapInArrow(_looped, "doc_id bigint, text string"))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.*",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# Row by row: for each state of the expression the least (cost, audit) of the rows so far; 'B' and 'A' may end.
CHAT_SQL = f"""WITH RECURSIVE marked AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {checksum_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations),
    hurt AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM marked WHERE kind <> 0),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k,
        left(role, 1) AS initial, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending FROM hurt),
    judged AS (SELECT *, CASE WHEN ending = '' THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
        WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY k) || initial AS beside FROM placed),
    facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (beside NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM judged GROUP BY conv_id),
    moves(f, initial, t) AS (VALUES ('B', 's', 'Y'), ('B', 'u', 'U'), ('Y', 'u', 'U'), ('U', 'a', 'A'), ('A', 'u', 'U')),
    one AS (SELECT f, t, 2 AS cost, 'I' AS audit FROM moves WHERE initial <> 's'),
    more AS (SELECT f, f AS t, 0 AS cost, '' AS audit FROM (VALUES ('B'), ('Y'), ('U'), ('A')) AS v(f) UNION ALL FROM one
        UNION ALL SELECT x.f, y.t, x.cost + y.cost, x.audit || y.audit FROM one x JOIN one y ON x.t = y.f),
    kinds(fault, initial) AS (SELECT DISTINCT fault, initial FROM judged),
    plain AS (SELECT fault, initial, f, f AS t, 3 AS cost, 'D' AS audit FROM kinds, (VALUES ('B'), ('Y'), ('U'), ('A')) AS v(f)
        UNION ALL SELECT k.fault, k.initial, f, t, (k.fault = 'truncated')::INTEGER, 'K' FROM kinds k JOIN moves USING (initial)
            WHERE k.fault NOT IN ('blank', 'duplicate')
        UNION ALL SELECT k.fault, k.initial, f, t, 2 + (k.fault = 'truncated')::INTEGER, 'R' FROM kinds k, moves m
            WHERE m.initial <> 's' AND k.fault NOT IN ('blank', 'duplicate')),
    steps AS (SELECT p.fault, p.initial, p.f, m.t, p.cost + m.cost AS cost, p.audit || m.audit AS audit FROM plain p JOIN more m ON p.t = m.f),
    parse AS (SELECT conv_id, 0::BIGINT AS k, t AS state, cost::BIGINT AS cost, audit FROM facts, more WHERE f = 'B'
        UNION ALL (SELECT conv_id, k, state, cost, audit FROM (SELECT p.conv_id, j.k, s.t AS state, p.cost + s.cost AS cost,
            p.audit || s.audit AS audit FROM parse p JOIN judged j ON j.conv_id = p.conv_id AND j.k = p.k + 1
            JOIN steps s ON s.fault = j.fault AND s.initial = j.initial AND s.f = p.state)
            QUALIFY row_number() OVER (PARTITION BY conv_id, k, state ORDER BY cost, audit) = 1)),
    best AS (SELECT p.conv_id, p.cost, p.audit FROM parse p JOIN facts f ON p.conv_id = f.conv_id AND p.k = f.n AND p.state IN ('A', 'B')
        QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost, p.audit) = 1),
    letters AS (SELECT conv_id, i, audit[i] AS e, length(replace(audit, 'D', '')) % 2 AS led FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS i FROM best)),
    counted AS (SELECT *, count(*) FILTER (e <> 'I') OVER w AS k, count(*) FILTER (e <> 'D') OVER w AS place FROM letters
        WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
    edited AS (SELECT c.conv_id, c.place, CASE WHEN e = 'K' THEN j.role WHEN (c.place - c.led) % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || CASE e WHEN 'I' THEN '' ELSE j.text END AS line FROM counted c
        LEFT JOIN judged j ON e <> 'I' AND j.conv_id = c.conv_id AND j.k = c.k WHERE e <> 'D'),
    repaired AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY place) AS text FROM edited GROUP BY conv_id)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
        coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
        coalesce(audit, '') AS audit, sha256(coalesce(r.text, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts USING (conv_id) LEFT JOIN best USING (conv_id) LEFT JOIN repaired r USING (conv_id)"""


@query("op12_repaired_conversations", CHAT_SQL)
def repaired_conversations(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    whole = rows.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})
    found = repair_conversations(damaged(whole, F.crc32(name) % 20))
    every = rows.select("conv_id").distinct().alias("c").join(found.alias("f"), F.expr("c.conv_id <=> f.conv_id"), "left")
    counts = [F.coalesce(f"f.{c}", F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    texts = [F.coalesce("f.audit", F.lit("")).alias("audit"), F.coalesce("f.repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")]
    return every.select("c.conv_id", *counts, *texts)
