"""URL filtering by pattern rules that are indexed by their rarest literal token, with Spark's own functions only.

A rule is a host and path prefix (``example.com/en/``: the host and its subdomains, paths that start so) or a pattern in
which ``*`` stands for anything. Tokens are runs of a-z and 0-9. Of the tokens that every URL under a rule must hold
whole, the rule is indexed by the one that the fewest URLs hold. The tokens of a URL fetch candidate rules, and only
those run their regular expression. Rules without such a token are candidates for all URLs.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .licenses import CAPITALS, SMALL

RULE_TYPE = "rule string, verdict string, by_host boolean, regex string, tokens array<string>"
#: (verdict, host and path prefix)
HOST_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
#: (verdict, pattern) for what the host rules leave open: copies of feeds, second pages of listings, log-in and ad pages.
PATTERNS = [
    ("block", "*?utm_source=feed"),
    ("block", "*?page=2&ref=x"),
    ("block", "*/login/*"),
    ("block", "*/ads/*"),
    ("allow", "*://www.*/ads/about.html"),
]


def host_rule(verdict: str, rule: str) -> tuple:
    """A rule for a host, its subdomains and the paths that start like its path."""
    whole = re.findall(r"(?<![a-z0-9])[a-z0-9]+(?=[^a-z0-9])", rule.translate(str.maketrans(CAPITALS, SMALL)))
    return rule, verdict, True, r"^(?:[^/]*\.)?" + _quoted(rule), sorted(set(whole))


def pattern_rule(verdict: str, pattern: str) -> tuple:
    """A rule for whole URLs; tokens beside a ``*`` may be parts of longer ones and don't count."""
    small = pattern.translate(str.maketrans(CAPITALS, SMALL))
    whole = re.findall(r"(?<![a-z0-9*])[a-z0-9]+(?![a-z0-9*])", small)
    return pattern, verdict, False, "(?s)^" + ".*".join(_quoted(p) for p in pattern.split("*")) + r"\z", sorted(set(whole))


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/_-])", r"\\\1", text)


def rule_table(spark: SparkSession, host_rules=HOST_RULES, patterns=PATTERNS) -> DataFrame:
    rows = [host_rule(*r) for r in host_rules] + [pattern_rule(*p) for p in patterns]
    return spark.createDataFrame(rows, RULE_TYPE)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(host, CAPITALS, SMALL)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rarest_tokens(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """``rules`` with the token that indexes each: the least frequent in ``tokens`` (url, token), or none."""
    wanted = rules.select("rule", "by_host", F.explode("tokens").alias("token"))
    counts = tokens.join(wanted.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    counted = wanted.join(counts, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    chosen = counted.groupBy("rule", "by_host").agg(F.min(F.struct("n", "token"))["token"].alias("token"))
    return rules.drop("tokens").join(chosen, ["rule", "by_host"], "left").withColumn("token", F.coalesce("token", F.lit("")))


def judge_urls(pages: DataFrame, rules: DataFrame, url_column: str = "url", default: str = "allow") -> DataFrame:
    """(url, host, path, rule, pattern, verdict) for each distinct URL of ``pages``.

    host is the part between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; path goes on to ``?``,
    ``#`` or the end. Host rules outrank patterns; the longest of a kind wins, ties go to the larger text. rule is the host
    rule, pattern the pattern that decided; without either the verdict is ``default``.

    A null URL or one without ``://`` has an empty host and path and is judged by patterns (null: by ``default``). Repeated
    rows count once in token frequencies. Other columns are ignored. An empty table gives no row.
    """
    urls = pages.select(F.col(url_column).alias("url")).distinct()
    urls = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    small = F.translate("url", CAPITALS, SMALL)
    # the empty token stands for rules without one
    tokens = urls.where("url IS NOT NULL").select(
        "url", "host", "path", F.explode(F.array_distinct(F.array_append(F.split(small, "[^a-z0-9]+"), F.lit("")))).alias("token")
    )
    index = rarest_tokens(rules, tokens.select("url", "token"))
    candidates = tokens.join(index, "token")
    subject = F.when(F.col("by_host"), F.concat("host", "path")).otherwise(F.col("url"))
    matches = candidates.where(F.regexp_like(subject, F.col("regex")))
    best = matches.groupBy("url").agg(F.max(F.struct("by_host", F.length("rule").alias("size"), "rule", "verdict")).alias("best"))
    judged = urls.join(best, "url", "left")
    return judged.select(
        "url", "host", "path",
        F.when(F.col("best.by_host"), F.col("best.rule")).alias("rule"),
        F.when(~F.col("best.by_host"), F.col("best.rule")).alias("pattern"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def filter_urls(pages: DataFrame, rules: DataFrame, url_column: str = "url") -> DataFrame:
    """The rows of ``pages`` with the columns of ``judge_urls``; own columns of those names are replaced."""
    names = ["host", "path", "rule", "pattern", "verdict"]
    judged = judge_urls(pages, rules, url_column).withColumnRenamed("url", "_judged")
    kept = pages.drop(*[n for n in names if n != url_column])
    return kept.join(judged, kept[url_column].eqNullSafe(judged["_judged"]), "left").drop("_judged")
