from spectrel.llm.licenses import RULES, SENTENCES, recognise_licenses
from spectrel.llm.url_rules import filter_urls, pattern_rule, rarest_tokens, rule_table


def verdicts(spark, urls, **more):
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(urls)], "page_id bigint, url string, host string, rule int")
    rows = filter_urls(pages, rule_table(spark, **more)).orderBy("page_id").collect()
    return [(r.host, r.path, r.rule, r.pattern, r.verdict) for r in rows]


def test_host_rules(spark):
    cases = {
        "http://a.com/x": ("a.com", "/x", "com/", None, "allow"),
        "http://a.com": ("a.com", "", None, None, "allow"),
        "https://m.EXAMPLE.com/en/1?q#f": ("m.example.com", "/en/1", "example.com/en/", None, "block"),
        "https://www.example.com/en/1#/es/": ("www.example.com", "/en/1", "www.example.com/en/", None, "allow"),
        "https://www.example.com/EN/1": ("www.example.com", "/EN/1", "com/", None, "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", None, "allow"),
        "http://x.net/es/": ("x.net", "/es/", "net/es/", None, "block"),
        "http://x.net/es?a=://b.com/": ("x.net", "/es", None, None, "allow"),
        "http://x.org?page=2&ref=x": ("x.org", "", None, "*?page=2&ref=x", "block"),
        "http://www.x.org/ads/about.html": ("www.x.org", "/ads/about.html", None, "*://www.*/ads/about.html", "allow"),
        "http://x.org/ads/1": ("x.org", "/ads/1", None, "*/ads/*", "block"),
        "no scheme/ads/": ("", "", None, "*/ads/*", "block"),
        "://": ("", "", None, None, "allow"),
        "": ("", "", None, None, "allow"),
        "http://x.com\n/y": ("x.com\n", "/y", None, None, "allow"),
        "http://K.com/": ("K.com", "/", "com/", None, "allow"),
    }
    assert verdicts(spark, list(cases)) == list(cases.values())


def test_null_repeated_and_no_rows(spark):
    got = verdicts(spark, [None, "http://a.com/", "http://a.com/", None])
    assert got == [("", "", None, None, "allow"), ("a.com", "/", "com/", None, "allow")] * 1 + [("a.com", "/", "com/", None, "allow"), ("", "", None, None, "allow")]
    assert verdicts(spark, []) == []


def test_rules_without_a_whole_token_reach_every_url(spark):
    got = verdicts(spark, ["http://q/abcdef", "http://q/x"], host_rules=[], patterns=[("block", "*bcd*")])
    assert [v[4] for v in got] == ["block", "allow"]
    assert pattern_rule("block", "*bcd*")[4] == [] and pattern_rule("block", "*/ab*/cd/*")[4] == ["cd"]


def test_a_rule_is_indexed_by_its_rarest_token(spark):
    rules = rule_table(spark, host_rules=[("block", "example.com/en/")], patterns=[])
    tokens = spark.createDataFrame([("u", "com"), ("v", "com"), ("u", "en"), ("u", "example"), ("v", "example")], "url string, token string")
    assert rarest_tokens(rules, tokens).first().token == "en"


def scan(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, licenses string")
    return [(r.sentence_ids, r.licenses, r.unmatched_ids) for r in recognise_licenses(docs).orderBy("doc_id").collect()]


def test_licences(spark):
    known = dict(SENTENCES)
    bsd = [known[i].capitalize() for i in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")]
    wrapped = known["mit-grant"].replace(" to use", "\nto use") + ":\n\n" + known["mit-notice"].replace(" and", "\nAND") + "."
    texts = [
        None, "", "Nothing.", "Prose.\nLicensed under CC BY-NC 4.0.\nProse", "Released   under the MIT-License!",
        ". ".join(bsd) + ".", ". ".join(bsd[:3]), bsd[1] + ".", wrapped, "x " * 100_000 + ". Licensed under the Apache License, Version 2.0.",
        "Released under the MIT License.\nThis work is licensed under the GNU General Public License, version 3.",
    ]
    got = scan(spark, texts)
    assert [g[1] for g in got] == ["", "", "", "CC-BY-NC-4.0", "MIT", "BSD-3-Clause", "BSD-2-Clause", "", "MIT", "Apache-2.0", "GPL-3.0-only,MIT"]
    assert got[0] == ("", "", "") and got[7][2] == "bsd-source"


def test_every_rule_is_made_of_known_sentences_and_longer_ones_come_first():
    known = [i for i, _ in SENTENCES]
    assert len(set(known)) == len(known)
    for k, (licence, sequence) in enumerate(RULES):
        assert set(sequence) <= set(known)
        assert not any("".join(f"<{i}>" for i in other) in "".join(f"<{i}>" for i in sequence) for _, other in RULES[:k])
