import re

import pytest

from flowverdict.llm.url_rules import filter_urls

RULES = [
    ("com", "/", "allow"), ("Example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es", "block"), ("a.net", "/", "allow"), ("b.org", "", "block"), ("", "", "block"),
]
URLS = [
    None, "", "no scheme", "http://x.com", "http://x.com/", "http://WWW.EXAMPLE.com/en/1?q#f",
    "https://example.com/en/", "https://example.com/en", "http://notexample.com/en/a",
    "ftp://a.net/es/x", "http://a.net/esx", "http://c.net/esx", "http://b.org", "http://b.org?x://y.com/",
    "http://k.b.org/#a", "http://é.com/ü/", "http://x.com/a\nb", "http://com/" + "p/" * 5000,
    "http://x.com/", "://com/", "http://.com/",
]


def judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for rule_host, rule_path, verdict in RULES:
        rule_host = rule_host.lower()
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            rule = rule_host + rule_path
            best = max(best or (-1, "", ""), (len(rule), rule, verdict))
    return host, path, best[1] if best else None, best[2] if best else "allow"


@pytest.fixture(scope="module")
def rules(spark):
    return spark.createDataFrame(RULES, "host string, path string, verdict string")


def test_verdicts(spark, rules):
    rows = [(i, u, "old", "old") for i, u in enumerate(URLS)] + [(None, URLS[4], None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    got = filter_urls(pages, rules)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()}
    assert found == {i: judge(u) for i, u in enumerate(URLS)} | {None: judge(URLS[4])}


def test_no_rules_and_no_pages(spark, rules):
    pages = spark.createDataFrame([(1, "http://x.com/")], "page_id long, url string")
    (row,) = filter_urls(pages, rules.limit(0), default="block").collect()
    assert (row.rule, row.verdict) == (None, "block")
    assert filter_urls(pages.limit(0), rules).collect() == []


def test_two_verdicts_for_one_rule(spark, rules):
    twice = rules.union(spark.createDataFrame([("com", "/", "block")], rules.schema))
    pages = spark.createDataFrame([(1, "http://x.com/")], "page_id long, url string")
    with pytest.raises(Exception, match="two verdicts"):
        filter_urls(pages, twice).collect()
