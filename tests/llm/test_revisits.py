import random

import pytest

from flowverdict.llm import revisits as v

SCHEMA = "record_id long, url string, fetched_at long, kind string, status int, headers map<string,string>, source_id string, resolution string"


def canonical(url):
    if url is None or "://" not in url:
        return None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut].lower(), rest[cut:].split("#")[0]
    for port in (":80", ":443"):
        host = host.removesuffix(port)
    path, mark, query = tail.partition("?")
    return host + (path or "/") + mark + query


def resolve(rows):
    """{record_id: (resolution, source, headers)} one record after the other."""
    last, out = {}, {}
    for record, url, _, kind, status, headers in sorted(
        rows, key=lambda r: (r[2] is not None, r[2] or 0, r[0])
    ):
        mine = {}
        for name, value in (headers or {}).items():
            mine.setdefault(name.lower(), value)
        key = canonical(url)
        full = (kind or "").lower() == "response" and status == 200
        if full:
            out[record] = "full", None, mine
        elif (kind or "").lower() != "revisit":
            out[record] = "other", None, mine
        elif key is None:
            out[record] = "no_url", None, mine
        elif key not in last:
            out[record] = "missing", None, mine
        else:
            source, theirs = last[key]
            result = "unverified"
            if "etag" in mine:
                if "etag" in theirs:
                    same = mine["etag"].removeprefix("W/") == theirs["etag"].removeprefix("W/")
                    result = "resolved" if same else "mismatch"
            elif "last-modified" in mine and "last-modified" in theirs:
                same = mine["last-modified"] == theirs["last-modified"]
                result = "resolved" if same else "mismatch"
            merged = mine
            if result == "resolved":
                merged = theirs | {k: x for k, x in mine.items() if k not in v.NOT_MERGED}
            out[record] = result, source, merged
        if full and key is not None:
            last[key] = record, mine
    return out


def crawl(seed, n):
    rng = random.Random(seed)
    urls = ["http://hot.com/robots.txt"] * 6 + [
        "https://HOT.com:443/robots.txt#x", "http://a.org", "http://A.org/", "http://a.org/?q", "http://b.net/é",
        None, "", "no scheme",
    ]
    rows = []
    for i in range(n):
        kind, status = rng.choice([("response", 200), ("Response", 206), ("revisit", 304), ("REVISIT", 304), ("revisit", None), (None, 200), ("metadata", None)])
        headers = rng.choice([None, {}, {"ETag": '"1"'}, {"etag": 'W/"1"', "Date": str(i)}, {"ETAG": '"2"', "Content-Length": str(i)},
                              {"Last-Modified": "m", "X": str(i)}, {"last-modified": "n", "Connection": "close", "Content-Type": "t"}])
        at = rng.choice([None, *range(40)])
        rows.append((i, rng.choice(urls), at, kind, status, headers))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_resolution(spark, seed):
    """Many range partitions, so that one URL spans several."""
    rows = crawl(seed, 900)
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = v.resolve_revisits(frame).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    want = resolve(rows)
    assert len(got) == len(rows)
    assert {r.record_id: (r.resolution, r.source_id, r.headers) for r in got} == want
    assert {r.resolution for r in got} == {"full", "other", "no_url", "missing", "resolved", "mismatch", "unverified"}
    assert all(r.canonical_url == canonical(rows[r.record_id][1]) for r in got)


def test_repeated_rows_and_null_ids(spark):
    row = (None, "http://a.org/", 1, "response", 200, {"ETag": "1"}, "", "")
    revisit = (5, "http://a.org/", 2, "revisit", 304, {"ETag": "1"}, "", "")
    got = v.resolve_revisits(spark.createDataFrame([row, row, revisit, revisit], SCHEMA)).collect()
    assert sorted(r.resolution for r in got) == ["full", "full", "resolved", "resolved"]
    assert all(r.source_id is None for r in got)


def test_empty_table(spark):
    assert v.resolve_revisits(spark.createDataFrame([], SCHEMA)).collect() == []
