import ipaddress
import random
import urllib.parse

import pytest
from pyspark.sql import functions as F

from flowverdict.operators import addresses, domains, patterns
from flowverdict.operators import requests as rq
from flowverdict.operators.decoding import decoded
from flowverdict.operators.rules import evaluate_rules
from flowverdict.sources.catalog import default_catalog


def decode_all(spark, texts, **options):
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    rows = df.select("n", decoded(F.col("t"), **options).alias("d")).collect()
    return [r.d for r in sorted(rows, key=lambda r: r.n)]


@pytest.mark.parametrize(
    "text, want, depth",
    [
        ("plain", "plain", 0), ("", "", 0), ("100% & more", "100% & more", 0), ("%zz%4", "%zz%4", 0),
        ("%252e%252e%252fetc", "../etc", 2), ("&amp;lt;b", "<b", 2), ("%26lt%3Bx", "<x", 1),
        ("%c0%ae%C0%AE%c0%af", "../", 1), ("%e0%80%af", "/", 1), ("%c1%81", "A", 1),
        ("%u003cscript\\u003e\\x41", "<script>A", 1), ("&#60;&#x3E;&#128512;", "<>😀", 1),
        ("&#xD800;&#9999999;&#0;&nope;", "&#xD800;&#9999999;&#0;&nope;", 0),
        ("%E4%BD%A0", "你", 1), ("%ff%41", "�A", 1), ("é%41ü", "éAü", 1), ("%%41", "%A", 1), ("%2541", "A", 2),
    ],
)
def test_decoding(spark, text, want, depth):
    found = decode_all(spark, [text])[0]
    assert (found.text, found.depth, found.settled) == (want, depth, True)


def test_decoding_to_a_fixpoint_of_quoted_texts(spark):
    rng = random.Random(1)
    texts, plain = [None], [None]
    for _ in range(60):
        text = "".join(rng.choices("ab /<>'é你=.", k=rng.randrange(12)))
        layers = rng.randrange(5)
        plain.append((text, layers))
        for _ in range(layers):
            text = urllib.parse.quote(text, safe="ab")
        texts.append(text)
    found = decode_all(spark, texts)
    assert found[0] is None
    for row, (text, layers) in zip(found[1:], plain[1:], strict=True):
        changes = layers if any(c not in "ab.=" for c in text) else row.depth
        assert row.text == text and row.settled and row.depth == changes
    deep = "%" + "25" * 12 + "41"
    left = decode_all(spark, [deep], rounds=3)[0]
    assert (left.depth, left.settled, left.once) == (3, False, "%" + "25" * 11 + "41")


def naive(text, pattern):
    fold = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    text, pattern = fold(text or ""), fold(pattern)
    return [i for i in range(len(text)) if text.startswith(pattern, i)]


@pytest.mark.parametrize("span", [1 << 22, 16])
def test_patterns_against_naive_search(spark, monkeypatch, span):
    monkeypatch.setattr(patterns, "SPAN", span)
    rng = random.Random(4)
    table = [("a", "ab"), ("a", "bab"), ("b", "bab"), ("b", "é"), ("c", "你b"), ("c", "AA"), ("d", "\0"), ("a", "ab")]
    texts = [None, "", "\0", "a" * 50] + ["".join(rng.choices("abABé你\0", k=rng.randrange(30))) for _ in range(80)]
    df = spark.createDataFrame([(n, t, "z") for n, t in enumerate(texts)], "id int, text string, pattern string")
    got = patterns.find_patterns(df.repartition(2), "id", "text", table).collect()
    want = {
        (n, g, p.lower()): naive(t, p)
        for n, t in enumerate(texts) for g, p in table if naive(t, p)
    }
    assert {(r.key, r.group, r.pattern): r.positions for r in got} == want and len(got) == len(want)
    sets = df.select("id", patterns.groups_found(F.array("text", F.lit("xbabx")), table).alias("g")).collect()
    for row in sets:
        assert row.g == [sorted({g for i, g, _ in want if i == row.id}), ["a", "b"]]


def test_refused_patterns(spark):
    df = spark.createDataFrame([(1, "a")], "id int, text string")
    with pytest.raises(ValueError):
        patterns.find_patterns(df, "id", "text", [("g", "")])


def spelled(rng, address):
    n = int(address)
    if address.version == 6:
        return rng.choice([str(address), address.exploded, f"[{address}]", f"{address}%eth0"])
    parts = [n >> 24, n >> 16 & 255, n >> 8 & 255, n & 255]
    one = rng.choice([str, hex, lambda x: f"0{x:o}"])
    return rng.choice(
        [str(address), str(n), hex(n), ".".join(map(one, parts)), f"{parts[0]}.{n & 0xFFFFFF}", f"::ffff:{address}"]
    )


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_longest_match(spark, broadcast):
    """One network holds most of the addresses; both joins give the same."""
    rng = random.Random(5)
    nets = [ipaddress.ip_network(n) for n in (
        "0.0.0.0/0", "10.0.0.0/8", "10.16.0.0/12", "10.16.4.0/25", "192.168.0.0/16", "127.0.0.1/32",
        "2001:db8::/32", "2001:db8:8000::/33", "::1/128", "fe80::/10",
    )]
    rows = [(str(n), f"n{i}") for i, n in enumerate(nets)]
    table = [*rows, ("10.0.0.0/8", "zz"), ("bad/8", "x"), ("10.0.0.0/40", "x"), (None, "x"), ("1.0.0.0/8", None)]
    wild = []
    for _ in range(300):
        net = rng.choice([nets[2], nets[2], nets[2], *nets])
        wild.append(net[rng.randrange(min(net.num_addresses, 1 << 60))])
    data = [(spelled(rng, a), a) for a in wild]
    data += [(t, None) for t in (None, "", "256.1.1.1", "1.2.3.4.5", "08.1.1.1", "1::2::3", ":::", "1.2.3.4::", "x", "1:2:3:4:5:6:7", "4294967296")]

    def plain(address):
        if address is None:
            return None
        held = [(n.prefixlen, -i) for i, n in enumerate(nets) if n.version == address.version and address in n]
        return f"n{-max(held)[1]}" if held else None

    df = spark.createDataFrame([(n, t, "old") for n, (t, _) in enumerate(data)], "id int, host string, network string")
    networks = spark.createDataFrame(table, "cidr string, name string")
    got = addresses.longest_match(df, "host", networks, broadcast_networks=broadcast).collect()
    assert {r.id: r.network for r in got} == {n: plain(a) for n, (_, a) in enumerate(data)}
    assert len(got) == len(data)


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_registrable_domains(spark, broadcast):
    want = {
        "www.example.co.uk": "example.co.uk", "co.uk": None, "a.b.www.ck": "www.ck", "www.ck": "www.ck", "ck": None,
        "x.y.foo.ck": "y.foo.ck", "foo.ck": None, "city.kawasaki.jp": "city.kawasaki.jp", "q.a.kawasaki.jp": "q.a.kawasaki.jp",
        "localhost": None, "10.0.0.1": None, "0x7f.1": None, "Example.COM.": "example.com", "a..b": None, ".com": None, None: None,
        "": None, "me.github.io": "me.github.io", "deep.er.weird.tldx": "weird.tldx", "x." * 5000 + "com": "x.com",
    }
    df = spark.createDataFrame([(h, "old") for h in [*want, "co.uk"]], "host string, domain string")
    got = domains.registrable_domains(df, "host", domains.rules_frame(spark), broadcast_rules=broadcast).collect()
    assert {r.host: r.domain for r in got} == want and len(got) == len(want) + 1
    none = spark.createDataFrame([], "rule string")
    bare = domains.registrable_domains(df, "host", none, broadcast_rules=broadcast)
    assert {r.host: r.domain for r in bare.collect()}["www.example.co.uk"] == "co.uk"


def test_fields_and_rules(spark):
    """Each request sets the fields named, and nothing but what follows from the same text."""
    cases = {
        "http://a.com/x?q=1%27%20or%201%3D1": {"url_param_sqli"},
        "http://a.com/x?f=%252e%252e%252f": {"path_traversal_pattern", "double_encoded_traversal"},
        "http://a.com/..%2f..%2fetc/passwd": {"path_traversal_pattern", "lfi_pattern"},
        "http://a.com/x?f=a%00b": {"null_byte_pattern"},
        "http://www.a.com/?next=https%3A%2F%2Fb.a.com%2F": {"url_param_redirect", "encoded_redirect"},
        "http://www.a.com/?next=//b.co.uk/": {"url_param_redirect", "redirect_external"},
        "http://a.com/?url=http://0251.0376.0251.0376/": {"url_param_redirect", "redirect_external", "ssrf_metadata_endpoint"},
        "http://a.com/?url=http://[::1]:80/": {"url_param_redirect", "redirect_external", "ssrf_loopback_ref"},
        "http://a.com/?url=http://u:p@10.1:8080/": {"url_param_redirect", "redirect_external", "ssrf_internal_ip"},
        "http://a.com/#%u003cscript": {"url_fragment_xss", "unicode_xss_payload"},
        "http://a.com/?q=plain&next=/local": set(),
        None: set(),
    }
    rows = [(n, u, "", "old") for n, u in enumerate(cases)]
    df = spark.createDataFrame(rows, "id int, url string, body string, lfi_pattern string")
    got = rq.request_fields(df, "url", "body", header="body").collect()
    found = {r.url: {f for f in rq.FIELDS if r[f]} for r in got}
    assert found == cases and len(got) == len(rows)
    fields = rq.request_fields(df, "url").select("id", *rq.FIELDS)
    rules = default_catalog()
    by_name = {r.id: {rules[i].name for i in r.matched} for r in evaluate_rules(fields, rules).collect()}
    assert by_name[4] == set() or all("edirect" in n for n in by_name[4])
    whole = [r for r in rules if r.conditions and all(c.field in rq.FIELDS for c in r.conditions)]
    assert len(whole) > 1
    for n, u in enumerate(cases):
        assert {r.name for r in whole if all(c.field in cases[u] for c in r.conditions)} <= by_name[n]
    assert rq.request_fields(df.filter("false"), "url").count() == 0
