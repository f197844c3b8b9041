"""Queries of the request fields, over requests derived from ``pages``, and their SQL.

A request is a page whose URL got one more parameter, picked by its id; the page's HTML is the
body.  The SQL decodes by a recursive query and tests each pattern with ``contains``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import register
from checks.oracle import SIGNATURES, quote
from flowverdict.operators import requests as rq
from flowverdict.operators.addresses import longest_match
from flowverdict.operators.decoding import ESCAPES, NAMED, OVERLONG, ROUNDS, decoded
from flowverdict.operators.domains import registrable_domains, rules_frame, shipped_rules
from flowverdict.operators.patterns import find_patterns, lowered, shipped_patterns
from flowverdict.operators.rules import evaluate_rules, exploded_matches
from flowverdict.sources.catalog import default_catalog

# Fixed values of the checks: parameters, plain and encoded once or more.
PAYLOADS = [
    "q=plain", "q=1%27%20or%201%3D1", "q=%3Cscript%3Ealert(1)", "q=%253Cscript%253E", "f=..%2F..%2Fetc%2Fpasswd",
    "f=%252e%252e%252fetc", "f=%2e%2e%2f", "f=a.png%00.jpg", "next=https%3A%2F%2Fevil.example.co.uk%2Fx",
    "next=https://www.example.com/a", "url=http://169.254.169.254/latest", "url=http%3A%2F%2F10.0.0.5%2F",
    "url=http://2130706433/", "url=http://0x7f.1/", "goto=//other.example.net/", "q=%26lt%3Bimg%20src%3Dx%20onerror%3D1",
    "q=1%20union%20all%20select%202", "q=;cat%20/etc/passwd", "q=%26%2360%3Bscript%26%2362%3B", "q=100%&r=%zz&s=%a",
    "return=http://[::1]/", "dest=http://192.168.1.1:8080/", "url=http://localhost/", "redirect=https%253A%252F%252Fx.github.io%252F",
    "q=sleep(5)&r=%u003Csvg/onload%3D1", "q=%C0%AE%C0%AE%C0%AF", "q=%E0%80%AE.%C0%AF", "q=a%26%26b", "url=http://0177.0.0.01/", "x=%E4%BD%A0%E5%A5%BD",
]
_PICK = " ".join(f"WHEN {i} THEN {quote(p)}" for i, p in enumerate(PAYLOADS))


def requests_sql(more: str = "", source: str = "pages") -> str:
    """The same text in both dialects; no string has a backslash and each quote is encoded."""
    page = "split_part(url, '#', 1)"
    return f"""SELECT page_id, {page} || CASE WHEN {page} LIKE '%?%' THEN '&' ELSE '?' END
      || CASE page_id % {len(PAYLOADS)} {_PICK} END
      || CASE WHEN url LIKE '%#%' THEN '#' || split_part(url, '#', 2) ELSE '' END AS url,
      html {more} FROM {source}"""


def requests(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return spark.sql(requests_sql(source="{pages}"), pages=pages)


# -- SQL -----------------------------------------------------------------------------------

def _regexp(pattern: str, spelled: str, text: str) -> str:
    spelled = spelled.replace("$1", "\\1")
    return f"regexp_replace({text}, {quote(pattern.removeprefix('(?i)'))}, {quote(spelled)}, 'gi')"


def _escapes(text: str) -> str:
    for pattern, spelled in ESCAPES + OVERLONG:
        text = _regexp(pattern, spelled, text)
    return text


_PERCENT = """decode(unhex(hex(p[1]) || array_to_string(list_transform(p[2:], lambda x:
  CASE WHEN regexp_matches(x, '^[0-9A-Fa-f]{2}') THEN x[1:2] || hex(x[3:])
       ELSE '25' || hex(x) END), '')))"""
_NUMBER = "regexp_extract(x, '^([xX][0-9A-Fa-f]{1,6}|[0-9]{1,7});', 1)"
_CODE = f"""CASE WHEN {_NUMBER} ILIKE 'x%' THEN ('0x' || {_NUMBER}[2:])::BIGINT
  WHEN {_NUMBER} != '' THEN {_NUMBER}::BIGINT END"""
_NUMERIC = f"""p[1] || array_to_string(list_transform(p[2:], lambda x:
  CASE WHEN {_CODE} BETWEEN 1 AND 1114111 AND NOT {_CODE} BETWEEN 55296 AND 57343
       THEN chr(({_CODE})::INT) || x[length({_NUMBER}) + 2:] ELSE '&#' || x END), '')"""


def _named(text: str) -> str:
    for name, character in NAMED:
        text = f"replace({text}, {quote(name)}, {quote(character)})"
    return text


def decode_ctes(source: str, rounds: int = ROUNDS) -> str:
    """``fixed``: id, part, text after all rounds and after one, depth; from (id, part, text)."""
    return f"""
    rounds AS (
      SELECT id, part, text, text AS once, 0 AS n, 0 AS depth, false AS settled FROM {source}
      UNION ALL
      SELECT id, part, after, CASE WHEN n = 0 THEN after ELSE once END, n + 1,
             depth + (after != text)::INT, after = text
      FROM (
        SELECT *, {_named("numbers")} AS after FROM (
          SELECT *, {_NUMERIC} AS numbers FROM (
            SELECT * EXCLUDE (p), string_split(decoded, '&#') AS p FROM (
              SELECT *, {_PERCENT} AS decoded FROM (
                SELECT *, string_split({_escapes("text")}, '%') AS p FROM rounds
                WHERE n < {rounds} AND NOT settled)))))
    ), fixed AS (
      SELECT id, part, text, once, depth FROM rounds
      QUALIFY row_number() OVER (PARTITION BY id, part ORDER BY n DESC) = 1
    )"""


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _text(value: str) -> str:
    return f"chr({ord(value)})" if value == "\0" else quote(value)


def has(text: str, group: str) -> str:
    found = [f"contains({_LOWER.format(text)}, {_text(p.lower())})" for g, p in shipped_patterns() if g == group]
    return "(" + " OR ".join(found) + ")"


_PATH = "regexp_extract(url, '^(?:[^:/?#]*://[^/?#]*)?([^?#]*)', 1)"
_QUERY = "regexp_extract(url, '^[^?#]*[?]([^#]*)', 1)"
_FRAGMENT = "regexp_extract(url, '#(.*)$', 1)"
_URL_HOST = "lower(regexp_extract({}, {}, 1))"


def _host(text: str) -> str:
    return _URL_HOST.format(text, quote(rq._HOST))


def suffix_sql(hosts: str) -> str:
    """``domains``: host, domain; from a table with a column host of clean names."""
    rules = ", ".join(f"({quote(r)})" for r in shipped_rules())
    return f"""
    suffix_rules AS (
      SELECT r AS rule, CASE WHEN r LIKE '!%' THEN 2 ELSE 1 END AS kind,
             string_split(ltrim(r, '!'), '.') AS parts FROM (VALUES {rules}) v(r)
    ), names AS (
      SELECT DISTINCT host, string_split(host, '.') AS labels FROM {hosts} WHERE host != ''
    ), fits AS (
      SELECT host, labels, kind, CASE WHEN kind = 2 THEN len(parts) - 1 ELSE len(parts) END AS size
      FROM names JOIN suffix_rules ON len(labels) >= len(parts)
       AND list_bool_and(list_transform(range(1, len(parts) + 1), lambda i:
             parts[len(parts) + 1 - i] = '*' OR parts[len(parts) + 1 - i] = labels[len(labels) + 1 - i]))
    ), domains AS (
      SELECT host, CASE WHEN len(labels) > size
                        THEN array_to_string(labels[len(labels) - size:], '.') END AS domain
      FROM (SELECT n.host, n.labels, coalesce(f.size, 1) AS size,
                   row_number() OVER (PARTITION BY n.host ORDER BY f.kind DESC NULLS LAST, f.size DESC) AS place
            FROM names n LEFT JOIN fits f USING (host))
      WHERE place = 1
    )"""


# The targets of the payloads are few: their networks are stated, not computed, in SQL.
_TARGET_NETWORKS = {
    "169.254.169.254": "metadata", "10.0.0.5": "internal", "2130706433": "loopback",
    "0x7f.1": "loopback", "[::1]": "loopback", "192.168.1.1": "internal", "0177.0.0.01": "loopback",
}


def fields_sql() -> str:
    """``fields``: page_id and all request fields."""
    flags = []
    part = {"query": "q", "fragment": "f", "body": "b", "path": "p"}
    for field, (where, group) in rq.PATTERN_FIELDS.items():
        tests = [has(f"{part[w]}.text", group) for w in where if w in part]
        flags.append(f"({' OR '.join(tests) or 'false'}) AS {field}")
    double = " OR ".join(f"({has(f'{x}.text', 'traversal')} AND NOT {has(f'{x}.once', 'traversal')})" for x in "pq")
    unicode = quote(rq._UNICODE)
    spelled = " OR ".join(
        f"({has(f'{x}.text', 'xss')} AND NOT {has(raw, 'xss')} AND regexp_matches({raw}, {unicode}))"
        for x, raw in (("q", "r.query"), ("f", "r.fragment"), ("b", "r.html"))
    )
    networks = " ".join(f"WHEN {quote(h)} THEN {quote(n)}" for h, n in _TARGET_NETWORKS.items())
    bare = ", ".join(quote(h) for h in _TARGET_NETWORKS)
    return f"""
    requests AS ({requests_sql()}),
    parted AS (SELECT *, {_PATH} AS path, {_QUERY} AS query, {_FRAGMENT} AS fragment,
                      {_host("url")} AS host,
                      regexp_extract({_QUERY}, {quote(rq._TARGET)}, 1) AS raw_target FROM requests),
    texts AS (
      SELECT page_id AS id, 'path' AS part, path AS text FROM parted
      UNION ALL SELECT page_id, 'query', query FROM parted
      UNION ALL SELECT page_id, 'fragment', fragment FROM parted
      UNION ALL SELECT page_id, 'body', coalesce(html, '') FROM parted
      UNION ALL SELECT page_id, 'target', raw_target FROM parted
    ), {decode_ctes("texts")},
    aimed AS (
      SELECT r.page_id, r.host, {_host("t.text")} AS target, {_host("r.raw_target")} AS raw
      FROM parted r JOIN fixed t ON t.id = r.page_id AND t.part = 'target'
    ), every AS (
      SELECT host FROM aimed UNION SELECT target FROM aimed WHERE target NOT IN ({bare})
    ), {suffix_sql("every")},
    fields AS (
      SELECT r.page_id, {", ".join(flags)}, ({double}) AS double_encoded_traversal,
             ({spelled}) AS unicode_xss_payload,
             target != '' AS url_param_redirect,
             target != '' AND a.raw = '' AS encoded_redirect,
             target != '' AND CASE WHEN d.domain IS NOT NULL AND e.domain IS NOT NULL
                                   THEN d.domain != e.domain
                                   ELSE r.host != target END AS redirect_external,
             network = 'internal' AS ssrf_internal_ip,
             network = 'loopback' OR target = 'localhost' AS ssrf_loopback_ref,
             network = 'metadata' AS ssrf_metadata_endpoint
      FROM parted r
      JOIN (SELECT *, CASE target {networks} ELSE '' END AS network FROM aimed) a USING (page_id)
      JOIN fixed q ON q.id = page_id AND q.part = 'query'
      JOIN fixed p ON p.id = page_id AND p.part = 'path'
      JOIN fixed f ON f.id = page_id AND f.part = 'fragment'
      JOIN fixed b ON b.id = page_id AND b.part = 'body'
      LEFT JOIN domains d ON d.host = r.host LEFT JOIN domains e ON e.host = target
    )"""


# -- queries -------------------------------------------------------------------------------

@register(
    "decoded_queries",
    f"""WITH RECURSIVE requests AS ({requests_sql()}),
    texts AS (SELECT page_id AS id, 'query' AS part, {_QUERY} AS text FROM requests
              UNION ALL SELECT page_id, 'body', coalesce(html, '') FROM requests),
    {decode_ctes("texts")}
    SELECT id AS page_id, part, depth, sha256(text) AS text_sha256 FROM fixed""",
)
def decoded_queries(spark, sf_dir):
    df = requests(spark, sf_dir)
    texts = df.select("page_id", F.lit("query").alias("part"), rq.url_parts(F.col("url"))["query"].alias("text"))
    body = df.select("page_id", F.lit("body").alias("part"), F.coalesce("html", F.lit("")).alias("text"))
    found = texts.unionByName(body).select("page_id", "part", decoded(F.col("text")).alias("d"))
    return found.select("page_id", "part", "d.depth", F.sha2("d.text", 256).alias("text_sha256"))


def _positions_sql() -> str:
    rows = ", ".join(
        f"({quote(g)}, {_text(p)})" for g, p in sorted({(g, lowered(p).decode()) for g, p in shipped_patterns()})
    )
    return f"""
    WITH RECURSIVE patterns(grp, pattern) AS (VALUES {rows}),
    texts AS (SELECT page_id, 'url' AS part, {_LOWER.format("url")} AS text FROM ({requests_sql()})
              UNION ALL SELECT page_id, 'body', {_LOWER.format("coalesce(html, '')")} FROM pages),
    places AS (
      SELECT page_id, part, grp, pattern, text, instr(text, pattern) AS place
      FROM texts JOIN patterns ON contains(text, pattern)
      UNION ALL
      SELECT page_id, part, grp, pattern, text, place + instr(text[place + 1:], pattern)
      FROM places WHERE instr(text[place + 1:], pattern) > 0
    )
    SELECT page_id, part, grp, pattern, count(*) AS n,
           string_agg((place - 1)::VARCHAR, ',' ORDER BY place) AS positions
    FROM places GROUP BY page_id, part, grp, pattern"""


@register("pattern_positions", _positions_sql())
def pattern_positions(spark, sf_dir):
    df = requests(spark, sf_dir)
    url = df.select(F.struct("page_id", F.lit("url").alias("part")).alias("key"), F.col("url").alias("text"))
    body = df.select(F.struct("page_id", F.lit("body").alias("part")).alias("key"), F.col("html").alias("text"))
    found = find_patterns(url.unionByName(body), "key", "text", list(shipped_patterns()))
    return found.select(
        "key.page_id",
        "key.part",
        F.col("group").alias("grp"),
        "pattern",
        F.size("positions").cast("long").alias("n"),
        F.array_join(F.col("positions").cast("array<string>"), ",").alias("positions"),
    )


@register(
    "request_fields",
    f"WITH RECURSIVE {fields_sql()} SELECT page_id, {', '.join(rq.FIELDS)} FROM fields",
)
def request_fields(spark, sf_dir):
    return rq.request_fields(requests(spark, sf_dir), "url", "html").select("page_id", *rq.FIELDS)


def _rule_sql() -> str:
    """Hits of the rules whose conditions are all on derived fields."""
    tests = []
    for number, (_, _, _, _, _, conditions) in enumerate(SIGNATURES):
        if all(field in rq.FIELDS for field, _, _ in conditions):
            every = " AND ".join(f"{field} = {str(value).lower()}" for field, _, value in conditions)
            tests.append(f"SELECT page_id, {number} AS rule_idx FROM fields WHERE {every}")
    return " UNION ALL ".join(tests)


@register(
    "request_rule_hits",
    f"""WITH RECURSIVE {fields_sql()}
    SELECT rule_idx::INTEGER AS rule_idx, count(*) AS requests FROM ({_rule_sql()}) GROUP BY rule_idx""",
)
def request_rule_hits(spark, sf_dir):
    """The shipped rules on derived fields; those that need other fields are left out."""
    rules = default_catalog()
    whole = [n for n, r in enumerate(rules) if all(c.field in rq.FIELDS for c in r.conditions)]
    fields = rq.request_fields(requests(spark, sf_dir), "url", "html").select("page_id", *rq.FIELDS)
    hits = exploded_matches(evaluate_rules(fields, rules), ["page_id"])
    return hits.filter(F.col("rule_idx").isin(whole)).groupBy("rule_idx").agg(F.count("*").alias("requests"))


@register(
    "page_domains",
    f"""WITH hosts AS (
      SELECT page_id, {_host("url")} AS host FROM pages
      UNION ALL SELECT page_id, ['a.b.www.ck', 'x.y.foo.ck', 'foo.ck', 'co.uk', 'shop.example.co.uk',
        'me.github.io', 'city.kawasaki.jp', 'q.a.kawasaki.jp', 'localhost'][page_id % 9 + 1] FROM pages
    ), {suffix_sql("hosts")}
    SELECT host, domain, count(*) AS pages FROM hosts LEFT JOIN domains USING (host) GROUP BY host, domain""",
)
def page_domains(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    more = F.element_at(
        F.array(*[F.lit(h) for h in (
            "a.b.www.ck", "x.y.foo.ck", "foo.ck", "co.uk", "shop.example.co.uk",
            "me.github.io", "city.kawasaki.jp", "q.a.kawasaki.jp", "localhost",
        )]),
        (F.col("page_id") % 9 + 1).cast("int"),
    )
    hosts = pages.select(rq.url_host(F.col("url")).alias("host")).unionByName(pages.select(more.alias("host")))
    found = registrable_domains(hosts, "host", rules_frame(spark))
    return found.groupBy("host", "domain").agg(F.count("*").alias("pages"))


_MORE_NETWORKS = [("10.0.0.0/8", "ten"), ("10.128.0.0/9", "ten-high"), ("10.200.16.0/20", "ten-office"), ("0.0.0.0/0", "other")]


@register(
    "client_networks",
    """WITH addressed AS (
      SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 167772160 + (event_id * 65537) % 16777216
                            ELSE (event_id * 2654435) % 4294967296 END AS n FROM events
    ), nets(low, size, name) AS (VALUES (167772160, 8, 'ten'), (176160768, 9, 'ten-high'),
                                        (180883456, 20, 'ten-office'), (0, 0, 'other'))
    SELECT event_id, name AS network FROM addressed JOIN nets
      ON n >= low AND n < low + (1::BIGINT << (32 - size))
    QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY size DESC) = 1""",
)
def client_networks(spark, sf_dir):
    """Addresses spelled as dotted, decimal or hexadecimal numbers."""
    n = """CASE WHEN event_id % 3 = 0 THEN 167772160 + (event_id * 65537) % 16777216
                ELSE (event_id * 2654435) % 4294967296 END"""
    spelled = """CASE event_id % 4 WHEN 0 THEN CAST(n AS STRING) WHEN 1 THEN '0x' || lower(hex(n))
      WHEN 2 THEN concat_ws('.', n div 16777216, n div 65536 % 256, n % 65536)
      ELSE '::ffff:' || concat_ws('.', n div 16777216, n div 65536 % 256, n div 256 % 256, n % 256) END"""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id", f"{n} AS n")
    events = events.selectExpr("event_id", f"{spelled} AS address")
    networks = spark.createDataFrame(_MORE_NETWORKS, "cidr string, name string")
    return longest_match(events, "address", networks).select("event_id", "network")
