"""Rule fields derived from web requests: injection flags, redirects, internal targets.

``request_fields`` takes a table with a URL column, and a body and a header column where there
are any, and adds the boolean fields that the shipped rules name.  Texts are decoded to a fixpoint
(``decoding``), read once by an automaton of all patterns (``patterns``), and the target of a
redirect parameter is looked up by network (``addresses``) and registrable domain (``domains``).

Rows without such a parameter take no part in the lookups and are not shuffled.  Null texts
count as empty; existing fields of these names are replaced; repeated rows stay repeated.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowverdict.operators.addresses import longest_match
from flowverdict.operators.decoding import decoded
from flowverdict.operators.domains import registrable_domains, rules_frame, same_site
from flowverdict.operators.patterns import Patterns, groups_found, shipped_patterns
from flowverdict.sources.scratch import stored

# Field -> (part of the request, pattern group).
PATTERN_FIELDS = {
    "url_param_sqli": (("query",), "sqli"),
    "post_body_sqli": (("body",), "sqli"),
    "union_sqli_pattern": (("query", "body"), "union_sqli"),
    "time_sqli_pattern": (("query", "body"), "time_sqli"),
    "blind_sqli_pattern": (("query", "body"), "blind_sqli"),
    "error_sqli_pattern": (("query", "body"), "error_sqli"),
    "url_param_xss": (("query",), "xss"),
    "url_fragment_xss": (("fragment",), "xss"),
    "post_body_xss": (("body",), "xss"),
    "any_header_xss": (("header",), "xss"),
    "event_handler_xss": (("query", "fragment", "body"), "event_handler"),
    "url_param_cmdi": (("query",), "cmdi"),
    "post_body_cmdi": (("body",), "cmdi"),
    "shell_metachar_pattern": (("query",), "shell_metachar"),
    "blind_cmdi_pattern": (("query", "body"), "blind_cmdi"),
    "path_traversal_pattern": (("path", "query"), "traversal"),
    "lfi_pattern": (("path", "query"), "lfi"),
    "null_byte_pattern": (("path", "query"), "null_byte"),
}
OTHER_FIELDS = [
    "double_encoded_traversal",
    "unicode_xss_payload",
    "url_param_redirect",
    "encoded_redirect",
    "redirect_external",
    "ssrf_internal_ip",
    "ssrf_loopback_ref",
    "ssrf_metadata_endpoint",
]
FIELDS = [*PATTERN_FIELDS, *OTHER_FIELDS]

# Pairs of hosts that may be broadcast; beyond, rows with a target are shuffled.
BROADCAST_TARGETS = 100_000

# Special-purpose networks.
NETWORKS = [
    ("10.0.0.0/8", "internal"),
    ("100.64.0.0/10", "internal"),
    ("172.16.0.0/12", "internal"),
    ("192.168.0.0/16", "internal"),
    ("fc00::/7", "internal"),
    ("127.0.0.0/8", "loopback"),
    ("0.0.0.0/32", "loopback"),
    ("::1/128", "loopback"),
    ("169.254.0.0/16", "internal"),
    ("fe80::/10", "internal"),
    ("169.254.169.254/32", "metadata"),
    ("fd00:ec2::254/128", "metadata"),
]
LOOPBACK_NAMES = ["localhost", "localhost.localdomain", "ip6-localhost"]
METADATA_NAMES = ["metadata.google.internal", "metadata"]
REDIRECT_NAMES = "url|uri|next|redirect|redirect_uri|redirect_url|return|return_to|returnurl|goto|dest|destination|continue"

_TARGET = rf"(?i)(?:^|&)(?:{REDIRECT_NAMES})=([^&]*)"
_HOST = r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)"
# Spellings that stand for a character by its number.
_UNICODE = r"(?i)%u[0-9a-f]{4}|\\u[0-9a-f]{4}|&#x?[0-9a-f]+;|%c[01]%|%e0%8[01]%|＜|﹤"


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1))


def url_parts(url: Column) -> dict[str, Column]:
    text = F.coalesce(url, F.lit(""))
    return {
        "path": F.regexp_extract(text, r"^(?:[^:/?#]*://[^/?#]*)?([^?#]*)", 1),
        "query": F.regexp_extract(text, r"(?s)^[^?#]*\?([^#]*)", 1),
        "fragment": F.regexp_extract(text, r"(?s)#(.*)$", 1),
    }


def target_fields(targets: DataFrame, networks: DataFrame, suffixes: DataFrame) -> DataFrame:
    """Fields of pairs of hosts (__host, __target_host)."""
    found = longest_match(targets, "__target_host", networks, into="__network")
    found = registrable_domains(found, "__host", suffixes, into="__domain")
    found = registrable_domains(found, "__target_host", suffixes, into="__target_domain")
    host = F.regexp_replace("__target_host", r"\.$", "")
    network = F.coalesce(F.col("__network"), F.lit(""))
    inside = same_site(
        F.col("__host"), F.col("__domain"), F.col("__target_host"), F.col("__target_domain")
    )
    return found.select(
        "__host",
        "__target_host",
        (~inside).alias("redirect_external"),
        (network == "internal").alias("ssrf_internal_ip"),
        ((network == "loopback") | host.isin(LOOPBACK_NAMES)).alias("ssrf_loopback_ref"),
        ((network == "metadata") | host.isin(METADATA_NAMES)).alias("ssrf_metadata_endpoint"),
    )


def redirect_fields(df: DataFrame, networks: DataFrame, suffixes: DataFrame) -> DataFrame:
    """Fields of rows (__host, __raw_target, __target).

    Distinct pairs of hosts are looked up, and only rows that have a target are joined.
    """
    df = df.withColumn("__target_host", url_host(F.col("__target")))
    aimed = df.filter("__target_host != ''")
    targets = stored(aimed.select("__host", "__target_host").distinct(), "targets")
    found = stored(target_fields(targets, networks, suffixes), "target-fields")
    small = found.limit(BROADCAST_TARGETS + 1).count() <= BROADCAST_TARGETS
    aimed = aimed.join(F.broadcast(found) if small else found, ["__host", "__target_host"])
    encoded = (url_host(F.col("__raw_target")) == "").alias("encoded_redirect")
    plain = df.filter("__target_host = ''")
    kept = [F.col(f"`{c}`") for c in df.columns]
    looked_up = OTHER_FIELDS[4:]
    none = [F.lit(False).alias(f) for f in OTHER_FIELDS[2:]]
    return plain.select(*kept, *none).unionByName(
        aimed.select(*kept, F.lit(True).alias("url_param_redirect"), encoded, *looked_up)
    )


def request_fields(
    df: DataFrame,
    url: str = "url",
    body: str | None = None,
    header: str | None = None,
    patterns: Patterns | None = None,
    networks: DataFrame | None = None,
    suffixes: DataFrame | None = None,
) -> DataFrame:
    """``df`` with the fields of ``FIELDS`` as booleans."""
    spark = df.sparkSession
    patterns = list(patterns if patterns is not None else shipped_patterns())
    if networks is None:
        networks = spark.createDataFrame(NETWORKS, "cidr string, name string")
    suffixes = suffixes if suffixes is not None else rules_frame(spark)
    columns = [c for c in df.columns if c not in FIELDS]
    parts = url_parts(F.col(f"`{url}`"))
    for name, column in (("body", body), ("header", header)):
        if column:
            parts[name] = F.coalesce(F.col(f"`{column}`"), F.lit(""))
    names = list(parts)
    target = F.regexp_extract(parts["query"], _TARGET, 1)
    out = df.select(
        *[F.col(f"`{c}`") for c in columns],
        F.array(*parts.values(), target).alias("__raw"),
        url_host(F.col(f"`{url}`")).alias("__host"),
    )
    out = out.withColumn("__found", F.transform("__raw", lambda text: decoded(text)))
    # Patterns are sought in what is found in the end, after one round, and in the raw texts.
    n = len(names)
    sought = F.concat(
        F.slice(F.transform("__found", lambda d: d["text"]), 1, n),
        F.slice(F.transform("__found", lambda d: d["once"]), 1, n),
        F.slice("__raw", 1, n),
    )
    out = out.withColumn("__groups", groups_found(sought, patterns))

    def has(name: str, group: str, stage: int = 0) -> Column:
        return F.array_contains(F.col("__groups")[stage * n + names.index(name)], group)

    flags = {}
    for field, (where, group) in PATTERN_FIELDS.items():
        tests = [has(p, group) for p in where if p in names]
        flags[field] = reduce(or_, tests, F.lit(False))
    flags["double_encoded_traversal"] = reduce(
        or_, [has(p, "traversal") & ~has(p, "traversal", 1) for p in ("path", "query")]
    )
    flags["unicode_xss_payload"] = reduce(
        or_,
        [
            has(p, "xss") & ~has(p, "xss", 2) & F.col("__raw")[names.index(p)].rlike(_UNICODE)
            for p in ("query", "fragment", "body")
            if p in names
        ],
    )
    out = out.withColumns(
        flags
        | {"__raw_target": F.col("__raw")[n], "__target": F.trim(F.col("__found")[n]["text"])}
    )
    out = out.select(*[F.col(f"`{c}`") for c in columns], *flags, "__host", "__raw_target", "__target")
    out = redirect_fields(out, networks, suffixes)
    return out.select(*[F.col(f"`{c}`") for c in columns], *FIELDS)
