"""URL filter: allow and block rules on hosts and paths, looked up by hashed expressions.

Each URL is expanded into expressions, one for every suffix of its host at label bounds and
every prefix of its path that is as long as the path of some rule.  Expressions meet rules
by an equi-join on the first four bytes of their SHA-256; equal full digests confirm a
match; of a URL's confirmed rules the longest wins (host and path together, of equally long
ones the one whose text sorts last).  URLs that no rule fits get the default verdict.

Everything runs on distinct (host, path) pairs, so a URL that makes up a third of the rows
is judged once; verdicts come back by an equi-join that Spark may split.
Null URLs and URLs without ``://`` have an empty host and path and fit no rule but one of
empty host and path.  Repeated rows stay; other columns stay, but columns named like an added
one are replaced.  An empty rule table gives every URL the default verdict.  Two rules
with one host and path but two verdicts are an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowverdict.llm.tables import broadcast_if_small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDED = ("host", "path", "rule", "verdict")
PREFIX_HEX = 8
# Longest rule paths differ in at most this many lengths; each costs an expression per URL.
MAX_PATH_LENGTHS = 1_000


def url_host(url: Column) -> Column:
    """ASCII-lower-cased text after the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_suffixes(host: Column) -> Column:
    """The host and each of its parent domains; for an empty host the empty string."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def path_prefixes(path: Column, lengths: list[int]) -> Column:
    """Prefixes of the path that have one of the lengths."""
    fitting = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.char_length(path))
    return F.transform(fitting, lambda n: F.substring(path, F.lit(1), n))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with digest, join prefix and printed form."""
    host = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER)
    path = F.coalesce(F.col("path"), F.lit(""))
    distinct = rules.select(host.alias("h"), path.alias("p"), "verdict").distinct()
    distinct = distinct.groupBy("h", "p").agg(
        F.when(F.count("*") > 1, F.raise_error("two verdicts for one rule"))
        .otherwise(F.first("verdict"))
        .alias("rule_verdict")
    )
    return distinct.select(
        F.left(_digest(F.col("h"), F.col("p")), F.lit(PREFIX_HEX)).alias("prefix"),
        _digest(F.col("h"), F.col("p")).alias("rule_digest"),
        F.char_length("p").alias("path_length"),
        F.concat("h", "p").alias("rule"),
        "rule_verdict",
    )


def filter_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``."""
    pages = pages.drop(*[c for c in pages.columns if c.lower() in ADDED and c != url])
    table = rule_table(rules)
    # The distinct lengths of rule paths, not the rules: checked against a bound.
    lengths = [r[0] for r in table.select("path_length").distinct().limit(MAX_PATH_LENGTHS + 1).collect()]
    if len(lengths) > MAX_PATH_LENGTHS:
        raise ValueError(f"rule paths of more than {MAX_PATH_LENGTHS} different lengths")
    split = pages.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    sites = split.select("host", "path").distinct()
    if not lengths:
        return split.withColumns(
            {"rule": F.lit(None).cast("string"), "verdict": F.lit(default)}
        )
    expressions = (
        sites.withColumn("suffix", F.explode(host_suffixes(F.col("host"))))
        .withColumn("start", F.explode(path_prefixes(F.col("path"), sorted(lengths))))
        .withColumn("digest", _digest(F.col("suffix"), F.col("start")))
        .withColumn("prefix", F.left("digest", F.lit(PREFIX_HEX)))
    )
    matches = expressions.join(broadcast_if_small(table), "prefix").filter(
        F.col("digest") == F.col("rule_digest")
    )
    best = matches.groupBy("host", "path").agg(
        F.max(F.struct(F.char_length("rule"), "rule", "rule_verdict")).alias("best")
    )
    best = best.select("host", "path", "best.rule", "best.rule_verdict")
    return split.join(best, ["host", "path"], "left").select(
        *pages.columns,
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", F.lit(default)).alias("verdict"),
    )
