"""Registrable domains by public-suffix rules, and same-site tests.

Rules are data: a plain suffix (``co.uk``), a wildcard (``*.ck``: any one label before it) or an
exception (``!www.ck``).  Of the rules that fit a host an exception prevails, else the one of
most labels; where none fits the last label is the suffix.  The registrable domain is the
suffix and one label before it; a host that is a suffix has none.

The rules are turned into keys, so that a host meets them by equi-join: a host has one key for
each number of labels that rules have (``MOST_LABELS`` at most), so long hosts cost no more.
Equal hosts are looked up once.  A small table of rules is broadcast, a large one is
joined by shuffle with ``salts`` copies of each rule, since all hosts of ``com`` share its key.

Hosts are lowered and a trailing dot goes.  Null and empty hosts, hosts with empty labels
and addresses have no domain.
"""

from __future__ import annotations

import json
from functools import cache
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowverdict.operators.addresses import address_bits
from flowverdict.operators.decoding import bound

MOST_LABELS = 16
SALTS = 16
BROADCAST_RULES = 100_000


@cache
def shipped_rules() -> tuple[str, ...]:
    """A short list for common domains; give a full public list as a table where it matters."""
    text = resources.files("flowverdict.sources").joinpath("suffix_rules.json").read_text("utf-8")
    return tuple(json.loads(text))


def rules_frame(spark: SparkSession, rules: tuple[str, ...] | None = None) -> DataFrame:
    return spark.createDataFrame([(r,) for r in rules or shipped_rules()], "rule string")


def clean_host(host: Column) -> Column:
    """The host in lower case, or null if it has no domain."""
    plain = F.regexp_replace(F.lower(F.trim(host)), r"\.$", "")
    good = (plain != "") & ~plain.rlike(r"^\.|\.\.|\.$|[\[\]:/]") & address_bits(plain).isNull()
    return F.when(good, plain)


def _rule_table(rules: DataFrame, rule: str) -> DataFrame:
    """(suffix, labels, kind): kind 2 exception, 1 plain, 0 wildcard; labels of the rule itself."""
    text = F.lower(F.trim(F.col(rule)))
    kind = F.when(text.startswith("!"), 2).when(text.startswith("*."), 0).otherwise(1)
    rows = rules.select(F.regexp_replace(text, r"^(!|\*\.)", "").alias("suffix"), kind.alias("kind"))
    rows = rows.filter("suffix != '' AND suffix NOT LIKE '%*%'").distinct()
    return rows.withColumn("labels", F.size(F.split("suffix", r"\.")))


def registrable_domains(
    df: DataFrame,
    host: str,
    rules: DataFrame,
    into: str = "domain",
    rule: str = "rule",
    salts: int = SALTS,
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """``df`` with the registrable domain of ``host``, or null."""
    table = _rule_table(rules, rule)
    counts = sorted(r[0] for r in table.select("labels").distinct().collect())
    if counts and counts[-1] > MOST_LABELS:
        raise ValueError(f"a rule has more than {MOST_LABELS} labels")
    hosts = df.select(F.col(host).alias("__raw")).distinct()
    hosts = hosts.withColumn("__host", clean_host(F.col("__raw"))).filter("__host IS NOT NULL")
    ends = F.array(*[F.substring_index("__host", ".", -n) for n in counts or [1]])
    keys = hosts.select("__raw", "__host", F.explode(F.array_distinct(ends)).alias("suffix"))
    if table.limit(broadcast_rules + 1).count() <= broadcast_rules:
        met = keys.join(F.broadcast(table), "suffix", "left")
    else:
        salted = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keys = keys.withColumn("__salt", F.pmod(F.xxhash64("__host"), F.lit(salts)).cast("int"))
        met = keys.join(salted, ["suffix", "__salt"], "left")
    # An exception's suffix lacks its first label; a wildcard's has one more, if there is one.
    own = F.size(F.split("__host", r"\."))
    labels = F.when(F.col("kind") == 2, F.col("labels") - 1).when(F.col("kind") == 1, F.col("labels"))
    labels = labels.when((F.col("kind") == 0) & (own > F.col("labels")), F.col("labels") + 1)
    rank = F.struct((F.col("kind") == 2).alias("exception"), labels.alias("labels"))
    best = met.groupBy("__raw", "__host").agg(F.max(F.when(labels.isNotNull(), rank)).alias("best"))

    def domain(parts: Column) -> Column:
        labels = F.coalesce("best.labels", F.lit(1))
        name = F.slice(parts, F.size(parts) - labels, labels + 1)
        return F.when(F.size(parts) > labels, F.array_join(name, "."))

    found = best.select("__raw", bound(F.split("__host", r"\."), domain).alias("__found_domain"))
    out = df.drop(into).join(found, F.col(host) == F.col("__raw"), "left")
    return out.withColumn(into, F.col("__found_domain")).drop("__raw", "__found_domain")


def same_site(host: Column, domain: Column, other_host: Column, other_domain: Column) -> Column:
    """Whether two hosts belong to one site; hosts without a domain are alike if equal."""
    known = domain.isNotNull() & other_domain.isNotNull()
    return F.when(known, domain == other_domain).otherwise(F.lower(host).eqNullSafe(F.lower(other_host)))
