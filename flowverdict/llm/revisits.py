"""WARC not-modified revisits resolved to the latest earlier full response of their URL.

1. Records are put into range partitions of (canonical URL, time, record id) and stored, so a
   URL with a third of all records is spread over as many partitions as its size asks for.
2. Inside a partition a window carries the last full response (status 200) forward.
3. A partition boundary splits at most one URL, so what has to be carried across boundaries
   is at most one response for each partition; a window over these gives every partition the
   last response before it.
4. The validators of the revisit are checked against that response: entity tags by weak
   comparison if the revisit has one, else Last-Modified.  Headers of a resolved revisit are
   the stored ones updated by the revisit's, but for those that describe a body or one
   connection.

``resolution`` is ``full`` for full responses, ``other`` for other responses, and for
revisits ``resolved``, ``mismatch`` (a validator differs), ``unverified`` (none to compare),
``missing`` (no earlier full response) or ``no_url`` (null or no ``://``).  ``source_id`` is
the response, given also for mismatch and unverified.  Equal times are ordered by record id;
null times and ids come first.  Rows that repeat time and id are of undefined order among
themselves, but every row is returned once.  Header names ignore case, of repeated names the
first counts; null headers are none.  An empty table gives an empty result; columns beyond
those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowverdict.llm.ordering import by_range
from flowverdict.llm.tables import broadcast_if_small
from flowverdict.llm.url_rules import url_host, url_path
from flowverdict.sources.scratch import stored

# Header fields of a 304 that do not update a stored response.
NOT_MERGED = [
    "connection",
    "content-encoding",
    "content-length",
    "content-md5",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "proxy-authorization",
    "proxy-connection",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
]
FULL_STATUS = 200


def canonical_url(url: Column) -> Column:
    """Host in lower case without default port, path (``/`` if empty) and query; else null."""
    host = F.regexp_replace(url_host(url), r":(80|443)$", "")
    path = url_path(url)
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    canonical = F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), query)
    return F.when(F.instr(url, "://") > 0, canonical)


def lower_names(headers: Column) -> Column:
    """Headers by lower-case name; of repeated names the first."""
    entries = F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>"))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    return F.map_from_arrays(
        names,
        F.transform(
            names, lambda n: F.filter(entries, lambda e: F.lower(e["key"]) == n)[0]["value"]
        ),
    )


def merged_headers(stored_headers: Column, revisit_headers: Column) -> Column:
    update = F.map_filter(revisit_headers, lambda k, v: ~k.isin(NOT_MERGED))
    kept = F.map_filter(stored_headers, lambda k, v: ~F.map_contains_key(update, k))
    return F.map_concat(kept, update)


def _strong(tag: Column) -> Column:
    return F.regexp_replace(tag, r"^W/", "")


def resolve_revisits(
    records: DataFrame,
    record_id: str = "record_id",
    url: str = "url",
    time: str = "fetched_at",
    kind: str = "kind",
    status: str = "status",
    headers: str = "headers",
) -> DataFrame:
    """One row per record: record_id, canonical_url, fetched_at, resolution, source_id, headers."""
    rows = records.select(
        canonical_url(F.col(url)).alias("canonical_url"),
        F.col(time).alias("fetched_at"),
        F.col(record_id).alias("record_id"),
        (F.lower(kind) == "revisit").alias("is_revisit"),
        (F.coalesce(F.lower(kind) == "response", F.lit(False)) & F.coalesce(F.col(status) == FULL_STATUS, F.lit(False))).alias("is_full"),
        lower_names(F.col(headers)).alias("headers"),
    ).withColumn("is_revisit", F.coalesce("is_revisit", F.lit(False)))
    order = ["fetched_at", "record_id"]
    placed = by_range(rows, ["canonical_url", *order])
    response = F.when(F.col("is_full"), F.struct("record_id", "headers"))
    inside = Window.partitionBy("part", "canonical_url").orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    with_last = placed.withColumn("last", F.last(response, ignorenulls=True).over(inside))

    # At most one URL of a partition goes on in the next one.
    ends = placed.groupBy("part", "canonical_url").agg(
        F.max_by(response, F.when(F.col("is_full"), F.struct(*order))).alias("end")
    )
    edges = placed.groupBy("part").agg(
        F.min(F.struct(F.col("canonical_url").isNotNull(), "canonical_url")).alias("first_url"),
        F.max(F.struct(F.col("canonical_url").isNotNull(), "canonical_url")).alias("last_url"),
    )
    edges = edges.select(
        "part",
        F.col("first_url.canonical_url").alias("first_url"),
        F.col("last_url.canonical_url").alias("last_url"),
    )
    ends = ends.join(broadcast_if_small(edges), "part").filter(
        F.col("canonical_url").eqNullSafe(F.col("first_url"))
        | F.col("canonical_url").eqNullSafe(F.col("last_url"))
    )
    before = Window.partitionBy("canonical_url").orderBy("part")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("carried", F.last("end", ignorenulls=True).over(before))
    carried = carried.filter("carried IS NOT NULL").select("part", "canonical_url", "carried")
    carried = broadcast_if_small(stored(carried, "carried"))

    found = with_last.join(carried, ["part", "canonical_url"], "left")
    found = found.withColumn("source", F.coalesce("last", "carried"))
    mine, theirs = F.col("headers"), F.col("source.headers")

    def both(name: str) -> tuple[Column, Column]:
        return F.try_element_at(mine, F.lit(name)), F.try_element_at(theirs, F.lit(name))

    (tag, stored_tag), (date, stored_date) = both("etag"), both("last-modified")
    verdict = (
        F.when(tag.isNotNull() & stored_tag.isNotNull(), _strong(tag) == _strong(stored_tag))
        .when(tag.isNotNull(), F.lit(None))
        .when(date.isNotNull() & stored_date.isNotNull(), date == stored_date)
    )
    resolution = (
        F.when(F.col("is_full"), "full")
        .when(~F.col("is_revisit"), "other")
        .when(F.col("canonical_url").isNull(), "no_url")
        .when(F.col("source").isNull(), "missing")
        .when(verdict, "resolved")
        .when(~verdict, "mismatch")
        .otherwise("unverified")
    )
    found = found.withColumn("resolution", resolution)
    has_source = F.col("resolution").isin("resolved", "mismatch", "unverified")
    return found.select(
        "record_id",
        "canonical_url",
        "fetched_at",
        "resolution",
        F.when(has_source, F.col("source.record_id")).alias("source_id"),
        F.when(F.col("resolution") == "resolved", merged_headers(theirs, mine))
        .otherwise(mine)
        .alias("headers"),
    )


def header_digest(headers: Column) -> Column:
    """SHA-256 of the sorted ``name: value`` lines."""
    lines = F.transform(
        F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"])
    )
    return F.sha2(F.array_join(F.array_sort(lines), "\n"), 256)
