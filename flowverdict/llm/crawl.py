"""A crawl log derived from the table ``pages``: what a revisiting crawler would record.

For page p: a full response, a revisit with varying validators that may come too early, a
second response (partial for even p), and a visit of the host's robots.txt, which is mostly a
revisit and so common that one URL holds a large share of all records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The same text serves Spark and DuckDB; {tag} is the first 16 digits of the page's SHA-256.
RECORDS = """
    SELECT page_id * 4 AS record_id, url, 60 * page_id AS fetched_at, 'response' AS kind,
           200 AS status, concat('"', tag, '"') AS etag, concat('day ', page_id) AS modified,
           size AS length, 'text/html' AS type
    FROM tagged
    UNION ALL
    SELECT page_id * 4 + 1, concat(url, '#again'),
           60 * page_id + 3600 * (page_id % 7) - 7200, 'revisit', 304,
           CASE page_id % 4 WHEN 0 THEN concat('W/"', tag, '"') WHEN 1 THEN '"stale"' END,
           CASE WHEN page_id % 4 = 2 THEN concat('day ', page_id) END, '0', NULL
    FROM tagged
    UNION ALL
    SELECT page_id * 4 + 2, url, 60 * page_id + 5000, 'response',
           CASE WHEN page_id % 2 = 1 THEN 200 ELSE 206 END,
           concat('"2-', tag, '"'), NULL, size, 'text/html'
    FROM tagged
    UNION ALL
    SELECT page_id * 4 + 3, concat('HTTP://', host, ':80/robots.txt'), 60 * page_id + 1,
           CASE WHEN page_id % 40 = 0 THEN 'response' ELSE 'revisit' END,
           CASE WHEN page_id % 40 = 0 THEN 200 ELSE 304 END,
           concat('"r', page_id - page_id % 160, '"'), NULL, '0', NULL
    FROM tagged
"""


def crawl_records(pages: DataFrame) -> DataFrame:
    """record_id, url, fetched_at (seconds), kind, status, headers."""
    tagged = pages.select(
        "page_id",
        "url",
        F.left(F.sha2(F.coalesce("html", F.lit("")), 256), F.lit(16)).alias("tag"),
        F.length(F.coalesce("html", F.lit(""))).cast("string").alias("size"),
        F.regexp_extract("url", r"(?s)^.*?://([^/?#]*)", 1).alias("host"),
    )
    rows = pages.sparkSession.sql(f"WITH tagged AS (SELECT * FROM {{tagged}}) {RECORDS}", tagged=tagged)
    headers = F.map_filter(
        F.create_map(
            F.lit("ETag"), "etag", F.lit("Last-Modified"), "modified",
            F.lit("Content-Length"), "length", F.lit("Content-Type"), "type",
            F.lit("Date"), F.col("fetched_at").cast("string"), F.lit("Connection"), F.lit("close"),
        ),
        lambda k, v: v.isNotNull(),
    )
    return rows.select("record_id", "url", "fetched_at", "kind", "status", headers.alias("headers"))
