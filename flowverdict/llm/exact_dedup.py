"""Exact deduplication with a heavy-hitter split, in DataFrame functions only.

1. One pass writes a narrow table: row, key, SHA-256 of the text.
2. ``approx_top_k`` (a Misra-Gries style frequent-items sketch) runs over the digests.  With
   ``tracked`` counters every digest above ``rows / (0.75 * tracked)`` rows is among them.
3. A second pass counts the proposed digests exactly and finds the row that stays; those at
   or above ``hot_rows`` are the verified winners, at most ``tracked`` rows, broadcast.
   Rows of hot digests get their group in the map tasks and are never shuffled.
4. The remaining digests are ranked by an ordinary shuffle on the digest; no group there
   exceeds the larger of ``hot_rows`` and the sketch's error.

Of equal texts the row with the largest key stays; null keys rank last, and of rows equal
in text and key exactly one stays.  A null text counts as empty, texts are compared as they
are.  Extra columns play no part in ``duplicate_groups`` and are kept by ``keep_one``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowverdict.sources.scratch import stored

# Counters of the sketch; also the bound of the broadcast winners.
TRACKED = 4096
HOT_ROWS = 1000


def text_digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _rows(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Narrow rows; ``row`` is fixed by being stored."""
    return stored(
        docs.select(
            F.col(key).alias("key"),
            text_digest(F.col(text)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )


def hot_groups(
    rows: DataFrame, tracked: int = TRACKED, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Verified frequent digests: digest, hot_keep (key, row), hot_size; at most ``tracked``."""
    proposed = rows.select(
        F.explode(F.expr(f"approx_top_k(digest, {tracked}, {tracked})")).alias("top")
    ).select(F.col("top.item").alias("digest"))
    counted = rows.join(F.broadcast(proposed), "digest").groupBy("digest")
    groups = counted.agg(
        F.max(F.struct("key", "row")).alias("hot_keep"),
        F.count(F.lit(1)).alias("hot_size"),
    )
    return groups.filter(F.col("hot_size") >= hot_rows)


def duplicate_groups(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    tracked: int = TRACKED,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per document: key, keep_key, group_size, kept, digest."""
    rows = _rows(docs, text, key)
    hot = stored(hot_groups(rows, tracked, hot_rows), "hot")
    joined = rows.join(F.broadcast(hot), "digest", "left")
    settled = joined.filter(F.col("hot_size").isNotNull()).select(
        "key",
        F.col("hot_keep.key").alias("keep_key"),
        F.col("hot_size").alias("group_size"),
        (F.col("row") == F.col("hot_keep.row")).alias("kept"),
        "digest",
    )
    group = Window.partitionBy("digest")
    best = F.max(F.struct("key", "row")).over(group)
    rest = joined.filter(F.col("hot_size").isNull()).select("key", "row", "digest")
    rest = rest.withColumns({"best": best, "group_size": F.count(F.lit(1)).over(group)})
    rest = rest.select(
        "key",
        F.col("best.key").alias("keep_key"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "digest",
    )
    return settled.unionByName(rest)


def keep_one(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    tracked: int = TRACKED,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The rows of ``docs`` that stay, all columns.

    Losers of hot groups are removed in the map tasks; one row of each group is then chosen
    by an aggregate that also combines map-side.
    """
    rows = _rows(docs, text, key)
    hot = stored(hot_groups(rows, tracked, hot_rows), "hot")
    hot = hot.select(F.col("digest").alias("__digest"), F.col("hot_keep.key").alias("__hot_key"))
    hot = hot.withColumn("__hot", F.lit(True))
    marked = docs.withColumn("__digest", text_digest(F.col(text)))
    marked = marked.join(F.broadcast(hot), "__digest", "left")
    marked = marked.filter(F.col("__hot").isNull() | F.col("__hot_key").eqNullSafe(F.col(key)))
    # Sorted by size of key only, so that wide columns need not be comparable.
    rank = F.struct(F.col(key).isNotNull(), F.col(key))
    one = marked.groupBy("__digest").agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), rank).alias("__row")
    )
    return one.select("__row.*")
