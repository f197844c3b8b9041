"""Isolation forest: distributed sampling, one task per tree, vectorised scoring."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowverdict import schema
from flowverdict.functions.draws import uniform
from flowverdict.functions.rounding import round_exact
from flowverdict.functions.sqltext import double
from flowverdict.operators import forest_kernels
from flowverdict.operators.forest_kernels import PackedForest, depth_limit, grow_tree, mean_path

# Executors get the kernels with the task; they need no copy of this package.
cloudpickle.register_pickle_by_value(forest_kernels)

NODE_SCHEMA = (
    "tree_id int, node_id int, depth int, feature int, threshold double, n_rows long"
)
# Upper bounds on the model, which is gathered on the driver after training and travels
# with every scoring task: trees x (2 x rows - 1) nodes, some 50,000 (a few megabytes) by
# default and 2 million (tens of megabytes) at most.
MAX_TREES = 1_000
MAX_SAMPLE_ROWS = 1_000  # also Spark's limit for cutting a ranked group before the shuffle

# Rows drawn per tree, as a multiple of the rows it needs.
OVERDRAW = 2.0
# The same for the second and last attempt, should a draw leave a tree short.
REDRAW = 8.0

_KEY = "__key"


@dataclass
class ForestModel:
    nodes: pd.DataFrame
    trees: int
    sample_rows: int
    seed: int = schema.SEED
    threshold: float = schema.ANOMALY_THRESHOLD
    contamination: float = schema.CONTAMINATION
    stats: dict[str, tuple[float, float]] = field(default_factory=dict)

    def node_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODE_SCHEMA)

    def packed(self) -> PackedForest:
        n = self.nodes
        return PackedForest(
            n.tree_id, n.node_id, n.depth, n.feature, n.threshold, n.n_rows, self.trees
        )


def _key_text(key: list[str]) -> Column:
    """The key as text; a null part differs from every other and from an absent one."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\u0002")) for k in key]
    return F.concat_ws("\u0001", *parts)


def draw_samples(
    df: DataFrame,
    key: list[str],
    n_rows: int,
    trees: int,
    sample_rows: int,
    seed: int,
    overdraw: float = OVERDRAW,
) -> DataFrame:
    """``sample_rows`` rows per tree, without replacement: the rows of ``df`` with their
    ``tree_id`` and ``rank``.

    A tree wants each row with a small probability ``p``.  The trees that want a row are
    found by geometric jumps from one to the next, so most rows of a large input are
    discarded after a single draw and no row costs a draw per tree.  What remains is about
    ``overdraw`` times the final sample whatever the input size.  Ranking then keeps
    exactly ``sample_rows`` per tree; Spark cuts each ranked group within the map tasks
    already.
    """
    p = min(1.0, overdraw * sample_rows / max(n_rows, 1))
    df = df.withColumn(_KEY, _key_text(key))
    if p < 1.0:

        def following(tree: Column) -> Column:
            u = uniform(seed, "next", tree, F.col(_KEY))
            jump = F.floor(F.ln(1.0 - u) / math.log1p(-p))
            return tree + 1 + F.least(jump, F.lit(trees)).cast("int")

        def extend(wanted: Column, _: Column) -> Column:
            last = F.element_at(wanted, -1)
            return F.when(last >= trees, wanted).otherwise(
                F.array_append(wanted, following(last))
            )

        df = df.withColumn("__first", following(F.lit(-1)))
        df = df.filter(F.col("__first") < trees)
        # A row is wanted by p * trees trees on average: a few jumps finish almost all
        # rows, and only the others go through the remaining ones.
        few = min(trees, 8 + math.ceil(4 * p * trees))
        steps = F.sequence(F.lit(1), F.lit(few))
        df = df.withColumn("__few", F.aggregate(steps, F.array("__first"), extend))
        rest = F.sequence(F.lit(few), F.lit(trees))
        wanted = F.when(F.element_at("__few", -1) >= trees, F.col("__few")).otherwise(
            F.aggregate(rest, F.col("__few"), extend)
        )
        wanted = F.filter(wanted, lambda t: t < trees)
        # Outer: see exploded_matches; the first entry always exists.
        df = df.withColumn("tree_id", F.explode_outer(wanted)).drop("__first", "__few")
    else:
        df = df.withColumn("tree_id", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    df = df.withColumn("__order", uniform(seed, "rank", F.col("tree_id"), F.col(_KEY)))
    ranking = Window.partitionBy("tree_id").orderBy("__order", _KEY)
    df = df.withColumn("rank", F.row_number().over(ranking))
    return df.filter(F.col("rank") <= sample_rows).drop("__order")


def grow_forest(samples: DataFrame, trees: int, seed: int, limit: int) -> DataFrame:
    """The node table; each group is one tree's sample, ``sample_rows`` rows at most.

    Rows with one key are drawn and ranked as a block, so a key that does not identify the
    flows shows in the samples, and is an error.
    """

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        twice = int(group[_KEY].duplicated().sum())
        if twice:
            raise ValueError(
                f"the key does not identify flows: {twice} of {len(group)} sampled rows of a "
                "tree repeat the key of another; give a unique key, or none"
            )
        group = group.sort_values("rank")
        rows = np.stack(group["features"].to_numpy())
        nodes = grow_tree(rows, int(group["tree_id"].iloc[0]), seed, limit)
        names = ["tree_id", "node_id", "depth", "feature", "threshold", "n_rows"]
        return pd.DataFrame(nodes, columns=names)

    # The samples are small, so adaptive execution would put all trees into one task; it
    # leaves a stated number of partitions alone.  The new column keeps Spark from taking
    # the shuffle of the ranking, which it may shrink, for this one.
    cores = samples.sparkSession.sparkContext.defaultParallelism
    numbered = samples.select(
        (F.col("tree_id") + 1).alias("number"), "tree_id", "rank", _KEY, schema.VECTOR
    )
    return (
        numbered.repartition(min(trees, cores), "number")
        .groupBy("number")
        .applyInPandas(grow, NODE_SCHEMA)
    )


def train_forest(
    df: DataFrame,
    key: list[str],
    vector,
    n_rows: int,
    trees: int = schema.TREES,
    seed: int = schema.SEED,
    threshold: float = schema.ANOMALY_THRESHOLD,
    contamination: float = schema.CONTAMINATION,
    sample_rows: int = schema.SAMPLE_ROWS,
) -> ForestModel:
    """Train on the rows of ``df``, ``n_rows`` in number; ``vector`` is a function that
    adds the ``features`` column and is applied to sampled rows only.

    ``contamination`` is recorded; it does not take part in scoring.
    """
    if n_rows < 1:
        raise ValueError("no rows to train on")
    if not 1 <= trees <= MAX_TREES:
        raise ValueError(f"trees must be between 1 and {MAX_TREES}")
    if not 1 <= sample_rows <= MAX_SAMPLE_ROWS:
        raise ValueError(f"sample_rows must be between 1 and {MAX_SAMPLE_ROWS}")
    size = min(sample_rows, n_rows)
    limit = depth_limit(size)
    for overdraw in (OVERDRAW, REDRAW):
        samples = draw_samples(df, key, n_rows, trees, size, seed, overdraw)
        nodes = grow_forest(vector(samples), trees, seed, limit).toArrow().to_pandas()
        roots = nodes[nodes.node_id == 1]
        if len(roots) == trees and (roots.n_rows == size).all():
            break
    else:
        raise ValueError(f"no {size} rows for each tree were found among the stated {n_rows}")
    nodes = nodes.sort_values(["tree_id", "node_id"], ignore_index=True)
    return ForestModel(nodes, trees, size, seed, threshold, contamination)


def raw_score(df: DataFrame, model: ForestModel) -> DataFrame:
    """Add ``raw_score``: minus the anomaly score of the forest, in [-1, 0)."""
    forest = model.packed()

    @F.arrow_udf("double")
    def walk(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            if len(batch) == 0:
                yield pa.array([], pa.float64())
                continue
            rows = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            yield pa.array(forest.mean_depth(rows))

    # A filter on the score must not walk the trees a second time.
    walk = walk.asNondeterministic()
    usual = float(mean_path(model.sample_rows))
    share = walk(schema.VECTOR) / usual if usual else F.lit(1.0)
    return df.withColumn("raw_score", -F.pow(F.lit(2.0), -share))


def scale_score(df: DataFrame, threshold: float) -> DataFrame:
    """Add ``anomaly_score`` in [0, 1] and ``is_anomaly`` from ``raw_score``."""
    share = f"(raw_score + {double(schema.SCORE_OFFSET)}) / {double(schema.SCORE_SPAN)}"
    return df.selectExpr(
        "*",
        f"1D - least(greatest({share}, 0D), 1D) AS __inverted",
        f"{round_exact('__inverted', 4)} AS anomaly_score",
        f"anomaly_score >= {double(threshold)} AS is_anomaly",
    ).drop("__inverted")


def score_forest(df: DataFrame, model: ForestModel | None) -> DataFrame:
    """Add raw_score, anomaly_score, is_anomaly to rows that carry ``features``."""
    if model is None:
        raise RuntimeError("no trained model: train one or load one first")
    return scale_score(raw_score(df, model), model.threshold)


def untrained_scores(df: DataFrame) -> DataFrame:
    """The columns of ``score_forest`` when there is no model: nothing is anomalous."""
    return df.selectExpr("*", "0D AS raw_score", "0D AS anomaly_score", "false AS is_anomaly")
