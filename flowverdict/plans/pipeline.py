"""Training and scoring end to end."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowverdict import schema
from flowverdict.functions.sqltext import name
from flowverdict.operators.cap import row_cap
from flowverdict.operators.compare import STRICT
from flowverdict.operators.features import (
    Stats,
    feature_columns,
    identity_columns,
    minmax_columns,
    minmax_frame,
    stats_from_row,
    vector_column,
    with_bounds,
    with_vector,
)
from flowverdict.operators.forest import (
    ForestModel,
    score_forest,
    train_forest,
    untrained_scores,
)
from flowverdict.operators.fusion import FusionSettings, fuse
from flowverdict.operators.ingest import (
    ingest,
    is_benign,
    label_column,
    missing_features,
    rename_headers,
)
from flowverdict.operators.rules import (
    COMPILED_RULES,
    MATCHED,
    column_types,
    match_large,
    summarise_large,
    summarise_matches,
    word_columns,
)
from flowverdict.sources.catalog import Rule, default_catalog

log = logging.getLogger(__name__)

BATCH = "batch"
FROZEN = "frozen"


@dataclass
class TrainingRun:
    model: ForestModel
    total_rows: int
    benign_rows: int
    labelled: bool
    missing: list[str] = field(default_factory=list)


def train_model(
    df: DataFrame,
    key: list[str] | None = None,
    trees: int = schema.TREES,
    contamination: float = schema.CONTAMINATION,
    threshold: float = schema.ANOMALY_THRESHOLD,
    seed: int = schema.SEED,
    sample_rows: int = schema.SAMPLE_ROWS,
) -> TrainingRun:
    """Train on the benign flows, scaled by the statistics of all flows.

    Two passes: one aggregate (counts, minima, maxima) and one that draws the samples.
    ``key`` identifies a flow and makes the model independent of the file layout; without
    it the position in the input is used.
    """
    renamed = rename_headers(df)
    flows = ingest(renamed, keep=list(key or ()))
    fit = flows.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(is_benign(flows)).alias("benign_rows"),
        *[F.expr(e) for e in minmax_columns(flows)],
    ).first()
    stats = stats_from_row(fit.asDict())
    if key is None:
        key = ["__position"]
        flows = flows.withColumn("__position", F.monotonically_increasing_id())
    model = train_forest(
        flows.filter(is_benign(flows)),
        key,
        lambda sampled: with_vector(sampled, stats),
        fit.benign_rows,
        trees,
        seed,
        threshold,
        contamination,
        sample_rows,
    )
    model.stats = stats
    return TrainingRun(
        model,
        fit.total_rows,
        fit.benign_rows,
        label_column(renamed) is not None,
        missing_features(renamed),
    )


def score_flows(
    df: DataFrame,
    rules: list[Rule] | None = None,
    model: ForestModel | None = None,
    stats: str | Stats = BATCH,
    settings: FusionSettings = FusionSettings(),
    key: list[str] = (),
    mode: str = STRICT,
    cap: int | None = None,
    order_by: list[str] | None = None,
    cleaned: bool = True,
    require_model: bool = False,
    where: str | Column | None = None,
) -> DataFrame:
    """Raw flows -> one scored row per flow, lazily and without a shuffle.

    ``where`` chooses flows by their raw columns (after renaming); it reaches the scan, as a
    filter on the result does not.  It comes before ``cap`` and before statistics.

    ``stats`` chooses the scaling of the features: ``"batch"`` fits it on the flows being
    scored (one extra aggregate over them), ``"frozen"`` takes it from the training run, a
    mapping is used as given.  Without a model the rules decide alone.
    """
    if model is None and require_model:
        raise RuntimeError("no trained model: train one or load one first")
    if where is not None:
        df = rename_headers(df).filter(where)
    if cap is not None:
        if not order_by and not key:
            raise ValueError("a capped run needs order_by (or key) to say which rows come first")
        df = row_cap(rename_headers(df), cap, list(order_by or key))
    absent = missing_features(rename_headers(df))
    if absent and model is not None:
        log.warning("features absent from the input count as 0: %s", ", ".join(absent))
    flows = ingest(df, cleaned, keep=list(key))
    rules = default_catalog() if rules is None else rules

    kept = [name(k) for k in key]
    kept += [f"{e} AS {n}" for n, e in identity_columns(flows).items() if n not in key]
    compiled = len(rules) <= COMPILED_RULES
    if compiled:
        kept += word_columns(column_types(flows), rules, mode)
    else:
        flows = match_large(flows, rules, mode)
        kept.append(MATCHED)
    if model is None:
        scored = untrained_scores(flows.selectExpr(*kept))
    else:
        if stats == BATCH:
            stats = minmax_frame(flows)
        elif stats == FROZEN:
            stats = model.stats
        flows, bounds = with_bounds(flows, stats)
        # Only what later steps read travels past the model: ids, words, the vector.
        vector = vector_column(feature_columns(flows, bounds))
        flows = flows.selectExpr(*kept, f"{vector} AS {schema.VECTOR}")
        scored = score_forest(flows, model).drop(schema.VECTOR)
    summarise = summarise_matches if compiled else summarise_large
    return fuse(summarise(scored, rules), settings)
