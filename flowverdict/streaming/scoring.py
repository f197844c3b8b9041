"""Scoring of flow streams.

With frozen statistics every row is scored on its own, so the batch plan runs unchanged
and keeps no state.  With batch statistics each micro-batch is a batch of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from flowverdict.operators.forest import ForestModel
from flowverdict.plans.pipeline import BATCH, FROZEN, score_flows


def score_stream(flows: DataFrame, model: ForestModel | None = None, **options) -> DataFrame:
    """A streaming DataFrame of scored flows; ``options`` are those of ``score_flows``."""
    if options.get("cap") is not None:
        raise ValueError("a stream has no first rows to cap")
    if model is not None and options.setdefault("stats", FROZEN) == BATCH:
        raise ValueError("batch statistics need start_batch_scoring")
    return score_flows(flows, model=model, **options)


def start_batch_scoring(
    flows: DataFrame,
    path: str,
    checkpoint: str,
    model: ForestModel | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda scored: scored,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Score each micro-batch with its own statistics and write it as Parquet.

    A batch that is replayed after a failure overwrites its own folder, so every flow
    appears once.
    """
    options.setdefault("stats", BATCH)

    def write(batch: DataFrame, batch_id: int) -> None:
        # The statistics and the scoring both read the batch; its source is read once.
        batch = batch.persist()
        try:
            scored = prepare(score_flows(batch, model=model, **options))
            scored.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = flows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
