"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Each query is planned and run completely into a sink that discards the rows.  The first
run warms the JVM and the Python workers up; the better of the two following runs counts.
The queries named ``_10x`` read the events ten times over, in 16 files written beforehand:
the table itself is one file with one row group, which one core scans.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from checks.session import local_session  # noqa: E402
from flowverdict import (  # noqa: E402
    default_catalog,
    evaluate_rules,
    score_flows,
    train_model,
    tune_session,
)
from flowverdict.operators.features import minmax_frame  # noqa: E402
from flowverdict.operators.ingest import ingest  # noqa: E402
from flowverdict.plans import reports, results  # noqa: E402
from checks import event_flows as ef  # noqa: E402
from flowverdict.sources.catalog import catalog_frame  # noqa: E402
from flowverdict.sources.scratch import scratch_folder  # noqa: E402

RUNS = 3
COPIES, FILES = 10, 16


def copied_events(spark, sf_dir: str) -> str:
    """A folder with the events ``COPIES`` times over, under new ids."""
    folder = scratch_folder(spark, "bench")
    events = ef.read_events(spark, sf_dir)
    n = events.count()
    copies = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    copies = copies.withColumn(ef.KEY, F.col(ef.KEY) + F.col("copy") * n).drop("copy")
    copies.repartition(FILES).write.parquet(f"{folder}/events.parquet")
    return folder


def discard(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = tune_session(local_session(os.environ.get("BENCH_CPUS", "8")))
    rules = default_catalog()
    key = [ef.KEY]

    def flows(folder=sf_dir):
        return ef.flows_from_events(ef.read_events(spark, folder))

    model = train_model(flows(), key).model

    many = copied_events(spark, sf_dir)

    def scored(folder=sf_dir, **options):
        return score_flows(flows(folder), rules, key=key, **options)

    def profile(**options):
        return reports.risk_profile(scored(**options))

    queries = {
        "ingest_clean": lambda: discard(ingest(ef.raw_headers(ef.dirty_flows(ef.read_events(spark, sf_dir))))),
        "minmax_fit": lambda: discard(minmax_frame(ingest(flows()))),
        "rule_hits": lambda: discard(
            results.rule_hits(evaluate_rules(flows(), rules), catalog_frame(spark, rules))
        ),
        "score_rules": lambda: discard(scored()),
        "score_frozen": lambda: discard(scored(model=model, stats="frozen")),
        "score_batch": lambda: discard(scored(model=model)),
        "result_cli": lambda: discard(results.report_rows(scored(model=model), ef.KEY)),
        "action_totals": lambda: discard(reports.action_totals(profile(model=model))),
        "risk_histogram": lambda: discard(reports.risk_histogram(profile(model=model))),
        "train": lambda: train_model(flows(), key),
        "score_rules_10x": lambda: discard(scored(many)),
        "score_frozen_10x": lambda: discard(scored(many, model=model, stats="frozen")),
        "score_batch_10x": lambda: discard(scored(many, model=model)),
        "train_10x": lambda: train_model(flows(many), key),
    }
    seconds = {}
    for name, query in queries.items():
        times = []
        for _ in range(RUNS):
            start = time.time()
            query()
            times.append(time.time() - start)
        seconds[name] = round(min(times[1:]), 3)
    n_flows = ef.read_events(spark, sf_dir).count()
    print(
        json.dumps(
            {
                "metric": "flow_scoring_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "flows": n_flows,
                "flows_per_sec": {
                    name + suffix: round(n_flows * times / seconds[name + suffix])
                    for name in ("score_rules", "score_frozen", "score_batch")
                    for suffix, times in (("", 1), ("_10x", COPIES))
                },
            }
        )
    )


if __name__ == "__main__":
    main()
