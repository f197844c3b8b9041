"""Every registered query next to the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle as o
from flowverdict.operators.cap import dense_index, number_rows, row_cap
from flowverdict.operators.compare import TYPED
from flowverdict.operators.features import identity_columns, minmax_frame, with_vector
from flowverdict.operators.forest import scale_score
from flowverdict.operators.fusion import FusionSettings, decision_record, fuse, fuse_each
from flowverdict.operators.ingest import benign_only, ingest
from flowverdict.operators.rules import (
    evaluate_rules,
    exploded_matches,
    match_large,
    rule_results,
)
from flowverdict.operators.rules_relational import matches_by_division
from flowverdict.operators.upstream import with_rare_destination
from flowverdict.plans import catalog_checks, reports, results
from flowverdict.plans.pipeline import FROZEN, score_flows, train_model
from flowverdict.schema import FEATURES, REPORT_ROWS, SEVERITIES, VECTOR
from flowverdict.session import tune_session
from checks import event_flows as ef
from flowverdict.sources.catalog import Condition, Rule, catalog_frame, default_catalog
from flowverdict.sources.flow_csv import read_flow_csv
from flowverdict.sources.model_store import load_model, save_model
from flowverdict.sources.scratch import scratch_folder
from flowverdict.sources.writers import write_csv
from flowverdict.streaming.scoring import score_stream, start_batch_scoring
from flowverdict.streaming.statistics import running_bounds, start_running_bounds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
KEY = [ef.KEY]


def register(name: str, sql: str | None = None):
    def add(query: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: query(tune_session(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def full(spark, sf_dir):
    return ef.flows_from_events(ef.read_events(spark, sf_dir))


def core(spark, sf_dir):
    return ef.core_flows(ef.read_events(spark, sf_dir))


def dirty(spark, sf_dir):
    return ef.dirty_flows(ef.read_events(spark, sf_dir))


def scored_by_rules(spark, sf_dir):
    return score_flows(full(spark, sf_dir), key=KEY)


def scored_synthetic(spark, sf_dir):
    evaluated = evaluate_rules(full(spark, sf_dir), default_catalog())
    return fuse(ef.with_synthetic_scores(evaluated))


# -- ingest ------------------------------------------------------------------------------

@register(
    "flow_ingest_clean",
    f"WITH {o.flows('cleaned')} SELECT * FROM flows",
)
def flow_ingest_clean(spark, sf_dir):
    return ingest(ef.raw_headers(dirty(spark, sf_dir)), keep=KEY)


@register(
    "flow_identity",
    f"""WITH {o.flows('core')}
    SELECT event_id, label, '' AS src_ip, '' AS dst_ip, CAST(0 AS BIGINT) AS src_port, dst_port,
      CAST(protocol_type AS VARCHAR) AS protocol FROM flows""",
)
def flow_identity(spark, sf_dir):
    flows = ingest(core(spark, sf_dir))
    return flows.selectExpr(*KEY, *[f"{e} AS {n}" for n, e in identity_columns(flows).items()])


@register(
    "benign_filter",
    f"""WITH {o.flows('dirty')}
    SELECT event_id, label FROM flows WHERE upper(label) LIKE '%BENIGN%'""",
)
def benign_filter(spark, sf_dir):
    flows = ef.raw_headers(dirty(spark, sf_dir))
    return benign_only(flows).select(*KEY, F.col("` Label`").alias("label"))


@register(
    "row_cap",
    f"""WITH {o.flows()} SELECT event_id, duration, dst_port, label FROM flows
    ORDER BY event_id LIMIT {REPORT_ROWS}""",
)
def row_cap_query(spark, sf_dir):
    flows = row_cap(full(spark, sf_dir), REPORT_ROWS, KEY)
    return flows.select(*KEY, "duration", "dst_port", "label")


@register(
    "row_cap_lineitem",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    ORDER BY l_orderkey, l_linenumber LIMIT 40000""",
)
def row_cap_lineitem(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    first = row_cap(lines, 40_000, ["l_orderkey", "l_linenumber"])
    return first.select("l_orderkey", "l_linenumber", "l_quantity")


@register(
    "flow_index",
    """SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS flow_idx, event_id FROM events""",
)
def flow_index(spark, sf_dir):
    events = ef.read_events(spark, sf_dir).select("ts", "event_id")
    return dense_index(events, ["ts", "event_id"]).select("flow_idx", "event_id")


# -- features ----------------------------------------------------------------------------

@register("minmax_fit", f"WITH {o.flows('cleaned')}, {o.bounds()} SELECT * FROM bounds")
def minmax_fit(spark, sf_dir):
    return minmax_frame(ingest(dirty(spark, sf_dir)))


@register(
    "feature_vector",
    f"""WITH {o.flows('cleaned')}, {o.bounds()}, {o.vectors()} SELECT event_id, """
    + ", ".join(f"x[{i + 1}] AS {f}" for i, f in enumerate(FEATURES))
    + " FROM vectors",
)
def feature_vector(spark, sf_dir):
    flows = ingest(dirty(spark, sf_dir))
    vectors = with_vector(flows, minmax_frame(flows))
    return vectors.select(
        *KEY, *[F.col(VECTOR)[i].cast("double").alias(f) for i, f in enumerate(FEATURES)]
    )


# -- catalog -----------------------------------------------------------------------------

_HITS = "hits AS (SELECT rule_idx, count(*) AS flows FROM tested WHERE matched GROUP BY rule_idx)"
_CATALOG_HITS = f"""{o.rules_prefix()}, {_HITS},
    listed AS (SELECT c.*, coalesce(h.flows, 0) AS flows FROM catalog c LEFT JOIN hits h USING (rule_idx))"""


def _catalog_hits(spark, sf_dir):
    rules = default_catalog()
    evaluated = evaluate_rules(full(spark, sf_dir), rules)
    return results.rule_hits(evaluated, catalog_frame(spark, rules))


@register("rule_catalog", f"{_CATALOG_HITS} SELECT * FROM listed")
def rule_catalog(spark, sf_dir):
    return _catalog_hits(spark, sf_dir).drop("conditions")


@register(
    "rule_filter",
    f"""{_CATALOG_HITS} SELECT * FROM listed
    WHERE category IN ('Injection', 'DoS') AND severity IN ('CRITICAL', 'HIGH')""",
)
def rule_filter(spark, sf_dir):
    listed = _catalog_hits(spark, sf_dir).drop("conditions")
    return results.filter_catalog(listed, ["Injection", "DoS"], ["CRITICAL", "HIGH"])


@register(
    "rule_categories",
    f"{_CATALOG_HITS} SELECT DISTINCT category FROM listed",
)
def rule_categories(spark, sf_dir):
    return results.catalog_categories(_catalog_hits(spark, sf_dir))


def _condition_rows() -> str:
    rows = []
    for i, (*_, conditions) in enumerate(o.SIGNATURES):
        for j, (field, op, value) in enumerate(conditions):
            shown = o.quote(f"{field}  {op}  {value}")
            test = o.condition(field, op, value, set(o.flow_columns()))
            rows.append(f"({i}, {j}, {shown}, (SELECT count(*) FROM flows WHERE {test}))")
    return ",\n".join(rows)


@register(
    "rule_conditions",
    f"""WITH {o.flows()}, {o.catalog()}
    SELECT c.*, CAST(k.j AS INTEGER) AS condition_idx, k.condition, CAST(k.flows AS BIGINT) AS flows
    FROM catalog c JOIN (VALUES {_condition_rows()}) k(i, j, condition, flows) ON c.rule_idx = k.i""",
)
def rule_conditions(spark, sf_dir):
    rules = default_catalog()
    listing = results.rule_listing(catalog_frame(spark, rules))
    hits = catalog_checks.condition_hits(full(spark, sf_dir), rules)
    return listing.join(hits, ["rule_idx", "condition_idx"])


# -- comparator --------------------------------------------------------------------------

_COLUMNS = ["whole", "fraction", "flag", "words"]
_OPS = [">", ">=", "<", "<=", "==", "!=", "~"]
_VALUES = [5, 2.5, True, False, "5", "true", "", "abc", "nan", None]
_WORDS = ["5", " 7.5 ", "true", "FALSE", "", "abc", "1_0", "1.0d", "nan", "inf", "None", "-2e0"]
# What each of the words reads as.
_WORD_NUMBERS = ["5", "7.5", None, None, None, None, "10", None, "nan", "inf", None, "-2"]
_VALUE_NUMBERS = ["5", "2.5", "1", "0", "5", None, None, None, "nan", None]


def _mixed(spark, sf_dir):
    e = F.col("event_id")
    words = F.element_at(
        F.array(*[F.lit(w) for w in _WORDS]), (e % len(_WORDS)).cast("int") + 1
    )
    fraction = F.when(e % 5 == 0, float("nan")).when(e % 5 == 1, float("inf"))
    return ef.read_events(spark, sf_dir).select(
        "event_id",
        F.when(e % 11 != 0, e % 8).alias("whole"),
        F.when(e % 7 != 0, fraction.otherwise(F.col("value"))).alias("fraction"),
        F.when(e % 3 != 0, e % 2 == 0).alias("flag"),
        F.when(e % 13 != 0, words).alias("words"),
    )


def _comparator_sql() -> str:
    words = ", ".join(o.quote(w) for w in _WORDS)
    numbers = ", ".join("NULL" if n is None else o.quote(n) for n in _WORD_NUMBERS)
    cases = ", ".join(
        f"({o.quote(repr(v))}, {'NULL' if n is None else o.quote(n)}, {o.quote(str(v).upper())})"
        for v, n in zip(_VALUES, _VALUE_NUMBERS)
    )
    ops = ", ".join(f"({o.quote(op)})" for op in _OPS)
    # A missing actual prints as NONE and reads as no number.
    return f"""WITH mixed AS (
      SELECT CASE WHEN event_id % 11 <> 0 THEN event_id % 8 END AS whole,
        CASE WHEN event_id % 7 <> 0 THEN CASE event_id % 5 WHEN 0 THEN CAST('nan' AS DOUBLE)
          WHEN 1 THEN CAST('inf' AS DOUBLE) ELSE value END END AS fraction,
        CASE WHEN event_id % 3 <> 0 THEN event_id % 2 = 0 END AS flag,
        CASE WHEN event_id % 13 <> 0 THEN list_extract([{words}], CAST(event_id % {len(_WORDS)} AS INT) + 1) END AS words,
        CASE WHEN event_id % 13 <> 0 THEN CAST(list_extract([{numbers}], CAST(event_id % {len(_WORDS)} AS INT) + 1) AS DOUBLE) END AS word_number
      FROM events),
    actuals AS (
      SELECT 'whole' AS col, CAST(whole AS DOUBLE) AS a, coalesce(CAST(whole AS VARCHAR), 'NONE') AS t FROM mixed
      UNION ALL SELECT 'fraction', fraction, CASE WHEN fraction IS NULL THEN 'NONE' ELSE 'A NUMBER' END FROM mixed
      UNION ALL SELECT 'flag', CAST(flag AS DOUBLE), coalesce(upper(CAST(flag AS VARCHAR)), 'NONE') FROM mixed
      UNION ALL SELECT 'words', word_number, coalesce(upper(words), 'NONE') FROM mixed),
    grouped AS (SELECT col, a, t, count(*) AS n FROM actuals GROUP BY col, a, t),
    cases AS (SELECT value, CAST(number AS DOUBLE) AS v, text FROM (VALUES {cases}) c(value, number, text)),
    ops AS (SELECT op FROM (VALUES {ops}) p(op))
    SELECT col AS "column", op, value, CAST(coalesce(sum(n) FILTER (WHERE
        CASE WHEN a IS NULL OR v IS NULL THEN t = text
          WHEN isnan(a) OR isnan(v) THEN op = '!='
          WHEN op = '>' THEN a > v WHEN op = '>=' THEN a >= v WHEN op = '<' THEN a < v
          WHEN op = '<=' THEN a <= v WHEN op = '==' THEN a = v WHEN op = '!=' THEN a <> v
          ELSE false END), 0) AS BIGINT) AS flows
    FROM grouped, cases, ops GROUP BY col, op, value"""


@register("comparator_matrix", _comparator_sql())
def comparator_matrix(spark, sf_dir):
    return catalog_checks.comparison_hits(_mixed(spark, sf_dir), _COLUMNS, _OPS, _VALUES)


# -- rules -------------------------------------------------------------------------------

_RESULT = "rule_idx, rule_id, rule_name, category, severity"


@register(
    "rule_results_all",
    f"""{o.rules_prefix()} SELECT event_id, {_RESULT},
      CASE WHEN matched THEN confidence ELSE 0 END AS confidence, matched
    FROM tested JOIN catalog USING (rule_idx)""",
)
def rule_results_all(spark, sf_dir):
    return rule_results(full(spark, sf_dir), default_catalog(), KEY)


@register(
    "rule_hits_long",
    f"""{o.rules_prefix()} SELECT event_id, {_RESULT}, confidence, matched
    FROM tested JOIN catalog USING (rule_idx) WHERE matched""",
)
def rule_hits_long(spark, sf_dir):
    return rule_results(full(spark, sf_dir), default_catalog(), KEY, matched_only=True)


@register(
    "rule_hits_division",
    f"{o.rules_prefix()} SELECT event_id, CAST(rule_idx AS INTEGER) AS rule_idx FROM tested WHERE matched",
)
def rule_hits_division(spark, sf_dir):
    return matches_by_division(full(spark, sf_dir), default_catalog(), KEY)


@register(
    "rule_hits_repeated_keys",
    f"""{o.rules_prefix()} SELECT event_id // 2 AS pair, CAST(rule_idx AS INTEGER) AS rule_idx
    FROM tested WHERE matched""",
)
def rule_hits_repeated_keys(spark, sf_dir):
    """Two flows under one key count twice."""
    flows = full(spark, sf_dir).withColumn("pair", F.floor(F.col("event_id") / 2))
    return matches_by_division(flows, default_catalog(), ["pair"])


_LARGE_FIELDS = ["duration", "dst_port", "pkt_count", "avg_pkt_size", "syn_flag_count"]
_LARGE_RULES = 2_400


def _large_catalog() -> list[Rule]:
    """Rule i: field i mod 5, ``>=`` for even i and ``<`` for odd i, threshold 3 i."""
    return [
        Rule(
            f"GEN-{i}", f"generated {i}", "Generated", SEVERITIES[i % 4], 0.5,
            (Condition(_LARGE_FIELDS[i % 5], "<" if i % 2 else ">=", 3 * i),),
        )
        for i in range(_LARGE_RULES)
    ]


@register(
    "large_catalog_hits",
    f"""WITH {o.flows()}, readings AS (SELECT unnest(range(5)) AS f, unnest([
        {", ".join(f"CAST({f} AS DOUBLE)" for f in _LARGE_FIELDS)}]) AS v FROM flows),
    grouped AS (SELECT f, v, count(*) AS n FROM readings GROUP BY f, v),
    rules AS (SELECT CAST(i AS INTEGER) AS rule_idx FROM (SELECT unnest(range({_LARGE_RULES})) AS i))
    SELECT rule_idx, CAST(sum(n) AS BIGINT) AS flows FROM rules JOIN grouped ON f = rule_idx % 5
      AND CASE WHEN rule_idx % 2 = 1 THEN v < 3 * rule_idx ELSE v >= 3 * rule_idx END
    GROUP BY rule_idx""",
)
def large_catalog_hits(spark, sf_dir):
    """A catalog beyond what is compiled."""
    evaluated = evaluate_rules(full(spark, sf_dir), _large_catalog())
    hits = exploded_matches(evaluated).groupBy("rule_idx")
    return hits.agg(F.count(F.lit(1)).alias("flows"))


_INDEXED_RULES = 20_000


def _indexed_catalog() -> list[Rule]:
    """Rule i: one source port, and for two rules in three a bound on the packets."""
    rules = []
    for i in range(_INDEXED_RULES):
        own = [Condition("src_port", "==", 1024 + (i * 7) % 60000)]
        if i % 3:
            own.append(Condition("pkt_count", ">" if i % 3 == 1 else "!=", i % 500))
        rules.append(Rule(f"IDX-{i}", f"indexed {i}", "Generated", SEVERITIES[i % 4], 0.5, tuple(own)))
    return rules


@register(
    "indexed_catalog_hits",
    f"""WITH {o.flows()}, rules AS (
      SELECT CAST(i AS INTEGER) AS rule_idx, 1024 + (i * 7) % 60000 AS port, i % 500 AS bound
      FROM (SELECT unnest(range({_INDEXED_RULES})) AS i))
    SELECT event_id, rule_idx FROM flows JOIN rules ON src_port = port
     AND CASE rule_idx % 3 WHEN 1 THEN pkt_count > bound WHEN 2 THEN pkt_count != bound ELSE true END""",
)
def indexed_catalog_hits(spark, sf_dir):
    """Twenty thousand rules by their most selective condition."""
    return exploded_matches(match_large(full(spark, sf_dir), _indexed_catalog()), KEY)


@register(
    "rule_group_hits",
    f"""{_CATALOG_HITS} SELECT category, severity, count(*) AS rules,
      count(*) FILTER (WHERE flows > 0) AS rules_hit, CAST(sum(flows) AS BIGINT) AS hits
    FROM listed GROUP BY category, severity""",
)
def rule_group_hits(spark, sf_dir):
    return results.group_hits(_catalog_hits(spark, sf_dir))


def _details_sql() -> str:
    rows = []
    for *_, conditions in o.SIGNATURES:
        parts = []
        for field, op, value in conditions:
            actual = f"CAST({field} AS VARCHAR)"
            if field in o.FLAGS:
                actual = f"CASE WHEN {field} THEN 'True' ELSE 'False' END"
            parts.append(f"{o.quote(f'{field} {op} {value} (actual: ')} || {actual} || ')'")
        rows.append(" || '; ' || ".join(parts))
    indices = ", ".join(str(i) for i in range(len(rows)))
    tests = ",\n".join(f"({p})" for p in o.predicates())
    texts = ",\n".join(f"({r})" for r in rows)
    return f"""WITH {o.flows()}, tested AS (SELECT event_id, unnest([{indices}]) AS rule_idx,
      unnest([{tests}]) AS matched, unnest([{texts}]) AS details FROM flows)
    SELECT event_id, CAST(rule_idx AS INTEGER) AS rule_idx, details FROM tested WHERE matched"""


@register("match_details", _details_sql())
def match_details(spark, sf_dir):
    matches = rule_results(
        full(spark, sf_dir), default_catalog(), KEY, matched_only=True, details=True
    )
    return matches.select(*KEY, "rule_idx", "details")


@register(
    "match_listing",
    f"""{o.rules_prefix()} SELECT event_id, c.rule_idx, '[' || rule_id || '] ' || rule_name
      || ' | Severity: ' || severity || ' | Confidence: ' || CAST(confidence AS VARCHAR) AS listing
    FROM tested t JOIN catalog c USING (rule_idx) WHERE matched""",
)
def match_listing(spark, sf_dir):
    rules = default_catalog()
    return results.match_listing(evaluate_rules(full(spark, sf_dir), rules), rules, KEY)


_SUMMARY = """event_id, any_match, highest_severity, max_confidence, n_matched, matched_rules"""


def _summary(evaluated):
    return evaluated.select(
        *KEY, "any_match", "highest_severity", "max_confidence",
        F.size("matched").cast("long").alias("n_matched"),
        F.array_join("rule_names", ", ").alias("matched_rules"),
    )


@register("flow_rule_summary", f"{o.rules_prefix()}, {o.SUMMARY} SELECT {_SUMMARY} FROM summary")
def flow_rule_summary(spark, sf_dir):
    return _summary(evaluate_rules(full(spark, sf_dir), default_catalog()))


@register(
    "flow_rule_summary_core",
    f"{o.rules_prefix('core')}, {o.SUMMARY} SELECT {_SUMMARY} FROM summary",
)
def flow_rule_summary_core(spark, sf_dir):
    return _summary(evaluate_rules(core(spark, sf_dir), default_catalog()))


@register(
    "flow_rule_summary_typed",
    f"{o.rules_prefix('full', True)}, {o.SUMMARY} SELECT {_SUMMARY} FROM summary",
)
def flow_rule_summary_typed(spark, sf_dir):
    return _summary(evaluate_rules(full(spark, sf_dir), default_catalog(), TYPED))


@register(
    "flow_rule_summary_uncleaned",
    f"{o.rules_prefix('dirty')}, {o.SUMMARY} SELECT {_SUMMARY} FROM summary",
)
def flow_rule_summary_uncleaned(spark, sf_dir):
    """NaN, infinity and null reach the comparator when the flows are not cleaned."""
    flows = ingest(dirty(spark, sf_dir), cleaned=False)
    return _summary(evaluate_rules(flows, default_catalog()))


# -- fusion ------------------------------------------------------------------------------

_FUSION = "event_id, rule_score, ml_score, risk_score, action"


@register("risk_rules_only", f"{o.decided(o.RULES_ONLY)} SELECT {_FUSION} FROM fused")
def risk_rules_only(spark, sf_dir):
    scored = scored_by_rules(spark, sf_dir)
    return scored.select(*KEY, "rule_score", "ml_score", "risk_score", "action")


@register("risk_fused", f"{o.decided(o.SYNTHETIC)} SELECT {_FUSION} FROM fused")
def risk_fused(spark, sf_dir):
    scored = scored_synthetic(spark, sf_dir)
    return scored.select(*KEY, "rule_score", "ml_score", "risk_score", "action")


@register(
    "scored_filtered",
    f"{o.decided(o.RULES_ONLY)} SELECT {_FUSION} FROM fused WHERE dst_port = 22 AND label = 'DDoS'",
)
def scored_filtered(spark, sf_dir):
    scored = score_flows(full(spark, sf_dir), key=KEY, where="dst_port = 22 AND label = 'DDoS'")
    return scored.select(*KEY, "rule_score", "ml_score", "risk_score", "action")


@register(
    "score_scale",
    f"""WITH raw AS (SELECT event_id,
      CAST((event_id * 7919) % 100003 AS DOUBLE) / {o.real(100003.0)} * {o.real(1.4)} - {o.real(1.0)}
        AS raw_score FROM events)
    SELECT event_id, raw_score,
      {o.rounded("anomaly_score", f"1 - least(greatest((raw_score + {o.real(0.6)}) / {o.real(0.7)}, 0), 1)", 4)},
      anomaly_score >= {o.real(0.55)} AS is_anomaly FROM raw""".join(
        ["SELECT event_id, raw_score, anomaly_score, is_anomaly FROM (", ")"]
    ),
)
def score_scale(spark, sf_dir):
    raw = ((F.col("event_id") * 7919) % 100003).cast("double") / 100003.0 * 1.4 - 1.0
    events = ef.read_events(spark, sf_dir).select("event_id", raw.alias("raw_score"))
    return scale_score(events, 0.55)


@register(
    "decision_record",
    f"""{o.decided(o.SYNTHETIC)} SELECT event_id, action, risk_score, rule_score, ml_score,
      any_match AS rule_matched, matched_rules AS matched_rule_names,
      highest_severity AS rule_severity, anomaly_score AS ml_anomaly_score, reasoning,
      CASE action WHEN 'ALLOW' THEN 'green' WHEN 'ALERT' THEN 'orange' ELSE 'red' END AS color,
      CASE action WHEN 'ALLOW' THEN '✅' WHEN 'ALERT' THEN '⚠️' ELSE '🚫' END AS icon
    FROM reasoned""",
)
def decision_record_query(spark, sf_dir):
    record = decision_record(scored_synthetic(spark, sf_dir), KEY)
    return record.withColumn("matched_rule_names", F.array_join("matched_rule_names", ", "))


_SETTINGS = {
    "rules_first": dict(rule_weight=0.8, alert_at=0.3, block_at=0.6),
    "model_first": dict(rule_weight=0.2, alert_at=0.5, block_at=0.9),
    "no_alert": dict(rule_weight=0.5, alert_at=0.7, block_at=0.4),
}


@register(
    "fusion_settings",
    f"{o.rules_prefix()}, {o.SUMMARY}, {o.SYNTHETIC}, "
    + ", ".join(
        o.fused("scored", s["rule_weight"], 1.0 - s["rule_weight"], s["alert_at"], s["block_at"], name)
        for name, s in _SETTINGS.items()
    )
    + " UNION ALL ".join(
        f"\nSELECT '{name}' AS setting, event_id, risk_score, action FROM {name}"
        for name in _SETTINGS
    ),
)
def fusion_settings(spark, sf_dir):
    settings = {name: FusionSettings.from_rule_weight(**s) for name, s in _SETTINGS.items()}
    evaluated = evaluate_rules(full(spark, sf_dir), default_catalog())
    fused = fuse_each(ef.with_synthetic_scores(evaluated), settings)
    return fused.select("setting", *KEY, "risk_score", "action")


# -- results -----------------------------------------------------------------------------

_REPORT = """'' AS src_ip, '' AS dst_ip, 1024 + (event_id * 31) % 60000 AS src_port, dst_port, label,
  action, risk_score, any_match AS rule_matched, matched_rules, anomaly_score AS ml_score, reasoning"""
_TABLE = """action AS "Action", risk_score AS "Risk Score",
  CASE WHEN any_match THEN 'Yes' ELSE 'No' END AS "Rule Hit",
  CASE WHEN any_match THEN matched_rules ELSE 'None' END AS "Matched Rules",
  highest_severity AS "Rule Severity", ml3 AS "ML Score", dst_port AS "Dst Port", label AS "Label\""""


@register(
    "result_cli",
    f"{o.decided(o.RULES_ONLY)} SELECT event_id AS flow_idx, {_REPORT} FROM reasoned",
)
def result_cli(spark, sf_dir):
    return results.report_rows(scored_by_rules(spark, sf_dir), ef.KEY)


@register(
    "result_cli_capped",
    f"""{o.decided(o.RULES_ONLY)} SELECT row_number() OVER (ORDER BY event_id) - 1 AS flow_idx,
      {_REPORT} FROM reasoned ORDER BY event_id LIMIT {REPORT_ROWS}""",
)
def result_cli_capped(spark, sf_dir):
    scored = score_flows(full(spark, sf_dir), key=KEY, cap=REPORT_ROWS)
    return results.report_rows(number_rows(scored, KEY))


@register(
    "result_ui",
    f"""{o.decided(o.SYNTHETIC)} SELECT event_id, {_TABLE}, reasoning AS "Reasoning" FROM reasoned""",
)
def result_ui(spark, sf_dir):
    return results.table_rows(scored_synthetic(spark, sf_dir), KEY)


@register("result_table", f"{o.decided(o.SYNTHETIC)} SELECT event_id, {_TABLE} FROM reasoned")
def result_table(spark, sf_dir):
    return results.table_view(results.table_rows(scored_synthetic(spark, sf_dir), KEY))


@register(
    "csv_roundtrip",
    f"""{o.decided(o.SYNTHETIC)} SELECT event_id, {_TABLE}, reasoning AS "Reasoning" FROM reasoned""",
)
def csv_roundtrip(spark, sf_dir):
    rows = results.table_rows(scored_synthetic(spark, sf_dir), KEY)
    folder = scratch_folder(spark, "csv-roundtrip")
    write_csv(rows, folder)
    back = read_flow_csv(spark, folder)
    # "None" (no matched rule) is a missing cell to the reader.
    return back.withColumns(
        {
            "Matched Rules": F.coalesce("Matched Rules", F.lit("None")),
        }
    )


_CSV_COLUMNS = ["event_id", "duration", "protocol_type", "dst_port", "pkt_count", "label"]


@register(
    "csv_many_files",
    f"WITH {o.flows('core')} SELECT {', '.join(_CSV_COLUMNS)} FROM flows",
)
def csv_many_files(spark, sf_dir):
    """Files that order their columns differently, as one table."""
    folder = scratch_folder(spark, "csv-many")
    flows = core(spark, sf_dir)
    for part, columns in enumerate((_CSV_COLUMNS, _CSV_COLUMNS[::-1], sorted(_CSV_COLUMNS))):
        rows = flows.filter(F.col("event_id") % 3 == part).select(*columns)
        write_csv(rows, f"{folder}/{part}")
    return read_flow_csv(spark, [f"{folder}/{part}" for part in range(3)]).select(*_CSV_COLUMNS)


# -- reports -----------------------------------------------------------------------------

_SHARE = """CASE WHEN total > 0 THEN printf('%.1f%%', {0}_share_v) END AS {0}_share"""


def _totals_sql() -> str:
    shares = ",\n".join(
        o.rounded(f"{n}_share_v", f"CAST({n}s AS DOUBLE) / total * {o.real(100.0)}", 1)
        for n in ("block", "alert", "allow")
    )
    texts = ", ".join(_SHARE.format(n) for n in ("block", "alert", "allow"))
    return f"""{o.decided(o.SYNTHETIC)},
    totals AS (SELECT count(*) AS total, count(*) FILTER (WHERE action = 'BLOCK') AS blocks,
      count(*) FILTER (WHERE action = 'ALERT') AS alerts,
      count(*) FILTER (WHERE action = 'ALLOW') AS allows FROM fused),
    shares AS (SELECT *, {shares} FROM totals)
    SELECT total, blocks, alerts, allows, {texts} FROM shares"""


@register("action_totals", _totals_sql())
def action_totals(spark, sf_dir):
    return reports.action_totals(reports.risk_profile(scored_synthetic(spark, sf_dir)))


@register(
    "action_frequency",
    f"{o.decided(o.SYNTHETIC)} SELECT action, count(*) AS flows FROM fused GROUP BY action",
)
def action_frequency(spark, sf_dir):
    return reports.action_frequency(reports.risk_profile(scored_synthetic(spark, sf_dir)))


@register(
    "label_actions",
    f"{o.decided(o.SYNTHETIC)} SELECT label, action, count(*) AS flows FROM fused GROUP BY label, action",
)
def label_actions(spark, sf_dir):
    return reports.label_actions(scored_synthetic(spark, sf_dir))


@register(
    "detection_counts",
    f"""{o.decided(o.SYNTHETIC)}, told AS (
      SELECT upper(label) LIKE '%BENIGN%' AS benign, action <> 'ALLOW' AS raised FROM fused)
    SELECT count(*) FILTER (NOT benign AND raised) AS true_positives,
      count(*) FILTER (benign AND raised) AS false_positives,
      count(*) FILTER (NOT benign AND NOT raised) AS false_negatives,
      count(*) FILTER (benign AND NOT raised) AS true_negatives FROM told""",
)
def detection_counts(spark, sf_dir):
    return reports.detection_counts(scored_synthetic(spark, sf_dir))


@register(
    "risk_histogram",
    f"""{o.decided(o.SYNTHETIC)},
    ends AS (SELECT min(risk_score) AS mn, max(risk_score) AS mx FROM fused),
    widened AS (SELECT CASE WHEN mn < mx THEN 0 WHEN mn = 0 THEN {o.real(0.001)}
      ELSE abs(mn) * {o.real(0.001)} END AS m, mn - m AS lo, mx + m AS hi, (hi - lo) / 10 AS step FROM ends),
    bins AS (SELECT i + 1 AS bin, i * step + lo AS lower,
      CASE WHEN i = 9 THEN hi ELSE (i + 1) * step + lo END AS upper
      FROM widened, (SELECT unnest(range(10)) AS i))
    SELECT CAST(bin AS INTEGER) AS bin, lower, upper, count(risk_score) AS flows
    FROM bins LEFT JOIN fused ON (risk_score > lower OR bin = 1) AND risk_score <= upper
    GROUP BY bin, lower, upper""",
)
def risk_histogram(spark, sf_dir):
    return reports.risk_histogram(reports.risk_profile(scored_synthetic(spark, sf_dir)))


_RARE = 10


@register(
    "rare_destinations",
    f"""SELECT event_id, count(*) OVER (PARTITION BY user_id) <= {_RARE} AS rare_destination
    FROM events""",
)
def rare_destinations(spark, sf_dir):
    events = ef.read_events(spark, sf_dir).select("event_id", "user_id")
    found = with_rare_destination(events, "user_id", _RARE)
    return found.select("event_id", "rare_destination")


@register(
    "row_counts",
    f"""WITH {o.flows('dirty')} SELECT count(*) AS total_flows,
      count(*) FILTER (WHERE upper(label) LIKE '%BENIGN%') AS benign_flows,
      least(count(*), {REPORT_ROWS}) AS analysed_flows,
      CAST({len(o.SIGNATURES)} AS INTEGER) AS rules_loaded FROM flows""",
)
def row_counts(spark, sf_dir):
    return reports.row_counts(dirty(spark, sf_dir), default_catalog(), REPORT_ROWS)


# -- forest ------------------------------------------------------------------------------

TREES, SEED = 100, 42
_FOREST = o.forest(TREES, SEED)
_SCORES = o.forest_scores(TREES)
_MODEL_SCORED = f"""scored AS (
  SELECT s.*, f.raw_score, f.anomaly_score, f.is_anomaly
  FROM summary s JOIN forest_scored f USING (event_id))"""
_PIPELINE = f"""{o.rules_prefix(recursive=True)}, {o.SUMMARY}, {_FOREST}, {_SCORES}, {_MODEL_SCORED},
  {o.fused('scored')}, {o.REASONED}"""
_PIPELINE_COLUMNS = """event_id, label, dst_port, any_match, highest_severity, matched_rules,
  round(raw_score, 9) AS raw_score, anomaly_score, is_anomaly, rule_score, risk_score, action"""


def _trained(spark, sf_dir):
    return train_model(full(spark, sf_dir), KEY, trees=TREES, seed=SEED).model


def _pipeline_columns(scored):
    return scored.select(
        *KEY, "label", "dst_port", "any_match", "highest_severity",
        F.array_join("rule_names", ", ").alias("matched_rules"),
        F.round("raw_score", 9).alias("raw_score"),
        "anomaly_score", "is_anomaly", "rule_score", "risk_score", "action",
    )


@register(
    "forest_nodes",
    f"""WITH RECURSIVE {o.flows()}, {_FOREST} SELECT CAST(tree_id AS INTEGER) AS tree_id,
      CAST(node_id AS INTEGER) AS node_id, CAST(depth AS INTEGER) AS depth,
      CAST(feature AS INTEGER) AS feature, round(threshold, 12) AS threshold, n_rows FROM nodes""",
)
def forest_nodes(spark, sf_dir):
    nodes = _trained(spark, sf_dir).node_frame(spark)
    return nodes.withColumn("threshold", F.round("threshold", 12))


@register(
    "forest_scores",
    f"""WITH RECURSIVE {o.flows()}, {_FOREST}, {_SCORES}
    SELECT event_id, round(raw_score, 9) AS raw_score, anomaly_score, is_anomaly FROM forest_scored""",
)
def forest_scores(spark, sf_dir):
    """Train, save, load, score with the frozen statistics."""
    folder = scratch_folder(spark, "model")
    save_model(spark, _trained(spark, sf_dir), folder)
    model = load_model(spark, folder)
    scored = score_flows(full(spark, sf_dir), model=model, stats=FROZEN, key=KEY)
    return scored.select(
        *KEY, F.round("raw_score", 9).alias("raw_score"), "anomaly_score", "is_anomaly"
    )


@register("single_flow_scores", f"{_PIPELINE} SELECT {_PIPELINE_COLUMNS} FROM fused")
def single_flow_scores(spark, sf_dir):
    """Flows on the path of a single flow: not cleaned, scaled by the training statistics."""
    scored = score_flows(
        full(spark, sf_dir), model=_trained(spark, sf_dir), stats=FROZEN, key=KEY, cleaned=False
    )
    return _pipeline_columns(scored)


@register("full_pipeline", f"{_PIPELINE} SELECT {_PIPELINE_COLUMNS} FROM fused")
def full_pipeline(spark, sf_dir):
    model = _trained(spark, sf_dir)
    return _pipeline_columns(score_flows(full(spark, sf_dir), model=model, key=KEY))


# -- streams -----------------------------------------------------------------------------

def _event_stream(spark, sf_dir):
    schema = ef.read_events(spark, sf_dir).schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )


@register("stream_frozen", f"{_PIPELINE} SELECT {_PIPELINE_COLUMNS} FROM fused")
def stream_frozen(spark, sf_dir):
    model = _trained(spark, sf_dir)
    scored = score_stream(ef.flows_from_events(_event_stream(spark, sf_dir)), model, key=KEY)
    folder = scratch_folder(spark, "stream-frozen")
    query = (
        _pipeline_columns(scored)
        .writeStream.option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/rows")
    )
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/rows")


@register("stream_batch", f"{_PIPELINE} SELECT {_PIPELINE_COLUMNS} FROM fused")
def stream_batch(spark, sf_dir):
    model = _trained(spark, sf_dir)
    folder = scratch_folder(spark, "stream-batch")
    start_batch_scoring(
        ef.flows_from_events(_event_stream(spark, sf_dir)),
        f"{folder}/rows",
        f"{folder}/checkpoint",
        model,
        prepare=_pipeline_columns,
        key=KEY,
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/rows").drop("batch_id")


@register(
    "stream_running_bounds",
    """SELECT event_type, count(*) AS events, min(value) AS least_value, max(value) AS most_value,
      min(user_id)::DOUBLE AS least_user, max(user_id)::DOUBLE AS most_user FROM events GROUP BY event_type""",
)
def stream_running_bounds(spark, sf_dir):
    """Bounds kept in state per event type; without expiry they are those of all events."""
    folder = scratch_folder(spark, "stream-bounds")
    updates = running_bounds(
        _event_stream(spark, sf_dir), "event_type", "ts", ["value", "user_id"], "1 hour", 10**9
    )
    start_running_bounds(updates, f"{folder}/rows", f"{folder}/checkpoint").awaitTermination()
    last = F.max_by(F.struct("rows", "minima", "maxima"), "rows").alias("last")
    found = spark.read.parquet(f"{folder}/rows").groupBy("group").agg(last)
    return found.select(
        F.col("group").alias("event_type"),
        F.col("last.rows").alias("events"),
        F.col("last.minima")[0].alias("least_value"),
        F.col("last.maxima")[0].alias("most_value"),
        F.col("last.minima")[1].alias("least_user"),
        F.col("last.maxima")[1].alias("most_user"),
    )


# -- requests ----------------------------------------------------------------------------

from checks import profiles as _profiles  # noqa: E402, F401  registers its queries
from checks import requests as _requests  # noqa: E402, F401
