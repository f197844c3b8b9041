"""SQL texts for ``oracle_sql()``, written for DuckDB.

The SQL states the meaning of each query directly: predicates from the condition texts,
aggregates, and tree growing as a recursive query.  It shares only the catalog and the column
formulas with the Spark code.
"""

from __future__ import annotations

import json
import math

from flowverdict.schema import FEATURES, KNOWN_PROTOCOLS, SCALED_FEATURES
from checks.event_flows import CORE_COLUMNS, FLAGS, LABELS, PICKED
from flowverdict.sources.signatures import SIGNATURE_FILE

SIGNATURES = [
    (
        r["id"], r["name"], r["category"], r["severity"], r["confidence"],
        [(c["field"], c["op"], c["value"]) for c in r["conditions"]],
    )
    for r in json.loads(SIGNATURE_FILE.read_text(encoding="utf-8"))["rules"]
]
SQL_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
SEVERITY_RANK = "CASE severity WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'HIGH' THEN 3 ELSE 4 END"
RANK_NAME = (
    "CASE max(rank) WHEN 1 THEN 'LOW' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'HIGH' "
    "WHEN 4 THEN 'CRITICAL' ELSE 'NONE' END"
)
DOUBLE_COLUMNS = {
    "flow_bytes_per_sec", "flow_pkts_per_sec", "avg_pkt_size",
    "fwd_pkt_len_mean", "bwd_pkt_len_mean", "active_mean", "idle_mean",
}


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def real(x: float | str) -> str:
    """A DOUBLE literal (plain decimals would be DECIMAL); names of columns are left alone."""
    return x if isinstance(x, str) else f"CAST({x!r} AS DOUBLE)"


# -- flow tables ---------------------------------------------------------------------

def flow_columns() -> dict[str, str]:
    columns = {}
    for name, (divisor, kind, values) in PICKED.items():
        items = ", ".join(quote(v) if isinstance(v, str) else repr(v) for v in values)
        columns[name] = (
            f"list_extract(CAST([{items}] AS {SQL_TYPES[kind]}[]), "
            f"CAST((event_id // {divisor}) % {len(values)} AS INT) + 1)"
        )
    columns["src_port"] = "1024 + (event_id * 31) % 60000"
    columns["fwd_pkt_len_mean"] = columns["active_mean"] = "value"
    columns["bwd_pkt_len_mean"] = columns["idle_mean"] = "CAST(user_id AS DOUBLE)"
    labels = ", ".join(quote(v) for v in LABELS)
    columns["label"] = f"list_extract([{labels}], CAST(event_id % {len(LABELS)} AS INT) + 1)"
    for j, flag in enumerate(FLAGS):
        columns[flag] = f"event_id % {j % 7 + 2} = 0"
    return columns


def flows(variant: str = "full") -> str:
    """``flows AS (...)``, without the WITH."""
    columns = flow_columns()
    if variant in ("dirty", "cleaned"):
        rate = columns["flow_bytes_per_sec"]
        gone = variant == "cleaned"
        columns["flow_bytes_per_sec"] = (
            f"CASE event_id % 101 WHEN 0 THEN CAST({'0' if gone else chr(39) + 'NaN' + chr(39)} AS DOUBLE) "
            f"WHEN 1 THEN CAST({'0' if gone else chr(39) + 'Infinity' + chr(39)} AS DOUBLE) "
            f"WHEN 2 THEN {'CAST(0 AS DOUBLE)' if gone else 'NULL'} ELSE {rate} END"
        )
        missing = "'0'" if gone else "NULL"
        columns["label"] = f"CASE WHEN event_id % 103 = 0 THEN {missing} ELSE {columns['label']} END"
    if variant == "core":
        kept = CORE_COLUMNS + ["label"]
        columns = {n: columns[n] for n in kept}
    listed = ",\n  ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"flows AS (SELECT event_id,\n  {listed}\nFROM events)"


# -- rules -----------------------------------------------------------------------------

def condition(field: str, op: str, value, available: set[str], typed: bool = False) -> str:
    if field not in available:
        # Absent fields count as 0.
        if typed:
            return "false"
        if isinstance(value, str):
            return "true" if value == "0" else "false"
        return f"0 {op} {int(value)}".replace("==", "=").replace("!=", "<>")
    if field == "http_method":
        sign = "<>" if typed and op == "!=" else "="
        return f"upper(http_method) {sign} {quote(value.upper())}"
    if field in FLAGS:
        assert value is True and op == "=="
        return field
    test = f"{field} {op} {value}".replace("==", "=").replace("!=", "<>")
    if field in DOUBLE_COLUMNS:
        # NaN is above every number in SQL, but compares to none here.
        test = f"(NOT isnan({field}) AND {test})"
    return f"coalesce({test}, false)"


def predicates(variant: str = "full", typed: bool = False) -> list[str]:
    available = set(CORE_COLUMNS) if variant == "core" else set(flow_columns())
    out = []
    for *_, conditions in SIGNATURES:
        out.append(" AND ".join(condition(f, op, v, available, typed) for f, op, v in conditions))
    return out


def catalog() -> str:
    rows = ",\n  ".join(
        f"({i}, {quote(rule_id)}, {quote(name)}, {quote(category)}, {quote(severity)}, {real(conf)})"
        for i, (rule_id, name, category, severity, conf, _) in enumerate(SIGNATURES)
    )
    return (
        "catalog AS (SELECT CAST(i AS INTEGER) AS rule_idx, rule_id, rule_name, category, severity, "
        f"confidence FROM (VALUES\n  {rows}\n) t(i, rule_id, rule_name, category, severity, confidence))"
    )


def tested(variant: str = "full", typed: bool = False) -> str:
    """One row per flow and rule with the outcome."""
    tests = ",\n  ".join(f"({p})" for p in predicates(variant, typed))
    indices = ", ".join(str(i) for i in range(len(SIGNATURES)))
    return (
        f"tested AS (SELECT event_id, unnest([{indices}]) AS rule_idx, unnest([\n  {tests}\n]) "
        "AS matched FROM flows)"
    )


def rules_prefix(variant: str = "full", typed: bool = False, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{flows(variant)},\n{catalog()},\n{tested(variant, typed)}"


SUMMARY = f"""summary AS (
  SELECT f.event_id, any_value(f.label) AS label, any_value(f.dst_port) AS dst_port,
    count(c.rule_idx) AS n_matched, count(c.rule_idx) > 0 AS any_match,
    {RANK_NAME} AS highest_severity,
    coalesce(max(c.confidence), CAST(0 AS DOUBLE)) AS max_confidence,
    coalesce(string_agg(c.rule_name, ', ' ORDER BY c.rule_idx), '') AS matched_rules
  FROM flows f
  LEFT JOIN (
    SELECT t.event_id, c.*, {SEVERITY_RANK} AS rank
    FROM tested t JOIN catalog c USING (rule_idx) WHERE t.matched
  ) c USING (event_id)
  GROUP BY f.event_id)"""


# -- exact rounding ----------------------------------------------------------------------

def rounded(name: str, value: str, digits: int) -> str:
    """Select items that end in ``name``: value rounded half-even on its exact binary value."""
    s = f"CAST(1e{digits} AS DOUBLE)"
    v, h, p, e, w = (f"{name}_{x}" for x in "vhpew")
    return f"""({value}) AS {v}, CAST(CAST({v} AS FLOAT) AS DOUBLE) AS {h}, {v} * {s} AS {p},
    ({h} * {s} - {p}) + ({v} - {h}) * {s} AS {e}, floor({p}) AS {w},
    (CASE WHEN {p} - {w} < 0.5 THEN {w} WHEN {p} - {w} > 0.5 THEN {w} + 1
      WHEN {e} > 0 THEN {w} + 1 WHEN {e} < 0 THEN {w}
      WHEN CAST({w} AS BIGINT) % 2 = 0 THEN {w} ELSE {w} + 1 END) / {s} AS {name}"""


# -- fusion -----------------------------------------------------------------------------

def fused(
    source: str, rule_weight: float | str = 0.55, ml_weight: float | str = 0.45,
    alert_at: float | str = 0.35, block_at: float | str = 0.70, name: str = "fused",
) -> str:
    """``source`` has the summary columns plus anomaly_score and is_anomaly.

    One step per table: an alias used many times is copied each time it is named.
    """
    return f"""{name}_1 AS (
  SELECT *,
    CASE WHEN any_match THEN (CASE highest_severity WHEN 'LOW' THEN {real(0.25)}
      WHEN 'MEDIUM' THEN {real(0.5)} WHEN 'HIGH' THEN {real(0.75)} WHEN 'CRITICAL' THEN {real(1.0)}
      ELSE {real(0.0)} END) * max_confidence ELSE {real(0.0)} END AS rule_part FROM {source}),
{name}_2 AS (
  SELECT *, {real(rule_weight)} * rule_part + {real(ml_weight)} * anomaly_score AS weighted_in
  FROM {name}_1),
{name}_3 AS (SELECT *, {rounded("weighted", "weighted_in", 4)} FROM {name}_2),
{name}_4 AS (SELECT *, least(weighted, {real(1.0)}) AS base FROM {name}_3),
{name}_5 AS (
  SELECT *, base + least({real(0.15)}, ({real(1.0)} - base) * {real(0.3)}) AS boosted_in
  FROM {name}_4),
{name}_6 AS (SELECT *, {rounded("boosted", "boosted_in", 4)} FROM {name}_5),
{name}_7 AS (
  SELECT *, CASE WHEN any_match AND is_anomaly THEN boosted ELSE base END AS risk_score
  FROM {name}_6),
{name} AS (
  SELECT *,
    CASE WHEN risk_score >= {real(block_at)} THEN 'BLOCK'
      WHEN risk_score >= {real(alert_at)} THEN 'ALERT' ELSE 'ALLOW' END AS action,
    {rounded("rule_score", "rule_part", 4)},
    {rounded("ml_score", "anomaly_score", 4)}
  FROM {name}_7)"""


RULES_ONLY = """scored AS (
  SELECT *, CAST(0 AS DOUBLE) AS anomaly_score, false AS is_anomaly FROM summary)"""
SYNTHETIC = f"""scored AS (
  SELECT *, CAST((event_id * 37) % 10001 AS DOUBLE) / {real(10000.0)} AS anomaly_score,
    anomaly_score >= {real(0.55)} AS is_anomaly FROM summary)"""

REASONED = f"""reasoned AS (
  SELECT *,
    {rounded("ml2", "anomaly_score", 2)},
    {rounded("risk2", "risk_score", 2)},
    {rounded("ml3", "anomaly_score", 3)},
    CASE WHEN any_match THEN 'Rule engine matched ' || n_matched || ' rule(s): ' || matched_rules
        || ' [Severity: ' || highest_severity || ']'
      ELSE 'No signature rules matched.' END
    || ' | ' || CASE WHEN is_anomaly THEN 'ML model flagged as anomalous'
      ELSE 'ML model considers traffic normal' END
    || ' (anomaly score: ' || printf('%.2f', ml2) || ') | Final risk score: '
    || printf('%.2f', risk2) || ' → Action: ' || action AS reasoning
  FROM fused)"""


def decided(scored: str, variant: str = "full", typed: bool = False) -> str:
    """Everything up to ``reasoned``; ``scored`` is one of the texts above."""
    return f"{rules_prefix(variant, typed)},\n{SUMMARY},\n{scored},\n{fused('scored')},\n{REASONED}"


# -- features ----------------------------------------------------------------------------

def bounds(source: str = "flows") -> str:
    items = ", ".join(
        f"CAST(min({f}) AS DOUBLE) AS {f}_min, CAST(max({f}) AS DOUBLE) AS {f}_max"
        for f in SCALED_FEATURES
    )
    return f"bounds AS (SELECT {items} FROM {source})"


def scaled(feature: str) -> str:
    if feature == "protocol_type":
        known = ", ".join(str(p) for p in KNOWN_PROTOCOLS)
        return f"CASE WHEN protocol_type IN ({known}) THEN CAST(protocol_type AS DOUBLE) ELSE 0 END"
    lo, hi = f"{feature}_min", f"{feature}_max"
    share = f"(CAST({feature} AS DOUBLE) - {lo}) / ({hi} - {lo})"
    return f"CASE WHEN {lo} = {hi} THEN 0 ELSE least(greatest({share}, 0), 1) END"


def vectors() -> str:
    items = ", ".join(f"CAST(CAST({scaled(f)} AS FLOAT) AS DOUBLE)" for f in FEATURES)
    return f"vectors AS (SELECT event_id, label, [{items}] AS x FROM flows, bounds)"


# -- forest ------------------------------------------------------------------------------

def draw(*tags: str) -> str:
    """``tags`` are SQL expressions; the seed and words come quoted."""
    text = " || ':' || ".join(f"CAST({t} AS VARCHAR)" for t in tags)
    return f"(CAST(('0x' || substr(md5({text}), 1, 13)) AS BIGINT) / {real(2.0**52)})"


MEAN_PATH = (
    f"CASE WHEN n_rows > 2 THEN 2 * (ln(CAST(n_rows AS DOUBLE) - 1) + {real(0.5772156649015329)}) "
    "- 2 * (CAST(n_rows AS DOUBLE) - 1) / n_rows WHEN n_rows = 2 THEN 1 ELSE 0 END"
)


def forest(trees: int, seed: int, sample_rows: int = 256) -> str:
    """``nodes`` and its inputs, for more than 2 x sample_rows training rows or fewer."""
    levels = math.ceil(math.log2(sample_rows))
    seed_sql = quote(str(seed))

    def jump(tree: str) -> str:
        u = draw(seed_sql, "'next'", tree, "event_id")
        return f"{tree} + 1 + CASE WHEN p >= 1 THEN 0 ELSE CAST(floor(ln(1 - {u}) / ln(1 - p)) AS BIGINT) END"

    p = f"least({real(1.0)}, {real(2.0)} * {sample_rows} / (SELECT count(*) FROM benign))"
    parts = [
        bounds(),
        vectors(),
        "benign AS MATERIALIZED (SELECT event_id, x FROM vectors WHERE upper(label) LIKE '%BENIGN%')",
        f"rate AS MATERIALIZED (SELECT {p} AS p)",
        # From one tree that wants a row to the next by geometric jumps.
        f"""wanted AS (
  SELECT event_id, p, {jump("-1")} AS tree_id FROM benign, rate
  UNION ALL
  SELECT event_id, p, {jump("tree_id")} FROM wanted WHERE tree_id < {trees})""",
        f"""sample AS MATERIALIZED (SELECT tree_id, event_id FROM wanted WHERE tree_id < {trees}
  QUALIFY row_number() OVER (PARTITION BY tree_id
    ORDER BY {draw(seed_sql, "'rank'", "tree_id", "event_id")}, CAST(event_id AS VARCHAR)) <= {sample_rows})""",
        "level0 AS MATERIALIZED (SELECT tree_id, 1 AS node_id, x FROM sample JOIN benign USING (event_id))",
    ]
    lows = ", ".join(f"min(x[{i + 1}])" for i in range(len(FEATURES)))
    highs = ", ".join(f"max(x[{i + 1}])" for i in range(len(FEATURES)))
    usable = " || ".join(
        f"(CASE WHEN lo[{i + 1}] < hi[{i + 1}] THEN [{i}] ELSE [] END)" for i in range(len(FEATURES))
    )
    for d in range(levels + 1):
        stop = "true" if d == levels else "n_rows < 2 OR len(usable) = 0"
        parts.append(f"""seen{d} AS MATERIALIZED (
  SELECT tree_id, node_id, count(*) AS n_rows, [{lows}] AS lo, [{highs}] AS hi
  FROM level{d} GROUP BY tree_id, node_id)""")
        parts.append(f"""nodes{d} AS MATERIALIZED (
  SELECT tree_id, node_id, n_rows, CAST({usable} AS INT[]) AS usable,
    CASE WHEN {stop} THEN -1 ELSE usable[1 + CAST(floor(
      {draw(seed_sql, "'feature'", "tree_id", "node_id")} * len(usable)) AS INT)] END AS feature,
    lo[feature + 1] AS low, hi[feature + 1] AS high,
    low + {draw(seed_sql, "'cut'", "tree_id", "node_id")} * (high - low) AS cut,
    CASE WHEN feature < 0 THEN 0 WHEN cut >= high THEN low ELSE cut END AS threshold
  FROM seen{d})""")
        if d < levels:
            parts.append(f"""level{d + 1} AS MATERIALIZED (
  SELECT l.tree_id, 2 * l.node_id + (CASE WHEN l.x[n.feature + 1] <= n.threshold THEN 0 ELSE 1 END)
    AS node_id, l.x
  FROM level{d} l JOIN nodes{d} n USING (tree_id, node_id) WHERE n.feature >= 0)""")
    union = " UNION ALL ".join(
        f"SELECT tree_id, node_id, {d} AS depth, feature, threshold, n_rows FROM nodes{d}"
        for d in range(levels + 1)
    )
    parts.append(f"nodes AS MATERIALIZED ({union})")
    return ",\n".join(parts)


def forest_scores(trees: int, sample_rows: int = 256) -> str:
    """``forest_scored``: raw score, anomaly score and flag of each flow."""
    levels = math.ceil(math.log2(sample_rows))
    parts = [f"walk0 AS (SELECT event_id, x, tree_id, 1 AS node_id, CAST(NULL AS DOUBLE) AS path "
             f"FROM vectors, (SELECT unnest(range({trees})) AS tree_id) t)"]
    for d in range(levels + 1):
        parts.append(f"""walk{d + 1} AS (
  SELECT w.event_id, w.x, w.tree_id,
    CASE WHEN w.path IS NOT NULL OR n.feature < 0 THEN w.node_id
      ELSE 2 * w.node_id + (CASE WHEN w.x[n.feature + 1] <= n.threshold THEN 0 ELSE 1 END) END AS node_id,
    CASE WHEN w.path IS NOT NULL THEN w.path
      WHEN n.feature < 0 THEN n.depth + ({MEAN_PATH}) END AS path
  FROM walk{d} w JOIN nodes n USING (tree_id, node_id))""")
    usual = f"(SELECT {MEAN_PATH} FROM (SELECT {sample_rows} AS n_rows))"
    parts.append(f"""paths AS MATERIALIZED (
  SELECT event_id, -pow({real(2.0)}, -(sum(path) / {trees}) / {usual}) AS raw_score
  FROM walk{levels + 1} GROUP BY event_id)""")
    parts.append(f"""forest_scored AS (
  SELECT event_id, raw_score,
    {rounded("anomaly_score", f"1 - least(greatest((raw_score + {real(0.6)}) / {real(0.7)}, 0), 1)", 4)},
    anomaly_score >= {real(0.55)} AS is_anomaly FROM paths)""")
    return ",\n".join(parts)
