"""Risk fusion: rule score and anomaly score -> risk, action and explanation."""

from __future__ import annotations

from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame

from flowverdict import schema
from flowverdict.functions.rounding import round_exact
from flowverdict.functions.sqltext import array, double, pinned, text


@dataclass(frozen=True)
class FusionSettings:
    rule_weight: float = schema.RULE_WEIGHT
    ml_weight: float = schema.ML_WEIGHT
    alert_at: float = schema.ALERT_AT
    block_at: float = schema.BLOCK_AT

    def __post_init__(self) -> None:
        if not abs(self.rule_weight + self.ml_weight - 1.0) < 1e-6:
            raise ValueError("rule_weight and ml_weight must add up to 1")

    @classmethod
    def from_rule_weight(cls, rule_weight: float, **thresholds: float) -> FusionSettings:
        """The anomaly weight is what the rule weight leaves."""
        return cls(rule_weight, 1.0 - rule_weight, **thresholds)


def _choose(column: str, results: dict[str, str], other: str) -> str:
    cases = " ".join(f"WHEN {text(value)} THEN {result}" for value, result in results.items())
    return f"CASE {column} {cases} ELSE {other} END"


def severity_weight(column: str) -> str:
    return _choose(column, {s: double(w) for s, w in schema.SEVERITY_WEIGHTS.items()}, "0D")


def action_for(risk: str, alert_at: str, block_at: str) -> str:
    return (
        f"CASE WHEN {risk} >= {block_at} THEN 'BLOCK' "
        f"WHEN {risk} >= {alert_at} THEN 'ALERT' ELSE 'ALLOW' END"
    )


def fuse(df: DataFrame, settings: FusionSettings = FusionSettings()) -> DataFrame:
    """Needs any_match, highest_severity, max_confidence, anomaly_score, is_anomaly; adds
    rule_score, ml_score, risk_score, action."""
    return _fuse(df, *[double(v) for v in astuple(settings)])


def fuse_each(df: DataFrame, settings: dict[str, FusionSettings]) -> DataFrame:
    """One row per flow and entry of ``settings``, told apart by ``setting``.

    The flows fan out after rules and model, so those run once for all settings.
    """
    names = ["__rule_weight", "__ml_weight", "__alert_at", "__block_at"]
    rows = [
        f"struct({', '.join([text(key), *(double(v) for v in astuple(value))])})"
        for key, value in settings.items()
    ]
    df = df.selectExpr("*", f"inline({array(rows)}) AS (setting, {', '.join(names)})")
    return _fuse(df, *names).drop(*names)


def _fuse(
    df: DataFrame, rule_weight: str, ml_weight: str, alert_at: str, block_at: str
) -> DataFrame:
    weighted = f"{rule_weight} * __rule + {ml_weight} * anomaly_score"
    boost = f"least({double(schema.BOOST_CAP)}, (1D - __base) * {double(schema.BOOST_RATE)})"
    risk = f"IF(any_match AND is_anomaly, {round_exact('__boosted', 4)}, __base)"
    # Each step names the ones before it.
    return df.selectExpr(
        "*",
        f"IF(any_match, {severity_weight('highest_severity')} * max_confidence, 0D) AS __rule",
        f"{weighted} AS __weighted",
        f"least({round_exact('__weighted', 4)}, 1D) AS __base",
        f"__base + {boost} AS __boosted",
        f"{pinned(risk, '0D')} AS risk_score",
        f"{action_for('risk_score', alert_at, block_at)} AS action",
        f"{round_exact('__rule', 4)} AS rule_score",
        f"{round_exact('anomaly_score', 4)} AS ml_score",
    ).drop("__rule", "__weighted", "__base", "__boosted")


def with_reasoning(df: DataFrame) -> DataFrame:
    """Add ``reasoning``, the explanation in one line."""
    rules = (
        "IF(any_match, format_string('Rule engine matched %d rule(s): %s [Severity: %s]', "
        "size(rule_names), array_join(rule_names, ', '), highest_severity), "
        "'No signature rules matched.')"
    )
    model = (
        "format_string('ML model %s (anomaly score: %.2f)', "
        "IF(is_anomaly, 'flagged as anomalous', 'considers traffic normal'), "
        f"{round_exact('anomaly_score', 2)})"
    )
    final = (
        "format_string('Final risk score: %.2f → Action: %s', "
        f"{round_exact('risk_score', 2)}, action)"
    )
    return df.selectExpr("*", f"concat_ws(' | ', {rules}, {model}, {final}) AS reasoning")


def action_color() -> str:
    words = {a: text(c) for a, c in schema.ACTION_COLORS.items()}
    return _choose("action", words, text(schema.OTHER_COLOR))


def action_icon() -> str:
    words = {a: text(i) for a, i in schema.ACTION_ICONS.items()}
    return _choose("action", words, text(schema.OTHER_ICON))


def decision_record(df: DataFrame, key: list[str] = ()) -> DataFrame:
    """The decision record: nine fields plus the color and icon of the action."""
    return with_reasoning(df).selectExpr(
        *key,
        "action",
        "risk_score",
        "rule_score",
        "ml_score",
        "any_match AS rule_matched",
        "rule_names AS matched_rule_names",
        "highest_severity AS rule_severity",
        "anomaly_score AS ml_anomaly_score",
        "reasoning",
        f"{action_color()} AS color",
        f"{action_icon()} AS icon",
    )
