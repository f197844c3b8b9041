"""The five sample flows: matched rules, severity, scores and actions are fixed values."""

import pytest
from pyspark.sql import functions as F

from flowverdict import default_catalog, evaluate_rules, score_flows
from flowverdict.operators.features import minmax_frame, with_vector
from flowverdict.operators.fusion import fuse, with_reasoning
from flowverdict.operators.ingest import ingest
from flowverdict.sources.flow_csv import single_flow

HEADERS = [
    "Flow Duration", "Protocol", "Source Port", "Destination Port", "Total Fwd Packets",
    "Total Length of Fwd Packets", "Flow Bytes/s", "Flow Packets/s", "Fwd Packet Length Mean",
    "Bwd Packet Length Mean", "SYN Flag Count", "ACK Flag Count", "FIN Flag Count",
    "RST Flag Count", "PSH Flag Count", "URG Flag Count", "Average Packet Size",
    "Active Mean", "Idle Mean",
]
# One row of inputs per flow, in the order of HEADERS.
FLOWS = {
    "Normal": [50000, 6, 55234, 443, 12, 2400, 480, 8, 200, 180, 1, 10, 1, 0, 3, 0, 200, 1000, 500],
    "Port Scan": [100, 6, 45678, 22, 50, 300, 3000, 500, 6, 0, 48, 0, 2, 1, 0, 0, 6, 50, 10],
    "SYN Flood": [500, 6, 12345, 80, 5000, 30000, 60000, 10000, 6, 0, 4990, 2, 0, 0, 0, 0, 6, 100, 0],
    "Brute Force SSH": [20000, 6, 34567, 22, 200, 8000, 400, 10, 40, 60, 5, 190, 2, 40, 50, 0, 40, 500, 200],
    "Unknown Anomaly": [99999, 17, 44444, 9999, 1500, 999999, 9999, 15, 666, 999, 3, 1400, 0, 0, 200, 15, 666, 99999, 0],
}
EXPECTED = {
    "Normal": (["PROTO-001"], "HIGH", 0.88, 0.66,
               [(0.3630, "ALERT"), (0.7566, "BLOCK"), (0.8241, "BLOCK")]),
    "Port Scan": (["PROTO-001", "PROTO-002", "PROTO-003", "PROBE-001", "PROBE-003"], "HIGH", 0.88, 0.66,
                  [(0.3630, "ALERT"), (0.7566, "BLOCK"), (0.8241, "BLOCK")]),
    "SYN Flood": (["NET-004", "DOS-001"], "CRITICAL", 0.95, 0.95,
                  [(0.5225, "ALERT"), (0.8683, "BLOCK"), (0.9357, "BLOCK")]),
    "Brute Force SSH": (["PROTO-001", "PROTO-002", "PROTO-003"], "HIGH", 0.88, 0.66,
                        [(0.3630, "ALERT"), (0.7566, "BLOCK"), (0.8241, "BLOCK")]),
    "Unknown Anomaly": (["MISC-001"], "MEDIUM", 0.72, 0.36,
                        [(0.1980, "ALLOW"), (0.6373, "ALERT"), (0.7086, "BLOCK")]),
}


@pytest.mark.parametrize("name", list(FLOWS))
def test_demo_flow(spark, name):
    rules = default_catalog()
    flow = ingest(single_flow(spark, dict(zip(HEADERS, FLOWS[name]))), cleaned=False)
    evaluated = evaluate_rules(flow, rules)
    ids, severity, confidence, rule_score, risks = EXPECTED[name]
    for (risk, action), ml in zip(risks, (0.0, 0.6429, 0.8571)):
        scored = evaluated.withColumns({"anomaly_score": F.lit(ml), "is_anomaly": F.lit(ml > 0)})
        row = with_reasoning(fuse(scored)).first()
        assert [rules[i].rule_id for i in row.matched] == ids
        assert (row.highest_severity, row.max_confidence, row.rule_score) == (
            severity, confidence, rule_score)
        assert (row.risk_score, row.action) == (risk, action)
        assert row.reasoning.startswith(f"Rule engine matched {len(ids)} rule(s): ")
        assert row.reasoning.endswith(f"Final risk score: {risk:.2f} → Action: {action}")


def test_one_flow_scales_to_zero(spark):
    """Fitted on itself, a flow has no spread: only the protocol is left in the vector."""
    flow = ingest(single_flow(spark, dict(zip(HEADERS, FLOWS["SYN Flood"]))), cleaned=False)
    vector = with_vector(flow, minmax_frame(flow)).first().features
    assert vector == [0.0, 6.0] + [0.0] * 17


def test_model_scores_single_flow(spark, trained):
    flow = single_flow(spark, dict(zip(HEADERS, FLOWS["SYN Flood"])))
    row = score_flows(flow, model=trained.model, stats="frozen", cleaned=False).first()
    assert row.is_anomaly and row.action == "BLOCK"
    assert 0.5604 <= row.anomaly_score <= 1.0
