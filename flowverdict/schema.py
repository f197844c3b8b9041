"""Names and constants shared by every stage."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# They decide the results and must stay exactly as they are.
# ---------------------------------------------------------------------------

# Model features, in vector order.
FEATURES = [
    "duration",
    "protocol_type",
    "src_port",
    "dst_port",
    "pkt_count",
    "byte_count",
    "flow_bytes_per_sec",
    "flow_pkts_per_sec",
    "fwd_pkt_len_mean",
    "bwd_pkt_len_mean",
    "syn_flag_count",
    "ack_flag_count",
    "fin_flag_count",
    "rst_flag_count",
    "psh_flag_count",
    "urg_flag_count",
    "avg_pkt_size",
    "active_mean",
    "idle_mean",
]

# CICIDS2017 header -> internal column.
HEADER_NAMES = {
    "Flow Duration": "duration",
    "Protocol": "protocol_type",
    "Source Port": "src_port",
    "Destination Port": "dst_port",
    "Total Fwd Packets": "pkt_count",
    "Total Length of Fwd Packets": "byte_count",
    "Flow Bytes/s": "flow_bytes_per_sec",
    "Flow Packets/s": "flow_pkts_per_sec",
    "Fwd Packet Length Mean": "fwd_pkt_len_mean",
    "Bwd Packet Length Mean": "bwd_pkt_len_mean",
    "SYN Flag Count": "syn_flag_count",
    "ACK Flag Count": "ack_flag_count",
    "FIN Flag Count": "fin_flag_count",
    "RST Flag Count": "rst_flag_count",
    "PSH Flag Count": "psh_flag_count",
    "URG Flag Count": "urg_flag_count",
    "Average Packet Size": "avg_pkt_size",
    "Active Mean": "active_mean",
    "Idle Mean": "idle_mean",
    "Label": "label",
}

# Protocol numbers kept by the encoder (ICMP, TCP, UDP); all others become 0.
KNOWN_PROTOCOLS = [1, 6, 17]

# Severities from mildest to worst, with their weight in the rule score.
SEVERITY_WEIGHTS = {"LOW": 0.25, "MEDIUM": 0.50, "HIGH": 0.75, "CRITICAL": 1.00}

# Anomaly-score scaling: 1 - clip((raw + offset) / span, 0, 1).
SCORE_OFFSET = 0.6
SCORE_SPAN = 0.7
ANOMALY_THRESHOLD = 0.55

# Risk fusion defaults.
RULE_WEIGHT = 0.55
ML_WEIGHT = 0.45
ALERT_AT = 0.35
BLOCK_AT = 0.70
BOOST_CAP = 0.15
BOOST_RATE = 0.3

# Training defaults.
TREES = 100
SEED = 42
CONTAMINATION = 0.05
SAMPLE_ROWS = 256

# Row caps of the two front ends.
REPORT_ROWS = 500

# Words for the presentation of an action.
ACTION_COLORS = {"ALLOW": "green", "ALERT": "orange", "BLOCK": "red"}
ACTION_ICONS = {"ALLOW": "✅", "ALERT": "⚠️", "BLOCK": "🚫"}
OTHER_COLOR = "gray"
OTHER_ICON = "❓"

# ---------------------------------------------------------------------------

SEVERITIES = list(SEVERITY_WEIGHTS)
SCALED_FEATURES = [f for f in FEATURES if f != "protocol_type"]
VECTOR = "features"
