"""Flow records derived from the ``events`` table, for checks and benchmarks.

Every column is a formula over ``event_id`` (or a column of the event), so the same table
can be written in any SQL dialect.  All 61 shipped rules fire on it from 10,000 events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowverdict.schema import HEADER_NAMES

# Column -> (divisor, type, values); the value at position
# (event_id div divisor) mod (number of values).
PICKED = {
    "duration": (1, "bigint", [100, 900, 80000, 4000000, 150]),
    "protocol_type": (5, "bigint", [6, 17, 1, 6, 0]),
    "dst_port": (7, "bigint", [22, 21, 80, 443, 53, 25, 23, 3389, 8080, 55555]),
    "pkt_count": (11, "bigint", [3, 25, 60, 150, 400, 1000]),
    "byte_count": (13, "bigint", [120, 450, 5000, 150000, 999999]),
    "flow_bytes_per_sec": (17, "double", [400.0, 1200.0, 60000.0, 20000000.0]),
    "flow_pkts_per_sec": (19, "double", [5.0, 15.0, 250.0, 600.0, 1500.0]),
    "syn_flag_count": (23, "bigint", [0, 0, 1, 12, 150]),
    "ack_flag_count": (29, "bigint", [0, 1, 4, 10]),
    "fin_flag_count": (31, "bigint", [0, 1, 8]),
    "rst_flag_count": (37, "bigint", [0, 6, 60]),
    "psh_flag_count": (41, "bigint", [0, 2]),
    "urg_flag_count": (43, "bigint", [0, 1, 12]),
    "avg_pkt_size": (47, "double", [50.0, 250.0, 600.0]),
    "fwd_pkt_count": (53, "bigint", [10, 200]),
    "bwd_pkt_count": (59, "bigint", [2, 50]),
    "bwd_byte_count": (61, "bigint", [1000, 2000000, 9000000]),
    "window_size": (67, "bigint", [0, 8192]),
    "http_header_size": (71, "bigint", [300, 9000]),
    "http_response_code": (73, "bigint", [200, 500, 404]),
    "http_method": (79, "string", ["GET", "POST", "PUT", ""]),
}
LABELS = ["BENIGN", "DDoS", "PortScan"]

# Boolean columns; the j-th is true where event_id mod (j mod 7 + 2) = 0.
FLAGS = [
    "any_header_xss", "blind_cmdi_pattern", "blind_sqli_pattern", "content_length_anomaly",
    "double_encoded_traversal", "encoded_redirect", "error_sqli_pattern",
    "event_handler_xss", "http_method_connect", "http_method_trace", "lfi_pattern",
    "null_byte_pattern", "path_traversal_pattern", "post_body_cmdi", "post_body_sqli",
    "post_body_xss", "rare_destination", "redirect_external", "response_time_abnormal",
    "shell_metachar_pattern", "ssrf_dns_rebind", "ssrf_internal_ip", "ssrf_loopback_ref",
    "ssrf_metadata_endpoint", "time_sqli_pattern", "transfer_encoding_anomaly",
    "unicode_xss_payload", "union_sqli_pattern", "url_fragment_xss", "url_param_cmdi",
    "url_param_redirect", "url_param_sqli", "url_param_xss",
]

CORE_COLUMNS = [
    "duration", "protocol_type", "dst_port", "pkt_count", "byte_count",
    "flow_bytes_per_sec", "flow_pkts_per_sec", "syn_flag_count", "ack_flag_count",
    "fin_flag_count", "rst_flag_count", "psh_flag_count", "urg_flag_count", "avg_pkt_size",
]
KEY = "event_id"


def _pick(divisor: int, kind: str, values: list) -> str:
    items = ", ".join(f"'{v}'" if kind == "string" else f"CAST({v} AS {kind})" for v in values)
    return f"element_at(array({items}), CAST((event_id div {divisor}) % {len(values)} AS INT) + 1)"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def flows_from_events(events: DataFrame) -> DataFrame:
    """All columns the rules and the model can use."""
    columns = {name: _pick(*spec) for name, spec in PICKED.items()}
    columns["src_port"] = "1024 + (event_id * 31) % 60000"
    columns["fwd_pkt_len_mean"] = columns["active_mean"] = "value"
    columns["bwd_pkt_len_mean"] = columns["idle_mean"] = "CAST(user_id AS DOUBLE)"
    columns["label"] = _pick(1, "string", LABELS)
    for j, flag in enumerate(FLAGS):
        columns[flag] = f"event_id % {j % 7 + 2} = 0"
    return events.selectExpr(KEY, *[f"{e} AS {n}" for n, e in columns.items()])


def core_flows(events: DataFrame) -> DataFrame:
    """Only mapped features: the external rule columns are absent."""
    return flows_from_events(events).select(KEY, *CORE_COLUMNS, "label")


def dirty_flows(events: DataFrame) -> DataFrame:
    """The full table with NaN, Infinity and null in flow_bytes_per_sec and null labels."""
    flows = flows_from_events(events)
    remainder = F.col(KEY) % 101
    rate = (
        F.when(remainder == 0, float("nan"))
        .when(remainder == 1, float("inf"))
        .when(remainder == 2, None)
        .otherwise(F.col("flow_bytes_per_sec"))
    )
    label = F.when(F.col(KEY) % 103 != 0, F.col("label"))
    return flows.withColumns({"flow_bytes_per_sec": rate, "label": label})


def raw_headers(flows: DataFrame) -> DataFrame:
    """The same flows under the padded headers of a CICIDS2017 file."""
    headers = {name: f" {header}" for header, name in HEADER_NAMES.items()}
    return flows.toDF(*[headers.get(c, c) for c in flows.columns])


def with_synthetic_scores(df: DataFrame) -> DataFrame:
    """Anomaly scores by formula, to check fusion apart from the model."""
    score = ((F.col(KEY) * 37) % 10001).cast("double") / 10000.0
    df = df.withColumns({"raw_score": F.lit(0.0), "anomaly_score": score})
    return df.withColumn("is_anomaly", F.col("anomaly_score") >= 0.55)


