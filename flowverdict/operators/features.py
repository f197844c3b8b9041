"""Identity columns, min-max statistics and the model's feature vector."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowverdict.functions import sqltext as sql
from flowverdict.functions.pytext import python_text
from flowverdict.schema import FEATURES, KNOWN_PROTOCOLS, SCALED_FEATURES, VECTOR

# feature -> (min, max)
Stats = Mapping[str, tuple[float, float]]

_STATS = "__stats"


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def identity_columns(df: DataFrame) -> dict[str, str]:
    """SQL for label, src_ip, dst_ip, protocol as text; src_port, dst_port as whole
    numbers."""
    types = _types(df)

    def shown(name: str, default: str) -> str:
        return python_text(name, types[name]) if name in types else sql.text(default)

    def whole(name: str) -> str:
        # Doubles lose their fraction, towards zero; text has to read as a whole number.
        return f"CAST({name if name in types else 0} AS BIGINT)"

    return {
        "label": shown("label", "UNKNOWN"),
        "src_ip": shown("src_ip", ""),
        "dst_ip": shown("dst_ip", ""),
        "src_port": whole("src_port"),
        "dst_port": whole("dst_port"),
        "protocol": shown("protocol_type", ""),
    }


def feature_values(df: DataFrame) -> dict[str, str]:
    """SQL for each feature present, as a double; text that does not read as a number is
    an error."""
    types = _types(df)
    values = {}
    for f in FEATURES:
        if f in types:
            values[f] = f"CAST({f} AS DOUBLE)"
            if isinstance(types[f], T.StringType):
                problem = f"concat('{f} is not a number: ', {f})"
                values[f] = f"coalesce(try_cast({f} AS DOUBLE), raise_error({problem}))"
    return values


def minmax_columns(df: DataFrame) -> list[str]:
    """``<feature>_min`` and ``<feature>_max`` of each feature present, as aggregates."""
    values = feature_values(df)
    return [
        f"{bound}({values[f]}) AS {f}_{bound}"
        for f in SCALED_FEATURES
        if f in values
        for bound in ("min", "max")
    ]


def minmax_frame(df: DataFrame) -> DataFrame:
    """The bounds of ``minmax_columns`` as a table of one row."""
    return df.agg(*[F.expr(e) for e in minmax_columns(df)])


def stats_from_row(row: Mapping, earlier: Stats | None = None) -> dict[str, tuple[float, float]]:
    """Statistics from the single row of ``minmax_frame``; a feature absent from this fit
    keeps the statistics of an ``earlier`` one."""
    stats = dict(earlier or {})
    for f in SCALED_FEATURES:
        if f"{f}_min" in row:
            stats[f] = (row[f"{f}_min"], row[f"{f}_max"])
    return stats


def _scaled(value: str, low: str, high: str) -> str:
    share = f"({value} - {low}) / nullif({high} - {low}, 0D)"
    return f"IF({low} = {high}, 0D, least(greatest({share}, 0D), 1D))"


def feature_columns(df: DataFrame, bounds: dict[str, tuple[str, str]]) -> dict[str, str]:
    """SQL for each feature scaled to [0, 1]; a feature without statistics is only
    clipped, the protocol is encoded."""
    known = ", ".join(sql.double(p) for p in KNOWN_PROTOCOLS)
    out = {}
    for f, value in feature_values(df).items():
        if f == "protocol_type":
            out[f] = f"IF({value} IN ({known}), {value}, 0D)"
        else:
            out[f] = _scaled(value, *bounds.get(f, ("0D", "1D")))
    return out


def vector_column(columns: dict[str, str]) -> str:
    return sql.array([f"CAST({columns[f]} AS FLOAT)" for f in FEATURES])


def with_bounds(
    df: DataFrame, stats: Stats | DataFrame | None
) -> tuple[DataFrame, dict[str, tuple[str, str]]]:
    """Make statistics available to the rows of ``df``.

    Known statistics become literals.  A ``minmax_frame`` becomes a scalar subquery: it
    runs once, its single row is inlined into the scan's projection, and it disappears
    from the plan when nothing reads the feature vector.
    """
    if isinstance(stats, DataFrame):
        fitted = [c[: -len("_min")] for c in stats.columns if c.endswith("_min")]
        df = df.withColumn(_STATS, stats.select(F.struct(*stats.columns)).scalar())
        return df, {f: (f"{_STATS}.{f}_min", f"{_STATS}.{f}_max") for f in fitted}
    return df, {f: (sql.double(lo), sql.double(hi)) for f, (lo, hi) in (stats or {}).items()}


def with_vector(df: DataFrame, stats: Stats | DataFrame | None) -> DataFrame:
    """Add the float vector ``features``."""
    df, bounds = with_bounds(df, stats)
    vector = F.expr(vector_column(feature_columns(df, bounds)))
    return df.withColumn(VECTOR, vector).drop(_STATS)
