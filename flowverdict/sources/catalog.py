"""Rule catalogs: shipped, from a YAML or JSON file, or from a table."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import cache
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from flowverdict.schema import SEVERITIES
from flowverdict.sources.signatures import SIGNATURE_FILE

# A catalog is held by the driver and travels with the plan; some tens of megabytes.
MAX_CATALOG_RULES = 100_000


@dataclass(frozen=True)
class Condition:
    field: str | None
    op: str | None
    value: Any


@dataclass(frozen=True)
class Rule:
    rule_id: str = "unknown"
    name: str = "Unnamed Rule"
    category: str | None = None
    severity: str | None = None
    confidence: float = 0.8
    conditions: tuple[Condition, ...] = field(default=())

    @property
    def category_or_general(self) -> str:
        """The category a rule result carries."""
        return "General" if self.category is None else self.category

    @property
    def category_or_misc(self) -> str:
        """The category the rule viewer groups by."""
        return "Misc" if self.category is None else self.category

    @property
    def severity_or_low(self) -> str:
        return "LOW" if self.severity is None else self.severity


CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("rule_idx", T.IntegerType(), False),
        T.StructField("rule_id", T.StringType(), False),
        T.StructField("rule_name", T.StringType(), False),
        T.StructField("category", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("confidence", T.DoubleType(), False),
        T.StructField(
            "conditions",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("field", T.StringType()),
                        T.StructField("op", T.StringType()),
                        T.StructField("value", T.StringType()),
                        T.StructField("value_type", T.StringType(), False),
                    ]
                ),
                False,
            ),
            False,
        ),
    ]
)


def default_catalog() -> list[Rule]:
    return list(_shipped())


@cache
def _shipped() -> tuple[Rule, ...]:
    return tuple(load_catalog(SIGNATURE_FILE))


def rules_from_dicts(entries: Iterable[dict]) -> list[Rule]:
    """Rules from plain dictionaries with keys id, name, category, severity, confidence,
    conditions; every key is optional."""
    rules = []
    for entry in entries:
        rule = Rule(
            rule_id=entry.get("id", Rule.rule_id),
            name=entry.get("name", Rule.name),
            category=entry.get("category"),
            severity=entry.get("severity"),
            confidence=float(entry.get("confidence", Rule.confidence)),
            conditions=tuple(
                Condition(c.get("field"), c.get("op"), c.get("value"))
                for c in entry.get("conditions") or ()
            ),
        )
        rules.append(rule)
    return check_catalog(rules)


def check_catalog(rules: list[Rule]) -> list[Rule]:
    if len(rules) > MAX_CATALOG_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_CATALOG_RULES} are served")
    for rule in rules:
        if rule.severity_or_low not in SEVERITIES:
            raise ValueError(f"rule {rule.rule_id}: unknown severity {rule.severity!r}")
    return rules


def load_catalog(path: str | Path, spark: SparkSession | None = None) -> list[Rule]:
    """Read a rule file holding ``rules: [...]`` (YAML, or JSON by its suffix).

    With ``spark`` the path may be any that its readers open; without, a local one.
    """
    if spark is None:
        text = Path(path).read_text(encoding="utf-8")
    else:
        text = spark.read.text(str(path), wholetext=True).first()[0]
    if str(path).endswith(".json"):
        content = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as missing:
            raise ImportError("reading YAML rules needs PyYAML; JSON works without") from missing
        content = yaml.safe_load(text)
    return rules_from_dicts(content.get("rules", []))


def _value_type(value: Any) -> str:
    names = {bool: "bool", int: "int", float: "double", str: "string", type(None): "null"}
    return names.get(type(value), "string")


def catalog_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    rows = [
        (
            i,
            r.rule_id,
            r.name,
            r.category,
            r.severity,
            r.confidence,
            [(c.field, c.op, str(c.value), _value_type(c.value)) for c in r.conditions],
        )
        for i, r in enumerate(rules)
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def catalog_from_frame(df: DataFrame) -> list[Rule]:
    """Rules kept as a table in the layout of ``CATALOG_SCHEMA``."""
    parse = {
        "bool": lambda v: v == "True" or v == "true",
        "int": int,
        "double": float,
        "string": str,
        "null": lambda v: None,
    }
    # One row beyond the bound is enough to see that the table is too large.
    rows = df.orderBy("rule_idx").limit(MAX_CATALOG_RULES + 1).collect()
    return check_catalog(
        [
            Rule(
                r.rule_id,
                r.rule_name,
                r.category,
                r.severity,
                r.confidence,
                tuple(Condition(c.field, c.op, parse[c.value_type](c.value)) for c in r.conditions),
            )
            for r in rows
        ]
    )
