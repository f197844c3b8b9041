"""Signature rules as column predicates.

The catalog compiles to one projection: no shuffle, no join, and only the columns that
the conditions name are read.  The projection yields one bit per rule, packed into
BIGINT words.  Everything else about a flow's matches is read off the words: severity and
confidence by masks, the indices of the matched rules in catalog order by their bits.
What a query does not read is pruned, and past this point a flow is a few words wide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowverdict.functions import sqltext as sql
from flowverdict.functions.pytext import python_text
from flowverdict.operators.compare import STRICT, TYPED, compare_column, compare_values
from flowverdict.operators.rule_index import matched_by_index
from flowverdict.schema import SEVERITIES
from flowverdict.sources.catalog import Condition, Rule

MATCHED = "matched"

# Rules per word; the sign bit stays free.
WORD = 62

# Larger catalogs are not compiled into the plan but travel as data, with the same results.
COMPILED_RULES = 2_000

Types = dict[str, T.DataType]


def column_types(df: DataFrame) -> Types:
    return {f.name: f.dataType for f in df.schema.fields}


def condition_sql(types: Types, condition: Condition, mode: str = STRICT) -> str:
    if condition.field in types:
        return compare_column(
            condition.field, types[condition.field], condition.op, condition.value, mode
        )
    # An absent field counts as 0, which settles the condition here and now.
    return sql.boolean(
        mode != TYPED and compare_values(0, condition.op, condition.value)
    )


def rule_sql(types: Types, rule: Rule, mode: str = STRICT) -> str:
    """All conditions hold; a rule without conditions always matches."""
    return " AND ".join(condition_sql(types, c, mode) for c in rule.conditions) or "true"


def _word(k: int) -> str:
    return f"__rules{k}"


def word_columns(types: Types, rules: list[Rule], mode: str = STRICT) -> list[str]:
    """SQL for the words, each with the outcome of ``WORD`` rules."""
    words = []
    for start in range(0, len(rules), WORD):
        bits = [
            f"IF({rule_sql(types, rule, mode)}, {1 << i}L, 0L)"
            for i, rule in enumerate(rules[start : start + WORD])
        ]
        word = sql.pinned(" | ".join(bits), "0L")
        words.append(f"{word} AS {_word(start // WORD)}")
    return words


def _any_of(indices: list[int]) -> str:
    """Some rule with one of these indices matched."""
    masks: dict[int, int] = {}
    for i in indices:
        masks[i // WORD] = masks.get(i // WORD, 0) | 1 << i % WORD
    tests = [f"({_word(k)} & {mask}L) <> 0L" for k, mask in masks.items()]
    return " OR ".join(tests) or "false"


def _per_rule(values: list[str], index: str) -> str:
    return f"element_at({sql.array(values)}, {index} + 1)"


def summary_columns(rules: list[Rule]) -> list[str]:
    """SQL for any_match, highest_severity, max_confidence, matched, rule_names.

    The largest confidence may belong to another rule than the highest severity.
    """
    severity, confidence = "'NONE'", "0D"
    for s in SEVERITIES:
        test = _any_of([i for i, r in enumerate(rules) if r.severity_or_low == s])
        severity = f"WHEN {test} THEN {sql.text(s)} ELSE {severity} END"
        severity = f"CASE {severity}"
    levels = sorted({r.confidence for r in rules if r.confidence > 0}, reverse=True)
    if levels:
        cases = [
            f"WHEN {_any_of([i for i, r in enumerate(rules) if r.confidence == c])} "
            f"THEN {sql.double(c)}"
            for c in levels
        ]
        confidence = f"CASE {' '.join(cases)} ELSE 0D END"
    found = [f"IF({_any_of([i])}, {i}, -1)" for i in range(len(rules))]
    matched = f"array_remove(CAST({sql.array(found)} AS ARRAY<INT>), -1)"
    names = sql.array([sql.text(r.name) for r in rules] or ["''"])
    return [
        f"{_any_of(list(range(len(rules))))} AS any_match",
        f"{severity} AS highest_severity",
        f"{confidence} AS max_confidence",
        f"{matched} AS {MATCHED}",
        f"transform({MATCHED}, i -> element_at({names}, i + 1)) AS rule_names",
    ]


def match_rules(df: DataFrame, rules: list[Rule], mode: str = STRICT) -> DataFrame:
    """Add the words."""
    return df.selectExpr("*", *word_columns(column_types(df), rules, mode))


def summarise_matches(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Replace the words by what they say."""
    words = [_word(k) for k in range(-(-len(rules) // WORD))]
    return df.selectExpr("*", *summary_columns(rules)).drop(*words)


def match_large(df: DataFrame, rules: list[Rule], mode: str = STRICT) -> DataFrame:
    """Add ``matched`` for a catalog of any size."""
    if mode == TYPED:
        raise ValueError(f"typed comparison is for catalogs of at most {COMPILED_RULES} rules")
    return df.withColumn(MATCHED, matched_by_index(df, rules))


def summarise_large(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """What ``summarise_matches`` adds, looked up in the catalog as data."""
    rank = {s: i for i, s in enumerate(SEVERITIES)}
    table = F.expr(
        sql.array(
            [
                f"struct({rank[r.severity_or_low]} AS rank, {sql.double(max(r.confidence, 0.0))} "
                f"AS confidence, {sql.text(r.name)} AS name)"
                for r in rules
            ]
        )
    )
    found = F.transform(F.array(table), lambda t: F.transform(MATCHED, lambda i: F.get(t, i)))[0]
    df = df.withColumn("__found", found)
    # SEVERITIES goes from low to high where its last entry is the highest.
    names = F.array(*[F.lit(s) for s in SEVERITIES])
    any_match = F.size(MATCHED) > 0
    return df.withColumns(
        {
            "any_match": any_match,
            "highest_severity": F.when(
                any_match, F.element_at(names, F.array_max("__found.rank") + 1)
            ).otherwise("NONE"),
            "max_confidence": F.coalesce(F.array_max("__found.confidence"), F.lit(0.0)),
            "rule_names": F.col("__found.name"),
        }
    ).drop("__found")


def evaluate_rules(df: DataFrame, rules: list[Rule], mode: str = STRICT) -> DataFrame:
    """Add any_match, highest_severity, max_confidence, matched, rule_names."""
    if len(rules) > COMPILED_RULES:
        return summarise_large(match_large(df, rules, mode), rules)
    return summarise_matches(match_rules(df, rules, mode), rules)


def exploded_matches(evaluated: DataFrame, key: list[str] = ()) -> DataFrame:
    """One row (key, rule_idx) per match.

    The outer form plus a null check returns what ``explode`` does.  For ``explode`` the
    optimizer would put a filter on the array's size below the projection that builds it,
    and evaluate the whole catalog twice.
    """
    long = evaluated.select(*key, F.explode_outer(MATCHED).alias("rule_idx"))
    return long.filter(F.col("rule_idx").isNotNull())


def details_sql(types: Types, rule: Rule) -> str:
    """``field op value (actual: x)`` for each condition, joined by ``; ``."""
    parts = []
    for c in rule.conditions:
        actual = "'0'"
        if c.field in types:
            actual = python_text(sql.name(c.field), types[c.field])
        shown = sql.text(f"{c.field} {c.op} {c.value} (actual: ")
        parts.append(f"concat({shown}, {actual}, ')')")
    return f"concat_ws('; ', {', '.join(parts)})" if parts else "''"


def rule_results(
    df: DataFrame,
    rules: list[Rule],
    key: list[str],
    mode: str = STRICT,
    matched_only: bool = False,
    details: bool = False,
) -> DataFrame:
    """One row per flow and rule: key, rule_idx, rule_id, rule_name, category, severity,
    confidence, matched and, on request, details."""
    types = column_types(df)
    found = []
    for i, rule in enumerate(rules):
        test = f"({rule_sql(types, rule, mode)})"
        fields = f"'rule_idx', {i}, 'matched', {test}"
        if details:
            fields += f", 'details', IF({test}, {details_sql(types, rule)}, '')"
        result = f"named_struct({fields})"
        found.append(f"IF({test}, {result}, NULL)" if matched_only else result)
    listed = sql.array(found)
    if matched_only:
        listed = f"array_compact({listed})"
    # Outer for the reason given in exploded_matches.
    long = df.select(*key, F.explode_outer(F.expr(listed)).alias("r"))
    long = long.filter(F.col("r").isNotNull()).select(*key, "r.*")
    confidence = _per_rule([sql.double(r.confidence) for r in rules], "rule_idx")
    looked_up = {
        "rule_id": _per_rule([sql.text(r.rule_id) for r in rules], "rule_idx"),
        "rule_name": _per_rule([sql.text(r.name) for r in rules], "rule_idx"),
        "category": _per_rule([sql.text(r.category_or_general) for r in rules], "rule_idx"),
        "severity": _per_rule([sql.text(r.severity_or_low) for r in rules], "rule_idx"),
        "confidence": f"IF(matched, {confidence}, 0D)",
    }
    return long.selectExpr(
        *key,
        "rule_idx",
        *[f"{e} AS {n}" for n, e in looked_up.items()],
        "matched",
        *(["details"] if details else []),
    )
