"""Eligibility rules as one column expression.

Conditions are JSON lists of {field, op, value}; all must hold, an empty list
matches everyone, and the first active rule by priority wins.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from offerloom.functions.scalars import choose
from offerloom.sources.controls import ACTIONS, Offer, active_rules, control_rows
from offerloom.sources.fixtures import BEST_ML, LEVELS, NO_OFFER, NO_RULE

# Fields a condition may name, with the column and whether it holds text.
FIELDS = {
    "segment": ("segment", "text"),
    "score": ("score_max", "double"),
    "redemptions_60d": ("redemptions_60d", "integer"),
    "recency_today": ("recency_today", "integer"),
    "redemptions_total": ("redemptions_total", "integer"),
    "points_accumulated": ("points_accumulated", "integer"),
}
OPERATORS = ("=", "!=", ">=", "<=", ">", "<")
CONDITION_TYPE = "array<struct<field:string,op:string,value:string>>"


def compile_condition(condition: Mapping[str, object]) -> Column:
    """A condition as a column that is never NULL.

    A missing or NaN number fails every comparison but `!=`; a literal of the
    wrong kind is unequal and never ordered; an unknown operator is false.
    """
    field, op, value = condition["field"], condition["op"], condition["value"]
    if field not in FIELDS:
        raise KeyError(f"unknown field: {field}")
    name, kind = FIELDS[field]
    col, never = F.col(name), F.lit(False)
    if op not in OPERATORS:
        return never
    if value is None:
        return {"=": col.isNull(), "!=": col.isNotNull()}.get(op, never)
    number = isinstance(value, (bool, int, float))
    if number != (kind != "text") or isinstance(value, (list, dict)):
        return F.lit(op == "!=")
    literal = F.lit(int(value) if isinstance(value, bool) else value)
    if op == "=":
        return F.coalesce(col == literal, never)
    if op == "!=":
        return ~col.eqNullSafe(literal)
    compared = {">=": col >= literal, "<=": col <= literal, ">": col > literal, "<": col < literal}[op]
    held = F.coalesce(compared, never)
    return held & ~F.isnan(col) if kind == "double" else held


def compile_rules(rules: Sequence[Row]) -> Column:
    """The first matching rule as a struct (rule, action, action_level)."""

    def outcome(rule: str, action: str, level: int) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"),
            F.lit(action).alias("action"),
            F.lit(int(level)).cast("int").alias("action_level"),
        )

    chain = None
    for r in rules:
        if r.conditions is None:
            raise ValueError(f"rule {r.name!r} has no list of conditions; a rule for everyone has an empty one")
        test = F.lit(True)
        for condition in json.loads(r.conditions or "[]"):
            test = test & compile_condition(condition)
        chain = (F if chain is None else chain).when(test, outcome(r.name, r.action, r.action_level))
    otherwise = outcome(NO_RULE, NO_OFFER, 1)
    return otherwise if chain is None else chain.otherwise(otherwise)


def match_rules(customers: DataFrame, rules: DataFrame) -> DataFrame:
    """Rule, action and level of each customer; needs `score_max` and the base columns.

    The rules become one expression, which suits the short lists that people edit;
    `rule_index.match_rules_indexed` takes lists of any length.
    """
    won = compile_rules(control_rows(active_rules(rules)))
    return customers.withColumn("won", won).select(*customers.columns, "won.*")


def resolve_action(matched: DataFrame, catalog: Sequence[Offer], keys: Sequence[str] = ("customer_id",)) -> DataFrame:
    """Turn each customer's action into an offer with probability and cost.

    `matched` carries the customer's `candidates`, so this is a projection.
    Inactive types are barred from the best choice only; ties go to the cheaper
    type.
    """
    action = F.col("action")
    here = F.filter("candidates", lambda c: c["level"] == F.col("action_level"))
    likeliest = lambda c: F.struct((-c["p_accept"]).alias("neg_p"), c["cost"], c["offer_type"])
    best = F.array_min(F.transform(F.filter(here, lambda c: c["active"]), likeliest))
    named = F.array_max(F.transform(F.filter(here, lambda c: c["offer_type"] == action), lambda c: c["p_accept"]))
    got = matched.withColumns(
        {"best": F.when(action == BEST_ML, best), "named_p": F.when(~action.isin(BEST_ML, NO_OFFER), named)}
    )
    offer = F.when(action == BEST_ML, F.coalesce("best.offer_type", F.lit(NO_OFFER))).otherwise(action)
    p = F.coalesce(-F.col("best.neg_p"), F.col("named_p"), F.lit(0.0))
    resolved = got.select(
        *keys, "segment", "rule", offer.alias("offer_type"), F.col("action_level").alias("level"), p.alias("p_accept")
    )
    base_cost = {o.offer_type: o.base_cost for o in catalog}
    cost = (choose(F.col("offer_type"), base_cost, 0) * F.col("level")).cast("int")
    return resolved.withColumn("cost", cost)


def parsed_conditions(rules: DataFrame) -> DataFrame:
    """Rules with their conditions as structs, and which keys each condition has."""
    keys = F.transform(F.from_json("conditions", "array<map<string,string>>"), F.map_keys)
    return rules.withColumns({"parsed": F.from_json("conditions", CONDITION_TYPE), "keys": keys})


def rules_text(rules: DataFrame) -> DataFrame:
    """Each rule with its conditions in words."""
    one = lambda c: F.concat_ws(" ", c["field"], c["op"], c["value"])
    text = F.array_join(F.transform("parsed", one), " and ")
    shown = F.when(F.size("parsed") > 0, text).otherwise("any customer")
    return parsed_conditions(rules).withColumn("condition_text", shown).drop("parsed", "keys")


def rule_violations(rules: DataFrame) -> DataFrame:
    """One row per rule and problem that would keep the rule from being used."""
    known = F.array(*[F.lit(f) for f in FIELDS])
    without = lambda key: listed & F.coalesce(F.exists("keys", lambda k: ~F.array_contains(k, key)), F.lit(False))
    empty = F.trim(F.coalesce("conditions", F.lit(""))) == ""
    listed = F.col("conditions").rlike(r"(?s)^\s*\[.*\]\s*$")
    checks = {
        "conditions are not a JSON list": ~empty & (F.col("parsed").isNull() | ~listed),
        "field is missing": listed & F.coalesce(F.exists("parsed", lambda c: c["field"].isNull()), F.lit(False)),
        "value is missing": without("value"),
        "unknown field": F.coalesce(F.exists("parsed", lambda c: ~F.array_contains(known, c["field"])), F.lit(False)),
        "unknown operator": listed
        & F.coalesce(F.exists("parsed", lambda c: ~F.coalesce(c["op"].isin(*OPERATORS), F.lit(False))), F.lit(False)),
        "unknown action": ~F.coalesce(F.col("action").isin(*ACTIONS), F.lit(False)),
        "level out of range": ~F.coalesce(F.col("action_level").between(min(LEVELS), max(LEVELS)), F.lit(False)),
        "priority is missing": F.col("priority").isNull(),
    }
    found = F.array_compact(F.array(*[F.when(bad, F.lit(text)) for text, bad in checks.items()]))
    return parsed_conditions(rules).select("id", "name", F.explode(found).alias("violation"))


def shift_thresholds(rules: DataFrame, delta: float) -> DataFrame:
    """Rules with every score threshold moved by `delta`, kept in 0..1 and 3 decimals.

    Conditions stay JSON values: null, text, quotes and unknown keys are what they
    were. A list that cannot be read stays as it is, for `rule_violations` to report.
    """

    def moved(text: str | None) -> str | None:
        try:
            conditions = json.loads(text or "")
        except ValueError:
            return text
        for c in conditions if isinstance(conditions, list) else []:
            if isinstance(c, dict) and c.get("field") == "score" and type(c.get("value")) in (int, float):
                shifted = min(max(Decimal(repr(c["value"])) + Decimal(repr(delta)), Decimal(0)), Decimal(1))
                c["value"] = float(shifted.quantize(Decimal("0.001"), ROUND_HALF_UP))
        return json.dumps(conditions, ensure_ascii=False)

    rows = [(*r,) for r in control_rows(rules)]
    at = rules.columns.index("conditions")
    return rules.sparkSession.createDataFrame([(*r[:at], moved(r[at]), *r[at + 1 :]) for r in rows], rules.schema)
