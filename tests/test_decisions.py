"""Rule semantics, budget cut and scenarios."""

import json

import pytest
from pyspark.sql import functions as F

from offerloom.operators import rules as R
from offerloom.operators import scenario
from offerloom.operators.budget import apply_budget
from offerloom.plans.programme import Programme
from offerloom.sources.controls import RULE_SCHEMA, Offer

NAN = float("nan")
ROWS = [
    ("at_risk", 0.5, 3, 10),
    (None, None, None, None),
    ("new", NAN, 0, 0),
]
SCHEMA = "segment string, score_max double, redemptions_60d long, recency_today int"


def held(spark, field, op, value):
    df = spark.createDataFrame(ROWS, SCHEMA).coalesce(1)
    return [r[0] for r in df.select(R.compile_condition({"field": field, "op": op, "value": value})).collect()]


@pytest.mark.parametrize(
    "field, op, value, want",
    [
        ("score", ">=", 0.5, [True, False, False]),
        ("score", ">", 0.5, [False, False, False]),
        ("score", "<=", 0.5, [True, False, False]),
        ("score", "<", 0.6, [True, False, False]),
        ("score", "=", 0.5, [True, False, False]),
        ("score", "!=", 0.5, [False, True, True]),
        ("segment", "=", "at_risk", [True, False, False]),
        ("segment", "!=", "at_risk", [False, True, True]),
        ("segment", ">=", "b", [False, False, True]),
        ("segment", ">=", 3, [False, False, False]),
        ("segment", "!=", 3, [True, True, True]),
        ("segment", "=", 3, [False, False, False]),
        ("redemptions_60d", ">=", "3", [False, False, False]),
        ("redemptions_60d", "!=", "3", [True, True, True]),
        ("redemptions_60d", ">=", 2.5, [True, False, False]),
        ("recency_today", "<", 10, [False, False, True]),
        ("recency_today", "=", None, [False, True, False]),
        ("recency_today", "!=", None, [True, False, True]),
        ("recency_today", "<", None, [False, False, False]),
        ("score", "~", 0.5, [False, False, False]),
    ],
)
def test_conditions(spark, field, op, value, want):
    assert held(spark, field, op, value) == want


def test_unknown_field_is_an_error(spark):
    with pytest.raises(KeyError):
        R.compile_condition({"field": "mood", "op": "=", "value": 1})


def table(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows, 1)], RULE_SCHEMA)


def when(*conditions):
    return json.dumps([{"field": f, "op": o, "value": v} for f, o, v in conditions])


def test_first_active_rule_wins(spark):
    rules = table(
        spark,
        (0, "off", False, "[]", "bonus", 1),
        (2, "second", True, when(("segment", "=", "at_risk")), "mission", 2),
        (1, "first", True, when(("segment", "=", "at_risk"), ("score", ">=", 0.4)), "best_ml", 3),
    )
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {(r.segment, r.rule, r.action, r.action_level) for r in R.match_rules(df, rules).collect()}
    assert got == {("at_risk", "first", "best_ml", 3), (None, "no_rule", "no_offer", 1), ("new", "no_rule", "no_offer", 1)}


def test_no_rules_at_all(spark):
    got = R.match_rules(spark.createDataFrame(ROWS, SCHEMA), table(spark, (1, "x", False, "[]", "bonus", 1)))
    assert {r.rule for r in got.collect()} == {"no_rule"}


CATALOG = [Offer("cashback", False, 100), Offer("mission", True, 20)]


def test_inactive_type_is_barred_from_best_only(spark):
    schema = (
        "customer_id long, segment string, rule string, action string, action_level int, "
        "candidates array<struct<offer_type:string,level:int,active:boolean,p_accept:double,cost:int>>"
    )
    scores = [("cashback", 1, False, 0.9, 100), ("mission", 1, True, 0.4, 20), ("mission", 2, True, 0.5, 40)]
    rows = [
        (1, "s", "r", "best_ml", 1, scores),
        (2, "s", "r", "cashback", 1, scores),
        (3, "s", "r", "no_offer", 1, scores),
        (4, "s", "r", "gift", 1, scores),
        (5, "s", "r", "best_ml", 3, scores),
    ]
    got = {r.customer_id: (r.offer_type, r.p_accept, r.cost) for r in R.resolve_action(spark.createDataFrame(rows, schema), CATALOG).collect()}
    assert got == {
        1: ("mission", 0.4, 20),
        2: ("cashback", 0.9, 100),
        3: ("no_offer", 0.0, 0),
        4: ("gift", 0.0, 0),
        5: ("no_offer", 0.0, 0),
    }


DECISION = "customer_id long, segment string, offer_type string, p_accept double, cost int"


def served(spark, rows, budgets):
    limits = spark.createDataFrame(budgets, "segment string, budget long")
    got = apply_budget(spark.createDataFrame(rows, DECISION), limits).collect()
    return {r.customer_id for r in got if r.eligible}, got


def test_budget_is_a_prefix(spark):
    rows = [(1, "a", "x", 0.9, 60), (2, "a", "x", 0.8, 50), (3, "a", "x", 0.7, 30), (4, "a", "no_offer", 0.0, 0), (5, "b", "x", 0.9, 1)]
    got, all_rows = served(spark, rows, [("a", 100)])
    assert got == {1}
    assert sorted(r.customer_id for r in all_rows) == [1, 2, 3, 4, 5]
    assert served(spark, rows, [("a", 110)])[0] == {1, 2}


def test_ties_go_to_the_smaller_customer_and_more_budget_never_hurts(spark):
    rows = [(i, "a", "x", 0.5, 10) for i in range(200)]
    small, big = served(spark, rows, [("a", 500)])[0], served(spark, rows, [("a", 990)])[0]
    assert small == set(range(50)) and small < big


def test_spend_stays_within_budget(spark, folder):
    p = Programme(spark, folder)
    spent = p.final_offers.filter("eligible").groupBy("segment").agg(F.sum("cost").alias("spent"))
    assert spent.join(p.budgets, "segment").filter("spent > budget").count() == 0


def test_known_outcome_of_the_small_set(spark, folder):
    p = Programme(spark, folder)
    got = {r.rule: r["count"] for r in p.matched.groupBy("rule").count().collect()}
    assert [got.get(r.name, 0) for r in p.rules.orderBy("priority").collect()] == [0, 2, 0, 46, 95, 1, 6]
    hit = {r.segment: r.n for r in p.final_offers.filter("eligible").groupBy("segment").agg(F.count("*").alias("n")).collect()}
    assert hit == {"active": 28, "at_risk": 12, "champion": 6, "new": 1}


def test_shifted_thresholds_keep_bounds_and_other_conditions(spark):
    rules = table(spark, (1, "x", True, when(("segment", "=", "new"), ("score", ">=", 0.95), ("recency_today", "<", 30)), "bonus", 1))
    moved = json.loads(R.shift_thresholds(rules, 0.2).first().conditions)
    assert [c["value"] for c in moved] == ["new", 1.0, 30]


def test_violations(spark):
    rules = table(
        spark,
        (1, "json", True, '[{"field":"segment"', "bonus", 1),
        (1, "object", True, '{"field":"segment"}', "bonus", 1),
        (1, "field", True, when(("mood", "=", 1)), "bonus", 1),
        (1, "action", True, "[]", "gift", 1),
        (None, "many", True, "[]", "bonus", 4),
        (1, "fine", True, "", "bonus", 3),
    )
    got = sorted((r.name, r.violation) for r in R.rule_violations(rules).collect())
    assert got == [
        ("action", "unknown action"),
        ("field", "unknown field"),
        ("json", "conditions are not a JSON list"),
        ("many", "level out of range"),
        ("many", "priority is missing"),
        ("object", "conditions are not a JSON list"),
    ]


def test_kpis_round_half_even_and_survive_no_offers(spark):
    rows = [("x", 0.5, 10), ("no_offer", 0.0, 0)] + [("no_offer", 0.0, 0)] * 6
    df = spark.createDataFrame(rows, "final_offer string, p_accept double, cost int")
    got = scenario.scenario_kpis(df).first()
    assert (got.customers, got.served, got.coverage_pct, got.expected_acceptances) == (8, 1, 12.5, 0)
    none = scenario.scenario_kpis(df.filter("final_offer = 'no_offer'")).first()
    assert (none.served, none.mean_p, none.points_spent) == (0, 0.0, 0)
