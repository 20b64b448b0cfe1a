"""Indexed matching of long rule lists equals the expression of the short one."""

import json
import random

import pytest

from offerloom.operators import rule_index, rules
from offerloom.sources import controls

FIELDS = ["segment", "score", "redemptions_60d", "recency_today", "redemptions_total", "points_accumulated"]
CUSTOMERS = (
    "customer_id long, segment string, score_max double, redemptions_60d long, recency_today int, redemptions_total long, "
    "points_accumulated long"
)


def random_value(rng, field):
    if rng.random() < 0.06:
        return rng.choice([None, "text", 3, [1], True, {"a": 1}])
    if field == "segment":
        return rng.choice(["new", "champion", "at_risk", "active", "é", "zz", ""])
    return round(rng.random(), 2) if field == "score" else rng.choice([rng.randrange(12), rng.randrange(12) + 0.5, -1])


def random_rules(rng, n):
    out = []
    for k in range(n):
        conditions = []
        for _ in range(rng.randint(1, 4)):
            field = rng.choice(FIELDS)
            op = rng.choice(["=", "!=", ">=", "<=", ">", "<", "<", ">", "like"] if rng.random() < 0.1 else ["=", "=", ">=", "<=", ">", "<", "!="])
            conditions.append({"field": field, "op": op, "value": random_value(rng, field)})
        out.append((k, rng.randrange(n), f"r{k}", rng.random() < 0.9, json.dumps(conditions), "best_ml", rng.randint(1, 3)))
    return out


def random_customers(rng, n):
    maybe = lambda x: None if rng.random() < 0.05 else x
    return [
        (
            k,
            maybe(rng.choice(["new", "champion", "at_risk", "active", "é", "zzz", ""])),
            maybe(float("nan") if rng.random() < 0.05 else round(rng.random(), 2)),
            *[maybe(rng.randrange(12)) for _ in range(4)],
        )
        for k in range(n)
    ]


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("block, part", [(1024, 1 << 25), (7, 1 << 25), (5, 1)])
def test_equals_the_expression(spark, block, part):
    rng = random.Random(block)
    table = spark.createDataFrame(random_rules(rng, 60), controls.RULE_SCHEMA)
    customers = spark.createDataFrame(random_customers(rng, 400), CUSTOMERS)
    want = rules.match_rules(customers, table)
    got = rule_index.match_rules_indexed(customers, table, block, part)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_no_rules_and_rules_for_everyone(spark):
    rng = random.Random(3)
    customers = spark.createDataFrame(random_customers(rng, 30), CUSTOMERS)
    for rule_rows in ([], [(1, 1, "all", True, "[]", "bonus", 2)], [(1, 1, None, True, "", "bonus", 2), (2, 2, "x", True, "[]", "discount", 1)]):
        table = spark.createDataFrame(rule_rows, controls.RULE_SCHEMA)
        assert rows(rule_index.match_rules_indexed(customers, table)) == rows(rules.match_rules(customers, table))


def test_faults_are_errors(spark):
    customers = spark.createDataFrame(random_customers(random.Random(3), 3), CUSTOMERS)
    bad = '[{"field":"mood","op":"=","value":1}]'
    for conditions, error in ((bad, KeyError), (None, ValueError)):
        table = spark.createDataFrame([(1, 1, "x", True, conditions, "bonus", 1)], controls.RULE_SCHEMA)
        with pytest.raises(error):
            rule_index.match_rules_indexed(customers, table)


def test_fifty_thousand_rules(spark):
    """Thresholds and texts by the thousand; the plain evaluation is a loop over the rules."""
    rng = random.Random(5)
    rule_rows = []
    for k in range(50_000):
        low, high = sorted(rng.randrange(10**6) for _ in range(2))
        conditions = [{"field": "points_accumulated", "op": ">=", "value": low}, {"field": "points_accumulated", "op": "<", "value": low + 40}]
        conditions.append({"field": "segment", "op": "=", "value": f"s{high % 3}"})
        rule_rows.append((k, k, f"r{k}", True, json.dumps(conditions), "best_ml", k % 3 + 1))
    table = spark.createDataFrame(rule_rows, controls.RULE_SCHEMA)
    people = [(k, f"s{rng.randrange(3)}", 0.5, 1, 1, 1, rng.randrange(10**6)) for k in range(300)]
    got = {r["customer_id"]: r["rule"] for r in rule_index.match_rules_indexed(spark.createDataFrame(people, CUSTOMERS), table).collect()}
    plain = [(json.loads(r[4]), r[2]) for r in rule_rows]
    for k, segment, *_, points in people:
        want = next((n for c, n in plain if c[0]["value"] <= points < c[1]["value"] and c[2]["value"] == segment), "no_rule")
        assert got[k] == want
    assert len(set(got.values())) > 100


def test_missing_keys_are_reported(spark):
    faulty = {
        '[{"op":">=","value":1}]': ["field is missing"],
        '[{"field":"score","op":">="}]': ["value is missing"],
        '[{"field":"score","value":1}]': ["unknown operator"],
        '[{"field":"score","op":"=","value":null}]': [],
        '[{"field":"mood","op":"=","value":1}]': ["unknown field"],
    }
    table = spark.createDataFrame([(k, 1, "x", True, c, "bonus", 1) for k, c in enumerate(faulty)], controls.RULE_SCHEMA)
    got: dict = {k: [] for k in range(len(faulty))}
    for r in rules.rule_violations(table).collect():
        got[r["id"]].append(r["violation"])
    assert list(got.values()) == list(faulty.values())


def test_a_task_holds_one_part_of_a_long_list(spark):
    customers = spark.createDataFrame([(k, "active", k / 200, 1, 10, 1, 100) for k in range(200)], CUSTOMERS)
    at = [f'[{{"field":"score","op":">=","value":{1 - k / 64}}}]' for k in range(1, 65)]
    rules = [(k, k, f"r{k}", True, c, "best_ml", 1) for k, c in enumerate(at)]
    listed = spark.createDataFrame(rules, "id long, priority long, name string, active boolean, conditions string, action string, action_level int")
    got = rule_index.match_rules_indexed(customers, listed, block=8, part_bytes=1)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    whole = rule_index.match_rules_indexed(customers, listed)
    assert sorted(got.collect()) == sorted(whole.collect()) and got.select("rule").distinct().count() == 64
