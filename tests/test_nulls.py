"""Null groups, intact rules, refused tables: faults that plain data never shows."""

import json
import random

import pytest
from pyspark.sql import functions as F

from offerloom.operators import budget, evaluation, rules, screening
from offerloom.sources import controls, maintenance


def test_null_segments_are_decided(spark):
    df = spark.createDataFrame(
        [(1, "a", "bonus", 5, 0.9), (2, None, "bonus", 5, 0.8), (3, None, "bonus", 5, 0.7)],
        "customer_id long, segment string, offer_type string, cost int, p_accept double",
    )
    limits = spark.createDataFrame([("a", 5)], "segment string, budget int")
    got = {r.customer_id: (r.running_cost, r.final_offer) for r in budget.apply_budget(df, limits).collect()}
    assert got == {1: (5, "bonus"), 2: (5, "no_offer"), 3: (10, "no_offer")}


def test_null_labels_and_groups(spark):
    df = spark.createDataFrame([(k, None if k < 4 else k % 2) for k in range(12)], "id long, label int")
    assert evaluation.stratified_split(df, "id", "label").groupBy("label").agg(
        F.sum(F.col("is_test").cast("int")).alias("n")
    ).filter("n = 1").count() == 3
    scored = spark.createDataFrame(
        [(None, 0.2, 0), (None, 0.9, 1), ("x", 0.9, 0), ("x", 0.2, 1)], "model string, p double, hit int"
    )
    got = {r.model: r.auc for r in evaluation.auc(scored, "p", "hit", ["model"]).collect()}
    assert got == {None: 1.0, "x": 0.0}


def test_shifted_conditions_keep_their_kinds(spark):
    conditions = [
        {"field": "score", "op": ">=", "value": 0.5, "note": "kept"},
        {"field": "segment", "op": "=", "value": None},
        {"field": "segment", "op": "!=", "value": '00"7'},
    ]
    seed = controls.rules_table(spark) if hasattr(controls, "rules_table") else spark.createDataFrame(controls.RULE_ROWS, controls.RULE_SCHEMA)
    one = seed.limit(1).withColumn("conditions", F.lit(json.dumps(conditions)))
    got = json.loads(rules.shift_thresholds(one, 0.2).first().conditions)
    assert got == [{**conditions[0], "value": 0.7}, *conditions[1:]]
    broken = seed.limit(1).withColumn("conditions", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="no list"):
        rules.compile_rules(rules.shift_thresholds(broken, 0.1).collect())
    odd = seed.limit(1).withColumn("conditions", F.lit('[\n{"field":"score","op":"~","value":1}\n]'))
    assert [r.violation for r in rules.rule_violations(odd).collect()] == ["unknown operator"]


def test_refused_table_is_never_seen(spark, tmp_path):
    path = f"{tmp_path}/features"
    good = spark.createDataFrame([(1, 1), (2, 1)], "id long, ts long")
    maintenance.write_feature_table(good, path, ["id", "ts"])
    with pytest.raises(ValueError):
        maintenance.write_feature_table(good.union(good), path, ["id", "ts"])
    assert maintenance.load(spark, path).count() == 2


def test_many_candidates(spark):
    names = [f"c{k}" for k in range(300)]
    importance = spark.createDataFrame([(n, 1.0 - k / 1000) for k, n in enumerate(names)], "column string, importance double")
    pairs = spark.createDataFrame(
        [(a, b, 0.99 if (a, b) == ("c0", "c1") else 0.1) for i, a in enumerate(names) for b in names[i + 1 :]],
        "first string, second string, correlation double",
    )
    got = {r.candidate: r.verdict for r in screening.select_features(importance, pairs).collect()}
    assert len(got) == 300 and got["c1"] == "redundant with c0"


def plain_selection(importance, close):
    """Verdicts by a walk down the ranking."""
    kept, out = [], {}
    for name, weight in sorted(importance, key=lambda r: (-r[1], r[0])):
        near = [k for k in kept if frozenset((name, k)) in close]
        if weight < screening.WEAK_BELOW:
            out[name] = "weak"
        elif near:
            out[name] = f"redundant with {near[0]}"
        else:
            out[name] = "kept"
            kept.append(name)
    return out


@pytest.mark.parametrize("seed, chance", [(1, 0.05), (2, 0.2), (3, 0.5)])
def test_selection_through_chains(spark, seed, chance):
    """A long chain of twins and a random web of them, ties and weak candidates among them."""
    rng = random.Random(seed)
    importance = [(f"c{k:02d}", rng.choice([0.0002, 0.1, 0.2, 0.3, round(rng.random(), 3)])) for k in range(26)]
    importance += [(f"d{k:02d}", 0.9 - k / 100) for k in range(20)]
    pairs = [(a, b, 0.95) for (a, _), (b, _) in zip(importance[26:], importance[27:])]
    pairs += [(importance[i][0], importance[j][0], rng.choice([-0.99, 0.9, 0.5])) for i in range(26) for j in range(i) if rng.random() < chance]
    got = screening.select_features(
        spark.createDataFrame(importance, "column string, importance double"),
        spark.createDataFrame(pairs, "first string, second string, correlation double"),
    )
    want = plain_selection(importance, {frozenset(p[:2]) for p in pairs if abs(p[2]) > 0.9})
    assert {r.candidate: r.verdict for r in got.collect()} == want


def test_more_candidates_than_a_control_table_has_rows(spark):
    importance = spark.range(10_001).select(
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("column"), (1 - F.col("id") / 20_000).alias("importance")
    )
    pairs = spark.range(5000).select(
        F.concat(F.lit("c"), (2 * F.col("id")).cast("string")).alias("first"),
        F.concat(F.lit("c"), (2 * F.col("id") + 1).cast("string")).alias("second"),
        F.lit(0.95).alias("correlation"),
    )
    got = screening.select_features(importance, pairs)
    assert {r["kind"]: r["count"] for r in got.groupBy(F.substring_index("verdict", " ", 1).alias("kind")).count().collect()} == {
        "kept": 5001,
        "redundant": 5000,
    }
