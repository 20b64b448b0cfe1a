"""Hand-worked persona, boundaries, and equality of linear and quadratic forms."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from offerloom.functions.timing import ts_lit
from offerloom.operators import features, pit
from offerloom.operators import timeline as tl
from offerloom.operators.scan import busy_groups, prefix_scan, ranged
from offerloom.operators.segments import customer_base
from offerloom.plans.programme import Programme

DAY0 = datetime(2024, 6, 1)


def day(n):
    return DAY0 + timedelta(days=n)


@pytest.fixture(scope="module")
def persona(spark):
    red = [(1, day(d), 40, "market") for d in (-520, -410, -300, -210, -150, -90, -40, -3)]
    cred = [(1, day(-345), 900, day(20)), (1, day(-60), 300, day(305))]
    mis = [(1, day(-25)), (1, day(-10))]
    offers = [(1, 1, day(-200), "discount", 1), (2, 1, day(-35), "cashback", 3), (3, 1, day(0), "bonus", 1)]
    logs = {
        "red": spark.createDataFrame(red, "customer_id long, ts timestamp_ntz, points long, category string"),
        "cred": spark.createDataFrame(
            cred, "customer_id long, credit_ts timestamp_ntz, points long, expiry_ts timestamp_ntz"
        ),
        "mis": spark.createDataFrame(mis, "customer_id long, ts timestamp_ntz"),
        "offers": spark.createDataFrame(
            offers, "offer_id long, customer_id long, offer_ts timestamp_ntz, offer_type string, level int"
        ),
    }
    logs["facts"] = features.customer_facts(logs["red"], logs["cred"], logs["mis"])
    return logs


# offer at day -200, -35 and 0
EXPECTED = {
    "redemptions_total": (4, 7, 8),
    "redemptions_30d": (1, 1, 1),
    "redemptions_60d": (1, 2, 2),
    "redemptions_90d": (1, 2, 2),
    "points_accumulated": (900, 1200, 1200),
    "points_expired": (0, 0, 0),
    "points_expiring_15d": (0, 0, 0),
    "points_expiring_30d": (0, 0, 900),
    "points_expiring_60d": (0, 900, 900),
    "days_since_redemption": (10, 5, 3),
    "days_since_credit": (145, 25, 60),
    "days_since_mission": (0, 0, 10),
    "missions_30d": (0, 0, 2),
    "points_balance": (740, 920, 880),
    "points_usage_rate": (0.178, 0.233, 0.267),
    "avg_ticket": (40.0, 40.0, 40.0),
    "categories_90d": (1, 1, 1),
}


def test_persona_candidates(persona):
    measures = features.candidate_measures(persona["offers"], persona["facts"])
    rows = sorted(features.candidates(measures).collect(), key=lambda r: r.offer_id)
    for name, want in EXPECTED.items():
        assert tuple(r[name] for r in rows) == want, name


def test_recency_default_regimes(persona):
    measures = features.candidate_measures(persona["offers"], persona["facts"])
    ages = {r.offer_id: r.days_since_mission for r in features.candidates(measures, recency_default=999).collect()}
    assert ages == {1: 999, 2: 999, 3: 10}


def test_persona_segment_and_customer_without_events(spark, persona):
    ids = spark.createDataFrame([(1,), (2,)], "customer_id long")
    rows = {r.customer_id: r for r in customer_base(features.features_at(persona["facts"], ids, ts_lit("2024-06-01"))).collect()}
    assert rows[1].segment == "champion" and rows[1].redemptions_total == 8
    assert rows[2].segment == "new" and rows[2].redemptions_total == 0 and rows[2].days_since_redemption == 999


def test_event_at_the_anchor_counts_and_exact_ages_do_not(spark):
    red = spark.createDataFrame(
        [(1, day(0), 10, "a"), (1, day(-90), 10, "b"), (1, day(1), 10, "c")],
        "customer_id long, ts timestamp_ntz, points long, category string",
    )
    anchors = spark.createDataFrame([(1, day(0))], "customer_id long, ts timestamp_ntz")
    got = tl.measures_at(anchors, [tl.redemption_changes(red, (90,)), tl.category_changes(red)]).first()
    assert (got.redemptions_total, got.redemptions_90d, got.categories_90d) == (2, 1, 1)


def test_lot_that_expires_before_it_is_credited(spark):
    cred = spark.createDataFrame(
        [(1, day(0), 50, day(-5)), (1, day(0), 70, None)],
        "customer_id long, credit_ts timestamp_ntz, points long, expiry_ts timestamp_ntz",
    )
    anchors = spark.createDataFrame([(1, day(-1)), (1, day(0))], "customer_id long, ts timestamp_ntz")
    rows = tl.measures_at(anchors, [tl.credit_changes(cred, (30,))]).orderBy("ts").collect()
    assert [(r.points_accumulated, r.points_expired, r.points_expiring_30d) for r in rows] == [(0, 0, 0), (120, 50, 0)]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all events belong to one customer; times have minutes and repeat."""
    rng = random.Random(7)
    minute = lambda: day(0) + timedelta(minutes=rng.randrange(400 * 24 * 60 // 30) * 30)
    who = lambda: 0 if rng.random() < 0.34 else rng.randrange(1, 40)
    red = [(who(), minute(), rng.randrange(1, 9), str(rng.randrange(5))) for _ in range(1500)]
    cred = [(who(), t := minute(), rng.randrange(1, 9), t + timedelta(days=rng.randrange(0, 90))) for _ in range(900)]
    mis = [(who(), minute()) for _ in range(500)]
    anchors = [(who(), minute()) for _ in range(600)] + [r[:2] for r in red[:200]]
    return (
        spark.createDataFrame(anchors, "customer_id long, ts timestamp_ntz"),
        spark.createDataFrame(red, "customer_id long, ts timestamp_ntz, points long, category string"),
        spark.createDataFrame(cred, "customer_id long, credit_ts timestamp_ntz, points long, expiry_ts timestamp_ntz"),
        spark.createDataFrame(mis, "customer_id long, ts timestamp_ntz"),
    )


@pytest.mark.parametrize("block_hours", [1, 24, 30 * 24])
def test_timeline_equals_range_join(skewed, block_hours):
    anchors, red, cred, mis = skewed
    changes = [
        tl.redemption_changes(red, (30, 90), spend=True),
        tl.category_changes(red, 90, block_hours),
        tl.credit_changes(cred, (15, 60)),
        tl.mission_changes(mis, (30,)),
    ]
    got = tl.measures_at(anchors, changes, block_hours)
    a = anchors.distinct().withColumnRenamed("ts", "t")
    back = lambda n: F.expr(f"t - INTERVAL {n} DAYS")
    ahead = lambda n: F.expr(f"t + INTERVAL {n} DAYS")
    r = a.join(red, "customer_id").filter("ts <= t").groupBy("customer_id", "t").agg(
        F.count("*").alias("redemptions_total"),
        F.count_if(F.col("ts") > back(30)).alias("redemptions_30d"),
        F.count_if(F.col("ts") > back(90)).alias("redemptions_90d"),
        F.sum("points").alias("points_spent"),
        F.max("ts").alias("last_redemption"),
        F.countDistinct(F.when(F.col("ts") > back(90), F.col("category"))).alias("categories_90d"),
    )
    live = lambda n: (F.col("expiry_ts") > F.col("t")) & (F.col("expiry_ts") <= ahead(n))
    c = a.join(cred, "customer_id").filter("credit_ts <= t").groupBy("customer_id", "t").agg(
        F.sum("points").alias("points_accumulated"),
        F.sum(F.when(F.col("expiry_ts") <= F.col("t"), F.col("points"))).alias("points_expired"),
        F.sum(F.when(live(15), F.col("points"))).alias("points_expiring_15d"),
        F.sum(F.when(live(60), F.col("points"))).alias("points_expiring_60d"),
        F.max("credit_ts").alias("last_credit"),
    )
    m = a.join(mis, "customer_id").filter("ts <= t").groupBy("customer_id", "t").agg(
        F.count_if(F.col("ts") > back(30)).alias("missions_30d"), F.max("ts").alias("last_mission")
    )
    want = a
    for part in (r, c, m):
        want = want.join(part, ["customer_id", "t"], "left")
    want = want.withColumnRenamed("t", "ts").na.fill(0).select(*got.columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_pit_lookup_equals_latest_earlier_row(spark, skewed):
    anchors, red, _, _ = skewed
    spine = anchors.withColumn("row", F.monotonically_increasing_id())
    table = red.groupBy("customer_id", "ts").agg(F.sum("points").alias("v"))
    got = pit.pit_lookup(spine, table, "customer_id", "ts", "ts", ["v"], block_hours=24)
    joined = spine.join(table.withColumnRenamed("ts", "fts"), "customer_id", "left").filter("fts <= ts")
    best = joined.groupBy("row").agg(F.max_by("v", "fts").alias("v"), F.max("fts").alias("feature_ts"))
    want = spine.join(best, "row", "left").select(*got.columns)
    assert got.count() == spine.count()
    assert got.exceptAll(want).count() == 0


def test_prefix_scan_equals_plain_window(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.4 else rng.choice("abc"), rng.randrange(50), i, rng.randrange(9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v long, id long, x long")
    laid = ranged(df, ["g", "v", "id"])
    running = {"s": ("sum", "x"), "hi": ("max", "x"), "lo": ("min", "x")}
    for inclusive in (True, False):
        got = prefix_scan(laid, ["g"], ["block"], ["v", "id"], running, inclusive).drop("block")
        w = Window.partitionBy("g").orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        want = df.select(
            "*", F.coalesce(F.sum("x").over(w), F.lit(0)).alias("s"), F.max("x").over(w).alias("hi"), F.min("x").over(w).alias("lo")
        )
        assert got.select(*want.columns).exceptAll(want).count() == 0


def test_both_passes_of_a_scan_share_their_shuffle(skewed):
    anchors, red, cred, mis = skewed
    got = features.features_asof(anchors, features.customer_facts(red, cred, mis))
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan


def test_later_events_change_nothing(spark, folder):
    from offerloom.plans.programme import Programme

    p, q = Programme(spark, folder), Programme(spark, folder)
    cut = ts_lit("2000-01-01")
    q.past_facts = p.past_facts.filter(F.col("ts") <= cut)
    early = lambda x: x.feature_table.filter(F.col("ts") <= cut)
    assert early(p).exceptAll(early(q)).count() == 0


def test_latest_rows_equal_direct_aggregation(spark, folder):
    from offerloom.plans.programme import Programme

    p = Programme(spark, folder)
    newest = features.latest(p.feature_table, "customer_id", "ts")
    direct = p.current_features.select(*newest.columns)
    assert newest.exceptAll(direct).count() == 0 and newest.count() == direct.count()


def test_expiry_windows_nest(spark, folder):
    from offerloom.plans.programme import Programme

    wrong = Programme(spark, folder).candidates.filter(
        "points_expiring_15d > points_expiring_30d or points_expiring_30d > points_expiring_60d"
    )
    assert wrong.count() == 0


def test_unknown_default_column_is_an_error(spark):
    with pytest.raises(ValueError):
        features.fill_defaults(spark.range(1), {"nothing": 0})


def test_one_scan_of_facts_equals_three_logs(spark, folder):
    from offerloom.plans.programme import Programme

    p = Programme(spark, folder)
    three = features.customer_facts(p.redemptions, p.credits, p.missions)
    one = p.facts.withColumn("points", F.when(F.col("kind") != "mission", F.col("points")))
    assert one.exceptAll(three).count() == 0 and three.exceptAll(one).count() == 0


def test_features_at_instants_of_their_own_need_no_timeline(spark, folder):
    p = Programme(spark, folder)
    runs = ("1999-01-01 00:00:00", "2000-07-01 00:00:00")
    found = pit.last_before(p.every_point, "customer_id", "ts", runs)
    summed = features.features_at_each(p.past_facts, found, "anchor_ts", "scored_at")
    scanned = features.features_asof(found.select("customer_id", F.col("anchor_ts").alias("ts")), p.past_facts)
    scanned = found.join(scanned.withColumnRenamed("ts", "anchor_ts"), ["customer_id", "anchor_ts"]).select(*summed.columns)
    assert summed.count() == found.count() > 0
    assert summed.exceptAll(scanned).count() == 0 and scanned.exceptAll(summed).count() == 0
    plan = p.features_before(runs)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def _same(got, want):
    want = want.select(*got.columns)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


@pytest.mark.parametrize("most, hot", [(100_000, 0), (400, 1), (0, 41)])
def test_customers_as_wholes_equal_blocks_of_time(spark, skewed, most, hot):
    """All, some or no customers scanned as wholes; the null customer, repeated offers and offers without an instant stay."""
    anchors, red, cred, mis = skewed
    odd = spark.createDataFrame([(None, day(200)), (None, day(9)), (5, None)], "customer_id long, ts timestamp_ntz")
    facts = features.customer_facts(red, cred, mis)
    facts = facts.withColumn("customer_id", F.when(F.col("customer_id") != 7, F.col("customer_id")))
    offers = anchors.union(odd).withColumnsRenamed({"ts": "offer_ts"}).withColumn("offer_id", F.monotonically_increasing_id())
    busy = busy_groups("customer_id", facts, offers, most=most)
    assert busy.count() == hot or (most == 0 and busy.count() >= 40)
    _same(features.candidate_measures(offers, facts, busy=busy), features.candidate_measures(offers, facts))
    for until in (None, ts_lit("2024-12-01")):
        dated = anchors if until is None else anchors.filter(F.col("ts") <= until)
        got = features.features_asof(dated, facts, at_redemptions=True, until=until, busy=busy)
        _same(got, features.features_asof(dated, facts, at_redemptions=True, until=until))


def test_candidates_deal_narrow_rows_once(spark, folder):
    """Facts travel as they are: no shuffle of unrolled changes, and none of block totals or found offers."""
    p = Programme(spark, folder)
    plan = p.candidates._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


@pytest.mark.parametrize("most", [100_000, 100, 0])
def test_lookup_of_keys_as_wholes_equals_blocks_of_time(spark, skewed, most):
    anchors, red, _, _ = skewed
    odd = spark.createDataFrame([(None, day(200)), (5, None)], "customer_id long, ts timestamp_ntz")
    spine = anchors.union(odd).withColumn("row", F.monotonically_increasing_id())
    table = red.withColumn("customer_id", F.when(F.col("customer_id") != 7, F.col("customer_id")))
    table = table.groupBy("customer_id", "ts").agg(F.sum("points").alias("v"))
    busy = busy_groups("customer_id", table, spine, most=most)
    by = ("customer_id", "ts", "ts", ["v"])
    _same(pit.pit_lookup(spine, table, *by, busy=busy), pit.pit_lookup(spine, table, *by, block_hours=24))
