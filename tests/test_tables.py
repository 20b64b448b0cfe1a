"""Writers, updates, change feed, FIFO lots, promotion, model and streams."""

import hashlib
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from offerloom.operators import boosting, champion, drift, evaluation, features, ledger, model, pit, promotion, scoring, screening
from offerloom.operators.scan import busy_groups
from offerloom.plans import settings as st
from offerloom.plans.programme import Programme
from offerloom.session import scratch_path, shared_dir, staged
from offerloom.sources import maintenance as m
from offerloom.streaming import publish

T0 = datetime(2024, 1, 1)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_save_counts_while_writing(spark):
    path = scratch_path(spark, "save")
    assert m.save(spark.range(7), path) == 7
    assert m.save(spark.range(3).withColumn("x", F.lit(1)), path) == 3
    assert m.load(spark, path).columns == ["id", "x"]


def test_feature_table_refuses_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "k long, t long")
    assert m.write_feature_table(df, scratch_path(spark, "ft"), ["k", "t"]) == 2
    path = scratch_path(spark, "ft")
    dated = spark.createDataFrame([(1, T0), (1, T0 + timedelta(days=40))], "k long, t timestamp_ntz")
    assert m.write_feature_table(dated, path, ["k", "t"], "t") == 2
    with pytest.raises(ValueError):
        m.write_feature_table(df, path, ["k"])
    kept = m.load(spark, path)
    assert rows(kept.select("k", "t")) == rows(dated)
    one_month = kept.filter("feature_month = '2024-01'")
    assert "PartitionFilters: [isnotnull(feature_month" in one_month._jdf.queryExecution().toString() and one_month.count() == 1


def test_snapshot_append_is_idempotent_per_run(spark):
    path = scratch_path(spark, "snap")
    at = lambda h: spark.createDataFrame([(1, T0 + timedelta(hours=h))], "k long, scored_at timestamp_ntz")
    for h in (1, 2, 1, 1):
        m.append_snapshot(at(h), path)
    assert m.read_snapshot(spark, path).count() == 2


def test_upsert_update_and_feed(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, v string")
    new = spark.createDataFrame([(2, "B"), (4, "d")], "k long, v string")

    assert {tuple(r) for r in m.upsert(old, new, ["k"]).collect()} == {(1, "a"), (2, "B"), (3, None), (4, "d")}
    changed = spark.createDataFrame([(1, None), (9, "z")], "k long, v string")
    assert {tuple(r) for r in m.update_by_key(old, changed, ["k"], ["v"]).collect()} == {(1, None), (2, "b"), (3, None)}
    after = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (4, "d")], "k long, v string").filter("k <> 1")
    feed = {tuple(r) for r in m.change_feed(old, after, ["k"]).collect()}
    assert feed == {
        ("delete", 1, "a"),
        ("update_preimage", 2, "b"),
        ("update_postimage", 2, "B"),
        ("insert", 4, "d"),
    }


def test_replace_renumbers(spark):
    df = spark.createDataFrame([(70, "x"), (50, "y"), (60, "z")], "id long, v string")
    got = m.replace_table(df.withColumn("place", F.col("id")), [F.col("place")])
    assert {(r.id, r.v) for r in got.collect()} == {(1, "y"), (2, "z"), (3, "x")}


def test_fifo_lots_against_a_loop(spark):
    rng = random.Random(5)
    lots, spends = [], []
    for c in range(12):
        n = 400 if c == 0 else 12
        lots += [(c, f"l{i:03d}", T0 + timedelta(hours=rng.randrange(3000)), rng.randrange(1, 60)) for i in range(n)]
        spends += [(c, f"s{i:03d}", T0 + timedelta(hours=rng.randrange(3000)), rng.randrange(1, 60)) for i in range(n)]
    want = set()
    for c in range(12):
        left = [[i, p] for _, i, _, p in sorted((r for r in lots if r[0] == c), key=lambda r: (r[2], r[1]))]
        for _, s, _, need in sorted((r for r in spends if r[0] == c), key=lambda r: (r[2], r[1])):
            while need and left:
                used = min(need, left[0][1])
                want.add((c, left[0][0], s, used))
                need -= used
                left[0][1] -= used
                if not left[0][1]:
                    left.pop(0)
    schema = "customer_id long, {} string, ts timestamp_ntz, points long"
    got = ledger.fifo_lots(
        spark.createDataFrame(lots, schema.format("lot_id")), spark.createDataFrame(spends, schema.format("spend_id")), 24, 8
    )
    assert {tuple(r) for r in got.select("customer_id", "lot_id", "spend_id", "points_used").collect()} == want


def test_promotion_gate(spark):
    aucs = [0.70, 0.65, 0.70, None, 0.80, 0.79]
    df = spark.createDataFrame([("m", i, a) for i, a in enumerate(aucs, 1)], "model string, version int, auc double")
    led = promotion.promotion_ledger(df)
    assert [r.promoted for r in led.orderBy("version").collect()] == [True, False, True, False, True, False]
    assert {(r.alias, r.version) for r in promotion.current_aliases(led).collect()} == {("champion", 5), ("challenger", 6)}


def test_auc_with_ties_and_one_class(spark):
    data = [("a", 0.1, 0), ("a", 0.4, 0), ("a", 0.4, 1), ("a", 0.9, 1), ("b", 0.5, 1), ("b", 0.6, 1)]
    got = evaluation.auc(spark.createDataFrame(data, "g string, p double, y int"), "p", "y", ["g"])
    assert {r.g: r.auc for r in got.collect()} == {"a": 0.875, "b": None}


def test_split_is_exact_per_label(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(1003)], "id long, y int")
    got = evaluation.stratified_split(df, "id", "y").groupBy("y").agg(F.count_if("is_test").alias("t"), F.count("*").alias("n"))
    assert {(r.y, r.n, r.t) for r in got.collect()} == {(0, 902, 226), (1, 101, 26)}


def test_selection_rules(spark):
    imp = spark.createDataFrame([("a", 0.2), ("b", 0.1), ("c", 0.05), ("d", 0.0005)], "column string, importance double")
    cor = spark.createDataFrame(
        [("a", "b", -0.95), ("a", "c", 0.9), ("b", "c", 0.99), ("a", "d", 0.0)], "first string, second string, correlation double"
    )
    got = {r.candidate: r.verdict for r in screening.select_features(imp, cor).collect()}
    assert got == {"a": "kept", "b": "redundant with a", "c": "kept", "d": "weak"}


def test_ks_of_known_samples(spark):
    at = lambda d, vals: [(T0 + timedelta(days=d), "s", float(v)) for v in vals]
    schema = "scored_at timestamp_ntz, k string, x double"
    base = spark.createDataFrame(at(0, [1, 2, 3, 4]), schema)
    now = spark.createDataFrame(at(1, [3, 4, 5, 6]) + at(2, [1, 2, 3, 4]) + at(3, [-5, -6, -7, -8]), schema)
    got = {r.window_start.day: r.ks for r in drift.drift_ks(now, base, ["x"], "k", "scored_at").collect()}
    assert got == {2: 0.5, 3: 0.0, 4: 1.0}


def test_model_learns_and_accepts_an_unknown_type(spark, folder):
    data = staged(Programme(spark, folder).training_set, "training")
    split = evaluation.stratified_split(data, "offer_id", "accepted")
    train, test = split.filter(~F.col("is_test")), split.filter("is_test")
    fitted = model.fit_propensity(train, rounds=5, depth=3)
    assert evaluation.auc(model.predict_proba(fitted, train), "p_accept", "accepted").first().auc > 0.55
    odd = model.predict_proba(fitted, test.withColumn("offer_type", F.lit("voucher")))
    assert odd.filter("p_accept between 0 and 1").count() == test.count()
    runs = model.sweep(train, test, [{"rounds": 2, "depth": 2}, {"rounds": 3, "depth": 2}])
    assert promotion.best_run(runs).count() == 1 and runs.count() == 2


def feature_rows(spark):
    data = [(u, T0 + timedelta(hours=h), h * 10 + u) for u in range(20) for h in range(30)]
    random.Random(1).shuffle(data)
    return spark.createDataFrame(data, "user_id long, ts timestamp_ntz, v long")


def test_published_rows_survive_late_data_and_reruns(spark):
    df = feature_rows(spark)
    source, target = scratch_path(spark, "source"), scratch_path(spark, "target")
    schema = df.schema
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    checkpoint = scratch_path(spark, "progress")
    cut = T0 + timedelta(hours=15)
    df.filter(F.col("ts") >= F.lit(cut)).coalesce(1).write.parquet(source)
    publish.publish_stream(stream(), ["user_id"], ["ts"], target, checkpoint).awaitTermination()
    df.filter(F.col("ts") < F.lit(cut)).coalesce(1).write.mode("append").parquet(source)
    publish.publish_stream(stream(), ["user_id"], ["ts"], target, checkpoint).awaitTermination()
    got = rows(publish.read_published(spark, target, schema, ["user_id"], ["ts"]))
    assert got == rows(publish.newest(df, ["user_id"], ["ts"]))
    # the same files again under a new progress folder: batches overwrite themselves
    publish.publish_stream(stream(), ["user_id"], ["ts"], target, scratch_path(spark, "progress")).awaitTermination()
    assert rows(publish.read_published(spark, target, schema, ["user_id"], ["ts"])) == got


def test_drift_of_a_stream_in_any_order_equals_batch(spark, folder):
    """Days arrive mixed and late, in many small batches; two levels of runs are merged."""
    snap = Programme(spark, folder).score_batch(*st.DRIFT_RUNS).select("offer_type", *st.DRIFT_COLUMNS, "scored_at")
    columns = st.DRIFT_COLUMNS
    source, target = scratch_path(spark, "snaps"), scratch_path(spark, "drift")
    snap.withColumn("part", F.pmod(F.xxhash64(*snap.columns), F.lit(9))).repartition("part").drop("part").write.option(
        "maxRecordsPerFile", 900
    ).parquet(source)
    stream = spark.readStream.schema(snap.schema).option("maxFilesPerTrigger", 1).parquet(source)
    publish.drift_stream(stream, columns, "offer_type", "scored_at", target, scratch_path(spark, "progress"), fan_out=3).awaitTermination()
    state = publish.drift_state(spark, target, "offer_type", fan_out=3)
    assert state.depth() < 7
    counts = state.read()
    assert rows(drift.profile_of_counts(counts, "offer_type")) == rows(drift.drift_profile(snap, columns, "offer_type", "scored_at"))
    first = F.col("window_start") == F.lit(st.DRIFT_RUNS[0]).cast("timestamp_ntz")
    day = F.col("scored_at") == F.lit(st.DRIFT_RUNS[0]).cast("timestamp_ntz")
    want = drift.drift_ks(snap.filter(~day), snap.filter(day), columns, "offer_type", "scored_at")
    assert rows(drift.ks_of_counts(counts.filter(~first), counts.filter(first), "offer_type")) == rows(want)


def test_requests_out_of_order_meet_the_features_of_their_instants(spark, folder):
    """Two feature batches, the later days first; requests in random order and small batches equal the batch lookup."""
    p = Programme(spark, folder)
    table = staged(p.feature_table, "features")
    source, versions = scratch_path(spark, "features"), scratch_path(spark, "history")
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    checkpoint = scratch_path(spark, "progress")
    stream = lambda: spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 2).parquet(source)
    for part in (table.filter(F.col("ts") >= cut), table.filter(F.col("ts") < cut)):
        part.repartition(2).write.mode("append").parquet(source)
        publish.publish_history(stream(), ["customer_id"], "ts", versions, checkpoint, fan_out=2).awaitTermination()
    requests, target = scratch_path(spark, "requests"), scratch_path(spark, "scored")
    p.offers.orderBy(F.md5(F.col("offer_id").cast("string"))).repartition(3).write.parquet(requests)
    asked = spark.readStream.schema(p.offers.schema).option("maxFilesPerTrigger", 1).parquet(requests)
    read = lambda s: publish.history(s, versions, table.schema, ["customer_id"], "ts").read()
    publish.score_stream(
        asked, read, "customer_id", "offer_ts", "ts", p.catalog, target, scratch_path(spark, "progress")
    ).awaitTermination()
    got = spark.read.parquet(target)
    want = pit.pit_lookup(p.offers, table, "customer_id", "offer_ts", "ts", features.FEATURES)
    want = features.fill_defaults(want, features.FEATURE_DEFAULTS).withColumn("p_accept", scoring.feature_score())
    assert rows(got.select("offer_id", "p_accept")) == rows(want.select("offer_id", "p_accept"))


def test_history_keeps_the_newest_row_before_its_horizon(spark):
    df = feature_rows(spark)
    runs = publish.history(spark, scratch_path(spark, "history"), df.schema, ["user_id"], "ts", str(T0 + timedelta(hours=20)), fan_out=2)
    for part in (F.col("ts") < F.lit(T0 + timedelta(hours=10)), F.col("ts") >= F.lit(T0 + timedelta(hours=10))):
        runs.append(df.filter(part))
    kept = runs.read()
    assert kept.count() == 20 * (10 + 1) and kept.agg(F.min("ts")).first()[0] == T0 + timedelta(hours=19)


def test_digests_find_the_buckets_that_differ(spark):
    path = scratch_path(spark, "bucketed")
    old = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"), F.lit(None).cast("long").alias("w"))
    new = old.filter("k <> 11").withColumn("v", F.when(F.col("k") == 500, 99).otherwise(F.col("v")))
    # the same hash without the places of nulls
    new = new.withColumns({"w": F.when(F.col("k") == 77, F.col("v")), "v": F.when(F.col("k") != 77, F.col("v"))})
    new = new.unionByName(spark.createDataFrame([(5000, 1, None)], new.schema))
    a, b = (m.write_bucketed(df.repartition(3), path, ["k"]) for df in (old, new))
    changed = m.changed_buckets(spark, path, a, b)
    assert 0 < len(changed) <= 4
    feed = m.versioned_change_feed(spark, path, a, b, ["k"])
    assert rows(feed.na.fill(-1)) == rows(m.change_feed(old, new, ["k"]).na.fill(-1))
    scans = [line for line in feed._jdf.queryExecution().toString().splitlines() if "PartitionFilters: [bucket" in line]
    assert scans and all("bucket#" in line for line in scans)
    read = m.load(spark, path, a).filter(F.col("bucket").isin(*changed)).count()
    assert read < 1000 * 3 * len(changed) / 64
    c = m.write_bucketed(new.orderBy(F.desc("k")), path, ["k"])
    assert m.changed_buckets(spark, path, b, c) == []
    assert m.versioned_change_feed(spark, path, b, c, ["k"]).count() == 0


def test_audit_is_appended_once_an_instant(spark):
    path = scratch_path(spark, "audit")
    feed = spark.createDataFrame([("insert", 1), ("insert", 2), ("delete", 3)], "change string, k long")
    for at in ("2024-01-01 10:00:00", "2024-01-01 11:00:00", "2024-01-01 10:00:00"):
        m.append_audit(m.audit(feed, "u", "a", at), path)
    got = m.read_audit(spark, path)
    assert got.count() == 4 and got.select("audited_at").distinct().count() == 2


def test_importance_of_constant_and_useless_columns(spark):
    rng = random.Random(2)
    data = [(i, float(rng.random()), 5.0, float(rng.random()), 0) for i in range(501)]
    data = [(i, x, c, u, int(x > 0.5)) for i, x, c, u, _ in data]
    df = spark.createDataFrame(data, "id long, x double, c double, u double, y int")
    as_column = evaluation.permutation_importance(df, "id", ["x", "c", "u"], F.col("x") + F.col("c"), "y")
    as_model = evaluation.permutation_importance(df, "id", ["x", "c", "u"], lambda f: f.withColumn("p", F.col("x") + F.col("c")), "y")
    got = {r["column"]: r["importance"] for r in as_column.collect()}
    assert got["c"] == got["u"] == 0.0 and got["x"] > 0.3
    assert {r["column"]: r["importance"] for r in as_model.collect()} == got
    plan = as_column._jdf.queryExecution().toString()
    assert "Sort [column" not in plan


def test_deals_are_bijections():
    dealt = evaluation.deals(["a", "b"], 3)
    assert len({p for _, _, p, _ in dealt}) == 6
    for n in (1, 2, 3, 10, 97, 360):
        for _, _, prime, shift in dealt:
            assert sorted((prime * j + shift) % n for j in range(n)) == list(range(n))


def test_the_gate_decides_which_model_scores(spark, folder):
    data = staged(Programme(spark, folder).training_set, "training")
    split = staged(evaluation.stratified_split(data, "offer_id", "accepted"), "split")
    train, test = split.filter(~F.col("is_test")), split.filter("is_test")
    store = champion.ModelStore(spark, scratch_path(spark, "models"))
    with pytest.raises(LookupError):
        store.load()
    fitted = [model.fit_propensity(train, rounds=r, depth=2) for r in (1, 3, 2)]
    for one, auc in zip(fitted, (0.6, 0.7, 0.65)):
        store.register(one, {"auc": auc, "accuracy": 0.5, "n": 10}, "2024-01-01 00:00:00")
    assert {(r["alias"], r["version"]) for r in store.aliases().collect()} == {("champion", 2), ("challenger", 3)}
    loaded, version = store.load()
    assert version == 2
    assert rows(model.predict_proba(loaded, test).select("offer_id", "p_accept")) == rows(
        model.predict_proba(fitted[1], test).select("offer_id", "p_accept")
    )
    scored = champion.score_with_champion(store, test)
    assert scored.select("model_version").distinct().collect() == [(2,)]
    assert dict(scored.dtypes)["redemptions_total"] == dict(test.dtypes)["redemptions_total"]


def test_counts_are_seen_by_the_writers(spark):
    got = m.step_counts({"a": spark.range(5), "b": spark.range(0)}, scratch_path(spark, "steps"))
    assert rows(got) == [("a", 5), ("b", 0)]


def plain_ledger(lots, spends):
    """Used (customer, lot, spend, points) by a loop over events; oldest lots first."""
    want = set()
    for c in {r[0] for r in lots + spends}:
        own = sorted((r for r in lots if r[0] == c), key=lambda r: (r[2], r[1]))
        events, ends = [], T0
        for k, (_, lot, ts, _, expiry) in enumerate(own):
            events.append((ts, 0, lot, k))
            # a lot does not expire before older ones
            ends = None if expiry is None or ends is None else max(ends, expiry)
            if ends is not None:
                events.append((max(ends, ts), 1, lot, k))
        events += [(ts, 2, s, points) for cc, s, ts, points in spends if cc == c]
        there, left = [], {}
        for _, kind, ident, x in sorted(events):
            if kind == 0:
                there.append(x)
                left[x] = own[x][3]
            elif kind == 1:
                left[x] = 0
            else:
                for k in sorted(there):
                    used = min(x, left[k])
                    if used:
                        want.add((c, own[k][1], ident, used))
                        left[k] -= used
                        x -= used
    return want


@pytest.mark.parametrize("partitions", [2, 40])
def test_expiring_lots_against_a_loop(spark, partitions):
    """Overdrafts, lots without expiry, expiries out of order, one hot customer over many ranges."""
    rng = random.Random(partitions)
    lots, spends = [], []
    for c in range(14):
        n = 700 if c == 5 else rng.randint(0, 14)
        for i in range(n):
            ts = T0 + timedelta(hours=rng.randrange(3000))
            expiry = None if rng.random() < (0.001 if c == 5 else 0.1) else ts + timedelta(hours=rng.choice([0, 50, 200, 200, 900]))
            lots.append((c, f"l{i:03d}", ts, rng.randrange(1, 60), expiry))
        spends += [(c, f"s{i:03d}", T0 + timedelta(hours=rng.randrange(3300)), rng.randrange(1, 60)) for i in range(n + 2)]
    a = spark.createDataFrame(lots, "customer_id long, lot_id string, ts timestamp_ntz, points long, expiry_ts timestamp_ntz")
    b = spark.createDataFrame(spends, "customer_id long, spend_id string, ts timestamp_ntz, points long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ledger.fifo_expiring(a, b, 24, 8)
        assert {tuple(r) for r in got.select("customer_id", "lot_id", "spend_id", "points_used").collect()} == plain_ledger(lots, spends)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_clamps_compose():
    rng = random.Random(1)
    for _ in range(300):
        clamp, credited, events = (0, 0, ledger.NEVER), 0, []
        for _ in range(rng.randint(0, 8)):
            kind = rng.choice([ledger.EXPIRY, ledger.SPEND])
            credited += rng.randrange(9)
            events.append((kind, rng.randrange(credited + 1) if kind == ledger.EXPIRY else rng.randrange(9), credited))
            clamp = ledger._compose(clamp, *events[-1])
        for p in range(12):
            front = p
            for kind, amount, credited in events:
                front = max(front, amount) if kind == ledger.EXPIRY else min(front + amount, credited)
            assert front == min(clamp[2], max(clamp[1], p + clamp[0]))


def test_equal_training_rows_are_fitted_as_one_that_weighs_as_much(spark, folder):
    rows = Programme(spark, folder).training_set
    once = model.counted(rows, "accepted")
    thrice = model.counted(rows.unionByName(rows).unionByName(rows), "accepted")
    assert once.agg(F.sum("weight")).first()[0] == rows.count()
    assert thrice.count() == once.count()
    assert thrice.agg(F.sum("weight")).first()[0] == 3 * rows.count()
    fitted = [model.fit_propensity(r, rounds=2, depth=2) for r in (rows, rows.unionByName(rows))]
    a, b = (model.predict_proba(f, rows).select("offer_id", "p_accept").collect() for f in fitted)
    assert sorted(a) == sorted(b)


def test_each_deal_is_a_shuffle_of_its_own(spark):
    """Two runs by plain Python: sorted by md5(key:repeat:column), not moved by one step for all rows."""
    rng = random.Random(3)
    data = [(i, float(rng.random()), int(rng.random() < 0.5)) for i in range(40)]
    df = spark.createDataFrame(data, "id long, x double, y int")
    got = evaluation.permutation_importance(df, "id", ["x"], F.col("x"), "y", repeats=2).first().importance

    def auc(scores):
        pairs = [(p > n) + (p == n) / 2 for p, (_, _, a) in zip(scores, data) if a for n, (_, _, b) in zip(scores, data) if not b]
        return round(sum(pairs) / len(pairs), 6)

    deals = []
    for repeat in (1, 2):
        deck = sorted(data, key=lambda r: hashlib.md5(f"{r[0]}:{repeat}:x".encode()).hexdigest())
        deals.append(auc([r[1] for r in deck]))
    assert got == pytest.approx(auc([r[1] for r in data]) - sum(deals) / 2, abs=2e-6)


@pytest.mark.parametrize("most", [100, 10_000])
def test_ledger_of_customers_as_wholes(spark, most):
    """With a hot customer cut into blocks, or none."""
    rng = random.Random(most)
    lots, spends = [], []
    for c in range(9):
        for i in range(90 if c == 4 else rng.randint(0, 12)):
            ts = T0 + timedelta(hours=rng.randrange(3000))
            lots.append((c, f"l{i:03d}", ts, rng.randrange(1, 60), rng.choice([None, ts, ts + timedelta(hours=200)])))
            spends.append((c, f"s{i:03d}", T0 + timedelta(hours=rng.randrange(3300)), rng.randrange(1, 60)))
    a = spark.createDataFrame(lots, "customer_id long, lot_id string, ts timestamp_ntz, points long, expiry_ts timestamp_ntz")
    b = spark.createDataFrame(spends, "customer_id long, spend_id string, ts timestamp_ntz, points long")
    busy = busy_groups("customer_id", a, b, most=most)
    assert busy.count() == (1 if most == 100 else 0)
    columns = ("customer_id", "lot_id", "spend_id", "points_used")
    got = ledger.fifo_expiring(a, b, 24, 8, busy=busy)
    assert {tuple(r) for r in got.select(*columns).collect()} == plain_ledger(lots, spends)
    rows = lambda df: {tuple(r) for r in df.select(*columns).collect()}
    assert rows(ledger.fifo_lots(a, b, 24, 8, busy=busy)) == rows(ledger.fifo_lots(a, b, 24, 8))


def test_trees_of_dealt_cells_are_those_of_one_task_and_of_spark(spark, folder, monkeypatch):
    """Whether a task holds all cells or they are dealt, the trees score as Spark ML's own."""
    rows = staged(Programme(spark, folder).training_set, "training")
    ready = model.prepare(rows)
    assert ready.held.number <= rows.count() and ready.held.table.agg(F.sum(F.col("pos") + F.col("neg"))).first()[0] == rows.count()
    one = model.fit_propensity(ready, rounds=3, depth=2)
    monkeypatch.setattr(boosting, "MOST", ready.held.number // 3)
    monkeypatch.setattr(boosting, "KEPT_ROUNDS", 2)
    dealt = model.fit_propensity(ready, rounds=3, depth=2)
    given = PipelineModel([*ready.stages]).transform(model.counted(rows, "accepted"))
    settings = one.stages[-1]
    spark_ml = GBTClassifier(featuresCol="inputs", labelCol="accepted", weightCol="weight", maxIter=3, maxDepth=2, stepSize=0.08, seed=42)
    assert settings.getMaxIter() == 3 and settings.treeWeights == [1.0, 0.08, 0.08]
    scores = [
        {r["offer_id"]: r["p_accept"] for r in model.predict_proba(m, rows).select("offer_id", "p_accept").collect()}
        for m in (one, dealt, PipelineModel([*ready.stages, spark_ml.fit(given)]))
    ]
    assert scores[0] == scores[1]
    assert all(p == pytest.approx(scores[2][k], abs=2e-6) for k, p in scores[0].items())


def test_a_training_run_starts_no_job_for_each_level(spark, folder):
    """Cells that a task can hold are boosted in it: as many jobs for twelve rounds as for two."""
    ready = model.prepare(Programme(spark, folder).training_set)
    jobs = []
    for rounds in (2, 12):
        group = f"rounds-{rounds}"
        spark.sparkContext.setJobGroup(group, group)
        model.fit_propensity(ready, rounds=rounds, depth=3)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_limits_cut_values_into_like_parts():
    assert boosting.limits_of(iter([(5.0, 3.0)]), 3, 4).tolist() == []
    assert boosting.limits_of(iter([(0.0, 2.0), (1.0, 1.0), (4.0, 9.0)]), 12, 4).tolist() == [0.5, 2.5]
    assert boosting.limits_of(iter([(float(k), 1.0) for k in range(8)]), 8, 4).tolist() == [1.5, 3.5, 5.5]


def test_deals_are_run_once_and_leave_no_rows_behind(spark):
    """What is returned reads the decks' counted scores only, and the rows laid out for the deals are gone."""
    df = spark.createDataFrame([(i, float(i % 7), int(i % 3 == 0)) for i in range(60)], "id long, x double, y int")
    place = Path(shared_dir(spark).removeprefix("file:"))
    before = {p.name for p in place.iterdir()}
    got = evaluation.permutation_importance(df, "id", ["x"], F.col("x"), "y", repeats=2)
    assert {Path(f).parent.name.rsplit("-", 1)[0] for f in got.inputFiles()} == {"deck-scores"}
    assert not [p.name for p in place.iterdir() if p.name not in before and p.name.startswith(("test-rows-", "placed-rows-"))]
