"""The registered queries: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerloom.functions.timing import time_block, ts_lit
from offerloom.operators import (
    budget,
    champion,
    drift,
    evaluation,
    features,
    ledger,
    model,
    pit,
    promotion,
    rule_index,
    rules,
    scenario,
    scoring,
    screening,
)
from offerloom.operators import timeline as tl
from offerloom.operators.scan import busy_groups, prefix_scan
from offerloom.plans import settings as st
from offerloom.plans.programme import KEY, TS, Programme
from offerloom.session import scratch_path, staged
from offerloom.sources import controls, maintenance
from offerloom.sources.fixtures import AS_OF, BEST_ML
from offerloom.streaming import publish

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(fn: Callable[[Programme], DataFrame]) -> Callable[[Programme], DataFrame]:
    _QUERIES[fn.__name__] = lambda spark, folder: fn(Programme(spark, folder))
    return fn


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


# --- point-in-time features -------------------------------------------------


def _at_offers(p: Programme, *changes: DataFrame) -> DataFrame:
    at = tl.measures_at(p.offers.select(KEY, F.col("offer_ts").alias(TS)), changes)
    return p.offers.join(at.withColumnRenamed(TS, "offer_ts"), [KEY, "offer_ts"], "left")


def _counts(df: DataFrame, *names: str) -> DataFrame:
    return df.select("offer_id", *names).na.fill(0, subset=list(names))


@_query
def label_rate(p: Programme) -> DataFrame:
    return p.labelled_offers.agg(
        F.count("*").alias("offers"),
        F.sum(F.col("accepted").cast("long")).alias("accepted"),
        F.round(F.avg("accepted"), 6).alias("rate"),
    )


@_query
def snapshot_points(p: Programme) -> DataFrame:
    return p.points


@_query
def asof_redemptions(p: Programme) -> DataFrame:
    windows = (30, 60, 90)
    got = _at_offers(p, tl.redemption_changes(p.past_redemptions, windows, spend=True))
    return _counts(got, "redemptions_total", *[f"redemptions_{n}d" for n in windows], "points_spent")


@_query
def asof_credits(p: Programme) -> DataFrame:
    windows = (15, 30, 60)
    got = _at_offers(p, tl.credit_changes(p.past_credits, windows))
    return _counts(got, "points_accumulated", "points_expired", *[f"points_expiring_{n}d" for n in windows])


@_query
def asof_missions(p: Programme) -> DataFrame:
    return _counts(_at_offers(p, tl.mission_changes(p.past_missions)), "missions_30d")


@_query
def asof_recency(p: Programme) -> DataFrame:
    got = _at_offers(
        p,
        tl.redemption_changes(p.past_redemptions).select(KEY, TS, "last_redemption"),
        tl.credit_changes(p.past_credits).select(KEY, TS, "last_credit").filter("last_credit is not null"),
        tl.mission_changes(p.past_missions, ()),
    )
    ages = [
        F.coalesce(features.recency(f"last_{name}", "offer_ts"), F.lit(features.NEVER)).alias(f"days_since_{name}")
        for name in ("redemption", "credit", "mission")
    ]
    return got.select("offer_id", *ages)


@_query
def distinct_categories_90d(p: Programme) -> DataFrame:
    redemptions = staged(p.past_facts.filter(F.col("kind") == "redemption").select(KEY, "kind", TS, "category"), "redemptions")
    offers = p.offers.select("offer_id", KEY, F.col("offer_ts").alias(TS))
    got = tl.measures_of_rows(offers, redemptions, {}, busy_groups(KEY, redemptions, offers), 90)
    return _counts(got, "categories_90d")


@_query
def points_balance(p: Programme) -> DataFrame:
    got = _at_offers(
        p,
        tl.redemption_changes(p.past_redemptions, spend=True).select(KEY, TS, "points_spent"),
        tl.credit_changes(p.past_credits).select(KEY, TS, "points_accumulated", "points_expired"),
    )
    raw = ("points_spent", "points_accumulated", "points_expired")
    spent, accumulated, expired = (F.coalesce(F.col(c), F.lit(0).cast("long")) for c in raw)
    return got.select(
        "offer_id",
        features.points_balance(accumulated, spent, expired).alias("points_balance"),
        features.points_usage_rate(spent, accumulated).alias("points_usage_rate"),
    )


@_query
def candidates(p: Programme) -> DataFrame:
    return p.candidates


@_query
def features_asof(p: Programme) -> DataFrame:
    return p.feature_table


@_query
def feature_key_violations(p: Programme) -> DataFrame:
    return pit.duplicate_keys(p.feature_table, [KEY, TS])


@_query
def pit_lookup(p: Programme) -> DataFrame:
    got = pit.pit_lookup(p.offers, p.feature_table, KEY, "offer_ts", TS, features.FEATURES, busy=p.busy)
    return got.select("offer_id", KEY, "offer_ts", "feature_ts", *features.FEATURES)


@_query
def training_set(p: Programme) -> DataFrame:
    return p.training_set.select("offer_id", "offer_type", "level", "accepted", *features.FEATURES)


@_query
def latest_features(p: Programme) -> DataFrame:
    return features.latest(p.feature_table, KEY, TS)


@_query
def recent_snapshots(p: Programme) -> DataFrame:
    return features.recent(p.feature_table, KEY, TS, st.RECENT)


# --- customer base, scores, rankings ----------------------------------------


@_query
def customer_base(p: Programme) -> DataFrame:
    return p.base.select(KEY, "redemptions_60d", "redemptions_total", "points_accumulated", "recency_today")


@_query
def segments(p: Programme) -> DataFrame:
    return p.base.select(KEY, "segment")


@_query
def offer_grid(p: Programme) -> DataFrame:
    return scoring.offer_grid(p.customer_ids, p.catalog)


@_query
def offer_cost(p: Programme) -> DataFrame:
    return scoring.offer_cost(p.offers.select("offer_id", "offer_type", "level"), p.catalog)


@_query
def logit_score(p: Programme) -> DataFrame:
    return p.scored.select(KEY, "offer_type", "level", "p_accept")


@_query
def scored_base(p: Programme) -> DataFrame:
    return p.scored.select(
        KEY,
        "segment",
        "offer_type",
        "level",
        "p_accept",
        "cost",
        "redemptions_60d",
        "redemptions_total",
        "points_accumulated",
        "recency_today",
    )


@_query
def customer_scores(p: Programme) -> DataFrame:
    return p.customer_scores


@_query
def scores_batch(p: Programme) -> DataFrame:
    return p.score_batch(st.RUN_TS)


def _best_of_run(p: Programme) -> DataFrame:
    return scoring.best_offer(p.score_batch(st.RUN_TS)).select(
        KEY, "offer_type", "level", "p_accept", "cost", "model_version", "scored_at"
    )


@_query
def best_offer(p: Programme) -> DataFrame:
    return _best_of_run(p)


@_query
def offer_mix(p: Programme) -> DataFrame:
    return scoring.offer_mix(_best_of_run(p), ["offer_type"])


@_query
def active_scores(p: Programme) -> DataFrame:
    catalog = controls.catalog_table(p.spark)
    without_cashback = catalog.withColumn("active", F.col("offer_type") != "cashback")
    return scoring.active_scores(p.scored, without_cashback).select(KEY, "offer_type", "level", "p_accept")


@_query
def best_type_per_level(p: Programme) -> DataFrame:
    active = scoring.active_scores(p.scored, controls.catalog_table(p.spark))
    return scoring.best_type_per_level(active).select(KEY, "level", "offer_type", "p_accept")


@_query
def candidate_rank(p: Programme) -> DataFrame:
    grid = scoring.score_grid(p.base, p.catalog, levels=(3,))
    return scoring.rank_candidates(grid).select(KEY, "offer_type", "level", "p_accept", "candidate_rank")


@_query
def expected_value(p: Programme) -> DataFrame:
    values = p.spark.createDataFrame(list(st.OFFER_VALUES.items()), "offer_type string, value double")
    got = scoring.expected_value(p.scored, values)
    return got.select(KEY, "offer_type", "level", "p_accept", "cost", "expected_value")


def _requests(p: Programme) -> DataFrame:
    kinds = F.array(*[F.lit(o.offer_type) for o in p.catalog])
    return p.customer_ids.select(KEY, F.explode(kinds).alias("offer_type"), F.lit(3).alias("level"))


@_query
def score_requests(p: Programme) -> DataFrame:
    got = scoring.score_requests(_requests(p), p.current_features, p.catalog)
    return got.select(KEY, "offer_type", "level", "p_accept", "cost")


# --- rules, decisions, budget, scenarios ------------------------------------


@_query
def rule_match(p: Programme) -> DataFrame:
    return p.matched.select(KEY, "segment", "score_max", "rule", "action", "action_level")


def _market_rules(p: Programme) -> DataFrame:
    """A long list: for each segment and score of the base one rule, the most frequent score first."""
    levels = p.customer_scores.groupBy("segment", "score_max").agg(F.count("*").alias("n"), F.max("redemptions_60d").alias("r"))
    conditions = F.concat(
        F.lit('[{"field":"segment","op":"=","value":"'),
        F.col("segment"),
        F.lit('"},{"field":"score","op":">=","value":'),
        F.col("score_max").cast("string"),
        F.lit('},{"field":"redemptions_60d","op":"<=","value":'),
        F.col("r").cast("string"),
        F.lit("}]"),
    )
    order = [F.desc("n"), F.col("segment"), F.col("score_max")]
    numbered = maintenance.replace_table(levels.withColumn("id", F.lit(0)), order)
    return numbered.select(
        "id",
        F.col("id").alias("priority"),
        F.concat_ws("-", F.lit("score"), "id").alias("name"),
        F.lit(True).alias("active"),
        conditions.alias("conditions"),
        F.lit(BEST_ML).alias("action"),
        (F.col("id") % 3 + 1).cast("int").alias("action_level"),
    )


@_query
def rule_match_indexed(p: Programme) -> DataFrame:
    """The first of as many rules as the base has scores, by bit sets of elementary intervals."""
    customers = staged(p.customer_scores, "customers")
    rule_list = staged(_market_rules(p), "rules")
    return rule_index.match_rules_indexed(customers, rule_list).select(KEY, "segment", "score_max", "rule", "action", "action_level")


@_query
def decisions(p: Programme) -> DataFrame:
    return p.decisions


@_query
def running_cost(p: Programme) -> DataFrame:
    return budget.running_cost(p.decisions).select(KEY, "segment", "cost", "running_cost")


@_query
def final_offers(p: Programme) -> DataFrame:
    return p.final_offers.select(
        KEY, "segment", "rule", "final_offer", "offer_type", "level", "p_accept", "cost", "eligible"
    )


@_query
def segment_offer_mix(p: Programme) -> DataFrame:
    counts = p.final_offers.groupBy("segment", "final_offer").agg(F.count("*").alias("n"))
    return counts.orderBy("segment", "final_offer")


def _scenarios(p: Programme) -> DataFrame:
    current, proposed = scenario.CURRENT, scenario.PROPOSED
    return scenario.decide_scenarios(
        p.candidate_customers,
        p.catalog,
        {current: p.rules, proposed: rules.shift_thresholds(p.rules, st.SCENARIO_SHIFT)},
        {current: p.budgets, proposed: scenario.override_budgets(p.budgets, st.SCENARIO_OVERRIDE)},
    )


@_query
def scenario_decisions(p: Programme) -> DataFrame:
    return _scenarios(p).drop("running_cost")


@_query
def scenario_kpis(p: Programme) -> DataFrame:
    return scenario.scenario_kpis(_scenarios(p), ["scenario"])


@_query
def scenario_delta(p: Programme) -> DataFrame:
    return scenario.scenario_delta(scenario.scenario_kpis(_scenarios(p), ["scenario"]))


@_query
def scenario_distribution(p: Programme) -> DataFrame:
    return scenario.compare_distribution(_scenarios(p))


def _draft_rules(p: Programme) -> DataFrame:
    """Rules drafted from the base: one per segment and market, at the mean best score."""
    stats = (
        p.customer_scores.join(p.customers.select(KEY, "market"), KEY)
        .groupBy("market", "segment")
        .agg(F.count("*").alias("n"), F.round(F.avg("score_max"), 2).alias("threshold"))
    )
    conditions = F.concat(
        F.lit('[{"field":"segment","op":"=","value":"'),
        F.col("segment"),
        F.lit('"},{"field":"score","op":">=","value":'),
        F.col("threshold").cast("string"),
        F.lit("}]"),
    )
    action = F.when(F.col("segment") == "new", "mission").when(F.col("segment") == "champion", "bonus")
    # at most one row per segment and market from here on
    by_name = Window.orderBy("segment", "market")
    by_size = Window.orderBy(F.col("n").desc(), "segment", "market")
    return stats.select(
        F.row_number().over(by_name).alias("id"),
        F.row_number().over(by_size).alias("priority"),
        F.concat_ws(" in ", "segment", "market").alias("name"),
        (F.col("threshold") >= 0.62).alias("active"),
        conditions.alias("conditions"),
        action.otherwise(BEST_ML).alias("action"),
        (F.col("n") % 3 + 1).cast("int").alias("action_level"),
        "market",
        "threshold",
    )


RULE_COLUMNS = ("id", "priority", "name", "active", "conditions", "action", "action_level")


@_query
def rules_active(p: Programme) -> DataFrame:
    return controls.active_rules(_draft_rules(p)).select(*RULE_COLUMNS)


@_query
def rules_text(p: Programme) -> DataFrame:
    return rules.rules_text(_draft_rules(p)).select("id", "name", "condition_text")


@_query
def rule_violations(p: Programme) -> DataFrame:
    """Drafts with one fault per market, to be found again."""
    market = F.col("market")
    broken = F.substring_index("conditions", "}", 1)
    unknown = F.regexp_replace("conditions", '"score"', '"mood"')
    faulty = _draft_rules(p).withColumns(
        {
            "conditions": F.when(market == "BUILDING", broken)
            .when(market == "MACHINERY", unknown)
            .otherwise(F.col("conditions")),
            "action": F.when(market == "HOUSEHOLD", "gift").otherwise(F.col("action")),
            "action_level": F.when(market == "FURNITURE", 4).otherwise(F.col("action_level")),
            "priority": F.when(market != "AUTOMOBILE", F.col("priority")),
        }
    )
    return rules.rule_violations(faulty)


@_query
def rules_replace(p: Programme) -> DataFrame:
    drafts = _draft_rules(p).withColumnRenamed("id", "old_id")
    order = [F.col("threshold").desc(), F.col("old_id")]
    return maintenance.replace_table(drafts, order).select(*RULE_COLUMNS)


# --- screening, model, evaluation, promotion --------------------------------


@_query
def label_correlation(p: Programme) -> DataFrame:
    return screening.label_correlation(p.candidates, features.CANDIDATES, "accepted")


@_query
def correlation_pairs(p: Programme) -> DataFrame:
    return screening.correlation_pairs(p.candidates, features.CANDIDATES)


@_query
def stratified_split(p: Programme) -> DataFrame:
    held = staged(p.labelled_offers.select("offer_id", "accepted"), "labels")
    return evaluation.stratified_split(held, "offer_id", "accepted")


def _offer_scores(p: Programme) -> DataFrame:
    known = p.labelled_offers.na.fill(999, subset=["days_since_redemption"]).na.fill(
        0, subset=["points_expiring_30d", "missions_30d"]
    )
    return known.withColumn("p", scoring.feature_score())


@_query
def auc_exact(p: Programme) -> DataFrame:
    rows = _offer_scores(p).select("accepted", "p", F.explode(F.array(F.lit("all"), "offer_type")).alias("slice"))
    return evaluation.auc(rows, "p", "accepted", ["slice"])


@_query
def accuracy(p: Programme) -> DataFrame:
    return evaluation.accuracy(_offer_scores(p), "p", "accepted", ["offer_type"])


def _test_candidates(p: Programme) -> tuple[DataFrame, DataFrame]:
    """All candidates, and the test part of them."""
    held = staged(p.candidates, "candidates")
    split = evaluation.stratified_split(held, "offer_id", "accepted")
    test = split.filter("is_test").withColumn("own", scoring.affinity(F.col(KEY), F.col("offer_type")))
    return held, test


def _importance(test: DataFrame) -> DataFrame:
    score = scoring.feature_score(F.col("own"))
    return evaluation.permutation_importance(test, "offer_id", features.CANDIDATES, score, "accepted")


@_query
def permutation_importance(p: Programme) -> DataFrame:
    return _importance(_test_candidates(p)[1])


@_query
def feature_selection(p: Programme) -> DataFrame:
    held, test = _test_candidates(p)
    return screening.select_features(_importance(test), screening.correlation_pairs(held, features.CANDIDATES))


def _is_probability() -> F.Column:
    return F.coalesce(F.col("p_accept").between(0, 1), F.lit(False)).alias("is_probability")


@_query
def propensity_gbt(p: Programme) -> DataFrame:
    """Held-out offers scored by the full-size model: each has a probability, and together they beat chance."""
    fitted, _ = p.models.load(champion.CHALLENGER)
    scored = staged(model.predict_proba(fitted, p.split_training_set.filter("is_test")), "held-out")
    quality = evaluation.auc(scored, "p_accept", "accepted").select((F.col("auc") > 0.5).alias("beats_chance"))
    return scored.join(quality).select("offer_id", "accepted", _is_probability(), "beats_chance")


def _from_champion(p: Programme, scored: DataFrame) -> DataFrame:
    """Whether the version in the rows is the one that the alias names, and no version is better."""
    alias = p.models.aliases().filter(F.col("alias") == champion.CHAMPION)
    best = F.max_by("version", F.struct("auc", "version")).alias("best")
    named = alias.join(p.models.versions().agg(best)).select((F.col("version") == F.col("best")).alias("_sound"), F.col("version").alias("_named"))
    return scored.join(named).withColumn("from_champion", F.col("_sound") & (F.col("model_version") == F.col("_named")))


@_query
def champion_batch(p: Programme) -> DataFrame:
    """The scored grid of a run, by the champion: all that SQL can tell of its rows."""
    scored = _from_champion(p, p.champion_batch(st.RUN_TS))
    return scored.select(
        KEY, "offer_type", "level", "cost", *features.FEATURES, "scored_at", _is_probability(), "from_champion"
    )


@_query
def champion_base(p: Programme) -> DataFrame:
    """Customers with how many offers the champion scored, and whether their best score is one of them."""
    scored = _from_champion(p, p.champion_scored)
    best = scored.groupBy(KEY, "segment", "redemptions_60d", "redemptions_total", "points_accumulated", "recency_today").agg(
        F.count("*").alias("offers"),
        F.max("p_accept").alias("p_accept"),
        F.bool_and("from_champion").alias("from_champion"),
    )
    return best.withColumn("is_probability", _is_probability()).drop("p_accept")


@_query
def model_importance(p: Programme) -> DataFrame:
    """Permutation importance of the champion's inputs on held-out offers."""
    fitted, _ = p.models.load(champion.CHAMPION)
    test = p.split_training_set.filter("is_test")

    def score(frame: DataFrame) -> DataFrame:
        return model.predict_proba(fitted, frame).withColumnRenamed("p_accept", "p")

    return evaluation.permutation_importance(test, "offer_id", [*features.FEATURES, "level"], score, "accepted")


def _version_runs(p: Programme) -> DataFrame:
    """The score's quality per market (a model) and quarter (a version)."""
    when = F.col("offer_ts")
    rows = _offer_scores(p).join(p.customers.select(KEY, F.col("market").alias("model")), KEY)
    rows = rows.withColumn("version", (F.year(when) * 4 + F.quarter(when)).cast("int"))
    return evaluation.evaluate(rows, "p", "accepted", ["model", "version"]).select(
        F.concat_ws("-", "model", "version").alias("run_id"), "model", "version", "auc", "accuracy", "n"
    )


@_query
def best_run(p: Programme) -> DataFrame:
    return promotion.best_run(_version_runs(p), ["model"]).drop("n")


@_query
def promotion_ledger(p: Programme) -> DataFrame:
    return promotion.promotion_ledger(_version_runs(p)).drop("accuracy", "n")


@_query
def current_aliases(p: Programme) -> DataFrame:
    return promotion.current_aliases(promotion.promotion_ledger(_version_runs(p)))


# --- table maintenance ------------------------------------------------------


@_query
def catalog_upsert(p: Programme) -> DataFrame:
    """Each customer's offer catalogue, older entries overwritten by newer ones."""

    def activity(part: DataFrame) -> DataFrame:
        return part.groupBy(KEY, "offer_type").agg(F.max("offer_ts").alias("last_offer"), F.count("*").alias("n_offers"))

    cut = ts_lit(st.CATALOG_CUT)
    old, new = p.offers.filter(F.col("offer_ts") < cut), p.offers.filter(F.col("offer_ts") >= cut)
    return maintenance.upsert(activity(old), activity(new), [KEY, "offer_type"])


@_query
def budget_update(p: Programme) -> DataFrame:
    """Customer budgets changed by all spend so far: some to NULL, some for unknown customers."""
    target = p.base.select(KEY, "segment", F.col("points_accumulated").alias("budget"))
    spent = p.past_redemptions.groupBy(KEY).agg(F.sum("points").alias("spent"))
    known = spent.select(KEY, F.when(F.col("spent") <= st.SPEND_LIMIT, F.col("spent")).alias("budget"))
    unknown = p.customer_ids.select(
        (F.col(KEY) + F.lit(st.UNKNOWN_SHIFT)).alias(KEY), F.lit(1).cast("long").alias("budget")
    )
    return maintenance.update_by_key(target, known.unionByName(unknown), [KEY], ["budget"])


def _members(p: Programme, at: str) -> DataFrame:
    got = features.features_at(p.facts, p.customer_ids, ts_lit(at))
    return got.select(KEY, "redemptions_total", "points_accumulated", "missions_30d")


def _member_changes(p: Programme) -> DataFrame:
    """Changes of all members' figures between two dates."""
    return maintenance.change_feed(_members(p, st.EARLIER), _members(p, AS_OF), [KEY])


@_query
def change_feed(p: Programme) -> DataFrame:
    return _member_changes(p)


@_query
def change_feed_by_digest(p: Programme) -> DataFrame:
    """The same changes from two stored versions, of which only buckets that differ are read."""
    path = scratch_path(p.spark, "members")
    old, new = (maintenance.write_bucketed(_members(p, at), path, [KEY]) for at in (st.EARLIER, AS_OF))
    return maintenance.versioned_change_feed(p.spark, path, old, new, [KEY])


@_query
def change_audit(p: Programme) -> DataFrame:
    """Audit rows of two publications, the first one written twice; each is there once."""
    path = scratch_path(p.spark, "audit")
    changes = staged(_member_changes(p), "changes")
    for at in (st.EARLIER, AS_OF, st.EARLIER):
        maintenance.append_audit(maintenance.audit(changes, st.AUDIT_USER, st.AUDIT_ACTION, at), path)
    return maintenance.read_audit(p.spark, path)


@_query
def feature_table_stored(p: Programme) -> DataFrame:
    """The feature table written as two versions and read back; a table with repeated keys is refused between them."""
    path = scratch_path(p.spark, "feature-table")
    rows = staged(p.feature_table, "features")
    maintenance.write_feature_table(rows.filter(F.col(TS) < ts_lit(st.EARLIER)), path, [KEY, TS], TS)
    try:
        maintenance.write_feature_table(rows.select(KEY, TS), path, [KEY])
    except ValueError:
        maintenance.write_feature_table(rows, path, [KEY, TS], TS)
    return maintenance.load(p.spark, path).drop(maintenance.FEATURE_MONTH)


@_query
def offers_of_stored_controls(p: Programme) -> DataFrame:
    """Final offers by control tables as stored, the rules in their second version."""
    path = scratch_path(p.spark, "controls")
    seed = controls.catalog_table(p.spark)
    controls.store_controls(path, seed, p.budgets, p.rules.filter("priority < 30"))
    controls.store_controls(path, seed, p.budgets, p.rules)
    return final_offers(Programme(p.spark, p.folder, controls=path))


@_query
def export_customers(p: Programme) -> DataFrame:
    return maintenance.export_customers(p.customer_scores)


@_query
def export_scores(p: Programme) -> DataFrame:
    return maintenance.export_scores(p.scored)


@_query
def export_counts(p: Programme) -> DataFrame:
    return maintenance.reconcile(
        maintenance.export_customers(p.customer_scores), maintenance.export_scores(p.scored), "customers", "scores"
    )


@_query
def step_counts(p: Programme) -> DataFrame:
    # facts, features and the base are read by several steps
    p.facts = p.held_facts
    p.feature_table, p.base = staged(p.feature_table, "features"), staged(p.base, "base")
    return maintenance.step_counts(
        {
            "snapshots": p.feature_table,
            "training_rows": p.training_set,
            "scored": p.scored,
            "customers": p.customer_scores,
            "final_offers": p.final_offers,
        },
        scratch_path(p.spark, "steps"),
    )


@_query
def snapshot_append(p: Programme) -> DataFrame:
    """Two runs appended, the first one twice; what is stored holds each once."""
    path = scratch_path(p.spark, "snapshot")
    for run_ts in (*st.SNAPSHOT_RUNS, st.SNAPSHOT_RUNS[0]):
        maintenance.append_snapshot(p.score_batch(run_ts), path)
    return maintenance.read_snapshot(p.spark, path).drop(maintenance.RUN_DATE)


def _lots_and_spends(p: Programme) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lots, spends and the customers with too many of them for one task."""

    def named(df: DataFrame, ts: str, line: str, out: str, *more: F.Column) -> DataFrame:
        day = F.date_format(ts, "yyyyMMdd")
        ident = F.concat_ws("-", F.col("order_id").cast("string"), F.col(line).cast("string"), day)
        return df.groupBy(KEY, ident.alias(out), F.col(ts).alias(TS)).agg(F.sum("points").alias("points"), *more)

    lots = named(p.credits, "credit_ts", "line", "lot_id", F.max("expiry_ts").alias("expiry_ts"))
    lots, spends = staged(lots, "lots"), staged(named(p.redemptions, TS, "category", "spend_id"), "spends")
    return lots, spends, busy_groups(KEY, lots, spends)


@_query
def fifo_lots(p: Programme) -> DataFrame:
    lots, spends, busy = _lots_and_spends(p)
    return ledger.fifo_lots(lots, spends, busy=busy)


@_query
def fifo_expiring(p: Programme) -> DataFrame:
    lots, spends, busy = _lots_and_spends(p)
    return ledger.fifo_expiring(lots, spends, busy=busy)


@_query
def spend_cover(p: Programme) -> DataFrame:
    """How much of each spend was covered by points that were there."""
    lots, spends, busy = _lots_and_spends(p)
    used = ledger.spent_from(lots, spends, busy=busy)
    return used.select(KEY, "spend_id", "points", (F.col("end") - F.greatest("start", F.lit(0))).alias("covered"))


# --- drift and streams ------------------------------------------------------


@_query
def drift_profile(p: Programme) -> DataFrame:
    stored = maintenance.read_snapshot(p.spark, p.stored_snapshots(*st.DRIFT_RUNS))
    return drift.drift_profile(stored, st.DRIFT_COLUMNS, "offer_type", "scored_at")


@_query
def drift_ks(p: Programme) -> DataFrame:
    """Each side reads the folders of its own days from the stored runs."""
    path = p.stored_snapshots(*st.DRIFT_RUNS)
    days, baseline = (maintenance.read_snapshot(p.spark, path, part) for part in (st.DRIFT_RUNS[1:], st.DRIFT_RUNS[:1]))
    return drift.drift_ks(days, baseline, st.DRIFT_COLUMNS, "offer_type", "scored_at")


def _stream(df: DataFrame, name: str) -> DataFrame:
    """Write `df` and read it back as a file stream."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).parquet(path)


def _user_features(p: Programme) -> DataFrame:
    """Running counts per user at each event."""
    marked = p.events.select("user_id", TS, "event_id", "event_type").withColumns(
        {
            "one": F.lit(1).cast("long"),
            "error": (F.col("event_type") == "error").cast("long"),
            "block": time_block(F.col(TS), 24),
        }
    )
    return prefix_scan(
        marked,
        ["user_id"],
        ["block"],
        [TS, "event_id"],
        {"events_total": ("sum", "one"), "errors_total": ("sum", "error")},
    ).drop("one", "error", "block")


@_query
def published_features(p: Programme) -> DataFrame:
    rows = _user_features(p)
    key, order = ["user_id"], [TS, "event_id"]
    target, checkpoint = scratch_path(p.spark, "published"), scratch_path(p.spark, "progress")
    publish.publish_stream(_stream(rows, "user-features"), key, order, target, checkpoint).awaitTermination()
    return publish.read_published(p.spark, target, rows.schema, key, order)


@_query
def streamed_scores(p: Programme) -> DataFrame:
    """Every offer as a request, scored with the features that a stream had published for its instant."""
    rows = p.feature_table
    target, versions = scratch_path(p.spark, "scored"), scratch_path(p.spark, "history")
    publish.publish_history(
        _stream(rows, "features"), [KEY], TS, versions, scratch_path(p.spark, "progress")
    ).awaitTermination()
    publish.score_stream(
        _stream(p.offers, "requests"),
        lambda spark: publish.history(spark, versions, rows.schema, [KEY], TS).read(),
        KEY,
        "offer_ts",
        TS,
        p.catalog,
        target,
        scratch_path(p.spark, "progress"),
    ).awaitTermination()
    return p.spark.read.parquet(target).select("offer_id", KEY, "offer_ts", "offer_type", "level", "p_accept", "cost")


def _streamed_counts(p: Programme) -> DataFrame:
    """Value counts that a stream of scored runs has left behind."""
    rows = p.score_batch(*st.DRIFT_RUNS).select("offer_type", *st.DRIFT_COLUMNS, "scored_at")
    target = scratch_path(p.spark, "drift")
    publish.drift_stream(
        _stream(rows, "snapshots"), st.DRIFT_COLUMNS, "offer_type", "scored_at", target, scratch_path(p.spark, "progress")
    ).awaitTermination()
    return publish.drift_state(p.spark, target, "offer_type").read()


@_query
def streamed_drift(p: Programme) -> DataFrame:
    return drift.profile_of_counts(_streamed_counts(p), "offer_type")


@_query
def streamed_ks(p: Programme) -> DataFrame:
    counts = staged(_streamed_counts(p), "counts")
    first = F.col("window_start") == ts_lit(st.DRIFT_RUNS[0])
    return drift.ks_of_counts(counts.filter(~first), counts.filter(first), "offer_type")
