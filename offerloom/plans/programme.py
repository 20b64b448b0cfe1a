"""The loyalty programme's derived tables, from raw logs to final offers."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.functions.timing import ts_lit
from offerloom.operators import budget, champion, evaluation, features, pit, rules, scoring, segments
from offerloom.operators.scan import busy_groups
from offerloom.operators.timeline import credit_spec, measures_of_rows, mission_spec, redemption_spec
from offerloom.plans import settings as st
from offerloom.session import scratch_path, shared_dir, staged
from offerloom.sources import controls, maintenance
from offerloom.sources.fixtures import AS_OF, Tables

KEY, TS = "customer_id", "ts"

# Fixed value: the run behind the scores of the linear model.
MODEL_VERSION = 1


class Programme(Tables):
    """Lazy tables of one data folder as of a fixed "now".

    With `controls` the catalogue, budgets and rules are those stored there, else the seed.
    """

    def __init__(self, spark: SparkSession, folder: str, controls: str | None = None) -> None:
        super().__init__(spark, folder)
        self.controls = controls

    @property
    def now(self) -> Column:
        return ts_lit(AS_OF)

    @cached_property
    def catalog(self) -> list[controls.Offer]:
        if self.controls:
            return controls.catalog_offers(controls.stored(self.spark, self.controls, "catalog"))
        return controls.seed_catalog()

    @cached_property
    def past_redemptions(self) -> DataFrame:
        return self.redemptions.filter(F.col(TS) <= self.now)

    @cached_property
    def past_credits(self) -> DataFrame:
        return self.credits.filter(F.col("credit_ts") <= self.now)

    @cached_property
    def past_missions(self) -> DataFrame:
        return self.missions.filter(F.col(TS) <= self.now)

    @cached_property
    def points(self) -> DataFrame:
        return self.every_point.distinct()

    @cached_property
    def every_point(self) -> DataFrame:
        return features.snapshot_points(self.redemptions, self.offers, self.customer_ids, self.now)

    @cached_property
    def past_facts(self) -> DataFrame:
        return self.facts.filter(F.col(TS) <= self.now)

    @cached_property
    def held_facts(self) -> DataFrame:
        """The past facts, joined to their customers once for all that reads them."""
        return staged(self.past_facts, "facts")

    @cached_property
    def busy(self) -> DataFrame:
        """Customers with too many facts and offers for one task."""
        return busy_groups(KEY, self.held_facts, self.offers)

    @cached_property
    def other_points(self) -> DataFrame:
        """Snapshot points that are not redemptions."""
        offered = self.offers.filter(F.col("offer_ts") <= self.now).select(KEY, F.col("offer_ts").alias(TS))
        return offered.unionByName(self.customer_ids.select(KEY, self.now.alias(TS)))

    @cached_property
    def feature_table(self) -> DataFrame:
        """Features at every snapshot point; redemptions mark their own in the scan of the facts."""
        return features.features_asof(
            self.other_points, self.held_facts, at_redemptions=True, until=self.now, busy=self.busy
        )

    @cached_property
    def measures(self) -> DataFrame:
        return features.candidate_measures(self.offers, self.held_facts, busy=self.busy)

    @cached_property
    def candidates(self) -> DataFrame:
        """Screening candidates with the observed answer."""
        ages = self.measures.withColumn("days_since_redemption", features.recency("last_redemption", "offer_ts"))
        labelled = scoring.with_label(ages).drop("days_since_redemption")
        return features.candidates(labelled)

    @cached_property
    def labelled_offers(self) -> DataFrame:
        """Offers with the answer, from just the measures the answer depends on."""
        specs = {
            "redemption": redemption_spec(),
            "credit": credit_spec(windows=(30,)),
            "mission": mission_spec(windows=(30,)),
        }
        joined = measures_of_rows(self.offers.withColumnRenamed("offer_ts", TS), self.held_facts, specs, self.busy)
        joined = joined.withColumnRenamed(TS, "offer_ts")
        joined = joined.withColumn("days_since_redemption", features.recency("last_redemption", "offer_ts"))
        return scoring.with_label(joined)

    @cached_property
    def training_set(self) -> DataFrame:
        """Offers, answer and the features known when the offer was made."""
        looked_up = pit.pit_lookup(self.offers, self.feature_table, KEY, "offer_ts", TS, features.FEATURES, busy=self.busy)
        return scoring.with_label(looked_up)

    @cached_property
    def current_features(self) -> DataFrame:
        return features.features_at(self.facts, self.customer_ids, self.now)

    @cached_property
    def base(self) -> DataFrame:
        return segments.customer_base(self.current_features)

    @cached_property
    def scored(self) -> DataFrame:
        """Every customer, type and level scored with the newest features."""
        return scoring.score_grid(self.base, self.catalog)

    @cached_property
    def customer_scores(self) -> DataFrame:
        return scoring.customer_scores(self.scored, segments.BASE)

    @cached_property
    def candidate_customers(self) -> DataFrame:
        """Customers with their best score and scored candidates."""
        return scoring.customer_candidates(self.scored, segments.BASE)

    @cached_property
    def rules(self) -> DataFrame:
        return controls.stored(self.spark, self.controls, "rules") if self.controls else controls.rules_table(self.spark)

    @cached_property
    def budgets(self) -> DataFrame:
        if self.controls:
            return controls.stored(self.spark, self.controls, "budgets")
        return controls.budgets_table(self.customer_ids)

    @cached_property
    def matched(self) -> DataFrame:
        return rules.match_rules(self.candidate_customers, self.rules)

    @cached_property
    def decisions(self) -> DataFrame:
        return rules.resolve_action(self.matched, self.catalog)

    @cached_property
    def final_offers(self) -> DataFrame:
        return budget.apply_budget(self.decisions, self.budgets)

    @cached_property
    def split_training_set(self) -> DataFrame:
        """The training set with its held-out part marked."""
        rows = staged(self.training_set, "training")
        return staged(evaluation.stratified_split(rows, "offer_id", "accepted"), "split")

    @cached_property
    def models(self) -> champion.ModelStore:
        """The session's store of models fitted on this folder; the first use trains and gates them."""
        place = hashlib.sha256(f"{self.spark.sparkContext.applicationId} {self.folder}".encode()).hexdigest()[:16]
        store = champion.ModelStore(self.spark, f"{shared_dir(self.spark)}/models-{place}")
        if store.versions().count() < len(st.MODEL_SETTINGS):
            split = self.split_training_set
            train, held_out = split.filter(~F.col("is_test")), split.filter("is_test")
            done = store.versions().count()
            champion.train_and_gate(store, train, held_out, st.MODEL_SETTINGS[done:], AS_OF)
        return store

    def stored_snapshots(self, *runs: str) -> str:
        """Path of a snapshot table with the given runs."""
        path = scratch_path(self.spark, "snapshots")
        maintenance.append_snapshot(self.score_batch(*runs), path)
        return path

    def champion_batch(self, *runs: str) -> DataFrame:
        """Grid at pinned instants scored by the champion, with the features used and its version."""
        known = features.fill_defaults(self.features_before(runs), features.FEATURE_DEFAULTS)
        grid = scoring.offer_grid(known, self.catalog)
        return champion.score_with_champion(
            self.models,
            grid,
            [KEY, "offer_type", "level", "p_accept", "cost", *features.FEATURES, "model_version", "scored_at"],
        )

    @cached_property
    def champion_scored(self) -> DataFrame:
        """Every customer, type and level scored by the champion with the newest features."""
        return champion.score_with_champion(self.models, scoring.offer_grid(self.base, self.catalog))

    def features_before(self, runs: Sequence[str]) -> DataFrame:
        """What lookups at each run find in the feature table, NULL features if nothing.

        A lookup can only find a customer's newest snapshot, so only those are computed:
        each customer's newest instants meet its facts, and sums combine before the shuffle.
        """
        found = staged(pit.last_before(self.every_point, KEY, TS, runs), "newest-points")
        known = features.features_at_each(self.past_facts, found, "anchor_ts", "scored_at").drop("anchor_ts")
        asked = self.customer_ids.select(KEY, F.explode(F.array(*[ts_lit(r) for r in runs])).alias("scored_at"))
        return asked.join(known, [KEY, "scored_at"], "left")

    def score_batch(self, *runs: str, version: int = MODEL_VERSION) -> DataFrame:
        """Scored grid at pinned instants with the features used, ready to append."""
        known = features.fill_defaults(self.features_before(runs), features.FEATURE_DEFAULTS)
        grid = scoring.score_grid(known, self.catalog)
        return grid.select(
            KEY,
            "offer_type",
            "level",
            "p_accept",
            "cost",
            *features.FEATURES,
            F.lit(version).alias("model_version"),
            "scored_at",
        )
