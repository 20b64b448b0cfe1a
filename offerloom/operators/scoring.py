"""Propensity score, candidate grids and rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.functions.scalars import choose, hash_uniform, sigmoid
from offerloom.sources.controls import Offer
from offerloom.sources.fixtures import LEVELS

# Weights of the linear score.
INTERCEPT = -1.2
LEVEL_WEIGHT = 0.45
TYPE_WEIGHT = {"cashback": 0.5, "bonus": 0.2, "discount": 0.05, "mission": -0.2}
RECENCY_WEIGHT = -0.004
RECENCY_CAP = 365
EXPIRY_WEIGHT = 0.0026
EXPIRY_CAP = 500
EXPIRY_FACTOR = {"mission": 0.3}
EXPIRY_FACTOR_ELSE = 1.6
MISSION_WEIGHT = 0.15
AFFINITY_WEIGHT = 0.8
SCORE_DIGITS = 6


def linear_score(
    offer_type: Column, level: Column, recency: Column, expiring_30d: Column, missions_30d: Column
) -> Column:
    """The linear term of the propensity, without customer affinity."""
    return (
        F.lit(INTERCEPT)
        + LEVEL_WEIGHT * level
        + choose(offer_type, TYPE_WEIGHT, 0.0)
        + RECENCY_WEIGHT * F.least(recency, F.lit(RECENCY_CAP))
        + EXPIRY_WEIGHT
        * F.least(expiring_30d, F.lit(EXPIRY_CAP))
        * choose(offer_type, EXPIRY_FACTOR, EXPIRY_FACTOR_ELSE)
        + MISSION_WEIGHT * missions_30d
    )


def affinity(customer: Column, offer_type: Column) -> Column:
    return AFFINITY_WEIGHT * hash_uniform(customer, offer_type)


def logit_score(z: Column) -> Column:
    """Probability of the linear score, rounded before it is compared or ranked."""
    return F.round(sigmoid(z), SCORE_DIGITS)


def feature_score(affinity_column: Column | None = None) -> Column:
    """Score from feature columns of the row; the affinity is hashed unless given."""
    own = affinity(F.col("customer_id"), F.col("offer_type")) if affinity_column is None else affinity_column
    z = linear_score(
        F.col("offer_type"),
        F.col("level"),
        F.col("days_since_redemption"),
        F.col("points_expiring_30d"),
        F.col("missions_30d"),
    )
    return logit_score(z + own)


def with_label(df: DataFrame) -> DataFrame:
    """Observed answer to each offer: the score without affinity against a hashed uniform."""
    z = linear_score(
        F.col("offer_type"),
        F.col("level"),
        F.coalesce(F.col("days_since_redemption"), F.lit(RECENCY_CAP)),
        F.coalesce(F.col("points_expiring_30d"), F.lit(0)),
        F.coalesce(F.col("missions_30d"), F.lit(0)),
    )
    return df.withColumn("accepted", (hash_uniform(F.col("offer_id")) < sigmoid(z)).cast("int"))


def offer_grid(customers: DataFrame, catalog: Sequence[Offer], levels: Sequence[int] = LEVELS) -> DataFrame:
    """Every customer with every catalogue type and level, cost included.

    The grid is unrolled inside each customer's row: nothing is shuffled, and the
    customers' partitioning is kept.
    """
    types = F.array(
        *[
            F.struct(
                F.lit(o.offer_type).alias("offer_type"),
                F.lit(o.base_cost).cast("int").alias("base_cost"),
                F.lit(o.active).alias("active"),
            )
            for o in catalog
        ]
    )
    own = customers.columns
    return (
        customers.withColumn("o", F.explode(types))
        .select(*own, "o.*")
        .withColumn("level", F.explode(F.array(*[F.lit(int(n)) for n in levels])))
        .withColumn("cost", (F.col("base_cost") * F.col("level")).cast("int"))
        .drop("base_cost")
    )


def score_grid(customers: DataFrame, catalog: Sequence[Offer], levels: Sequence[int] = LEVELS) -> DataFrame:
    """Scored grid; the affinity hash is taken once per type, before levels unroll."""
    base = customers.withColumn(
        "affinities",
        F.create_map(
            *[x for o in catalog for x in (F.lit(o.offer_type), affinity(F.col("customer_id"), F.lit(o.offer_type)))]
        ),
    )
    grid = offer_grid(base, catalog, levels)
    mine = F.coalesce(F.element_at("affinities", F.col("offer_type")), F.lit(0.0))
    return grid.withColumn("p_accept", feature_score(mine)).drop("affinities")


def offer_cost(df: DataFrame, catalog: Sequence[Offer]) -> DataFrame:
    """Cost of each row's (type, level): base cost x level, 0 for a type not in the catalogue."""
    base = choose(F.col("offer_type"), {o.offer_type: o.base_cost for o in catalog}, 0)
    return df.withColumn("cost", (base * F.col("level")).cast("int"))


def active_scores(scores: DataFrame, catalog: DataFrame) -> DataFrame:
    """Scores of the types that are active in the catalogue."""
    return scores.join(catalog.filter("active").select("offer_type"), "offer_type", "left_semi")


def _best_first() -> list[Column]:
    return [F.col("p_accept").desc(), F.col("cost"), F.col("offer_type"), F.col("level")]


def best_offer(scores: DataFrame) -> DataFrame:
    """The most likely candidate of each customer; ties go to the cheaper one."""
    w = Window.partitionBy("customer_id").orderBy(*_best_first())
    return scores.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def best_type_per_level(scores: DataFrame) -> DataFrame:
    """The most likely type for each customer and level."""
    w = Window.partitionBy("customer_id", "level").orderBy(*_best_first())
    return scores.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def rank_candidates(scores: DataFrame) -> DataFrame:
    """Rank of every candidate among its customer's."""
    w = Window.partitionBy("customer_id").orderBy(*_best_first())
    return scores.withColumn("candidate_rank", F.row_number().over(w))


def expected_value(scores: DataFrame, values: DataFrame) -> DataFrame:
    """Best candidate by p x value - cost; `values` holds one value per offer type."""
    valued = scores.join(values, "offer_type").withColumn(
        "expected_value", F.round(F.col("p_accept") * F.col("value") - F.col("cost"), 6)
    )
    w = Window.partitionBy("customer_id").orderBy(F.col("expected_value").desc(), *_best_first())
    return valued.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def customer_candidates(scored: DataFrame, profile: Sequence[str]) -> DataFrame:
    """One row per customer: profile, best score, and the scored candidates as an array.

    The array holds one entry per catalogue type and level, whatever the size of
    the base. It is built where the grid's rows already are: no shuffle is added,
    and decisions need no join back to the grid.
    """
    entry = F.struct("offer_type", "level", "active", "p_accept", "cost")
    return scored.groupBy(*profile).agg(
        F.max("p_accept").alias("score_max"), F.collect_list(entry).alias("candidates")
    )


def customer_scores(scored: DataFrame, profile: Sequence[str]) -> DataFrame:
    """The best score per customer profile."""
    return scored.groupBy(*profile).agg(F.max("p_accept").alias("score_max"))


def offer_mix(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts by `keys`, largest first."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), *keys)


def score_requests(requests: DataFrame, features: DataFrame, catalog: Sequence[Offer]) -> DataFrame:
    """Score (customer, type, level) requests from current features.

    A customer without features is scored with the defaults, a type outside the
    catalogue with the neutral type weight.
    """
    from offerloom.operators.features import FEATURE_DEFAULTS, FEATURES, fill_defaults

    current = features.select("customer_id", *FEATURES)
    joined = fill_defaults(requests.join(current, "customer_id", "left"), FEATURE_DEFAULTS)
    return offer_cost(joined.withColumn("p_accept", feature_score()), catalog)
