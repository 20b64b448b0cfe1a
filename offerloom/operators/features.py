"""Customer features as of an instant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.functions.scalars import safe_ratio
from offerloom.functions.timing import asof, days_since, expiring, within
from offerloom.operators.scan import split_busy
from offerloom.operators.timeline import (
    BLOCK_HOURS,
    KEY,
    TS,
    calm_measures,
    category_changes,
    credit_spec,
    fact_changes,
    measures_at,
    measures_of_rows,
    mission_spec,
    redemption_spec,
)

# The feature table's columns and the default of a recency without event.
FEATURES = (
    "redemptions_total",
    "redemptions_90d",
    "points_accumulated",
    "points_expiring_30d",
    "points_expired",
    "days_since_redemption",
    "days_since_credit",
    "missions_30d",
)
CANDIDATES = (
    "redemptions_total",
    "redemptions_30d",
    "redemptions_60d",
    "redemptions_90d",
    "points_accumulated",
    "points_balance",
    "points_expiring_15d",
    "points_expiring_30d",
    "points_expiring_60d",
    "points_expired",
    "days_since_redemption",
    "days_since_credit",
    "days_since_mission",
    "missions_30d",
    "avg_ticket",
    "categories_90d",
    "points_usage_rate",
)
NEVER = 999
FEATURE_DEFAULTS = {
    name: NEVER if name.startswith("days_since") else 0 for name in FEATURES
}


def fill_defaults(df: DataFrame, defaults: dict[str, int]) -> DataFrame:
    """Fill NULLs column by column; a name the table lacks is an error."""
    missing = set(defaults) - set(df.columns)
    if missing:
        raise ValueError(f"no such column: {sorted(missing)}")
    return df.na.fill(defaults)


def recency(last: str, anchor: str = TS) -> Column:
    return days_since(F.col(last), F.col(anchor))


def points_balance(accumulated: Column, spent: Column, expired: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), accumulated - spent - expired)


def points_usage_rate(spent: Column, accumulated: Column) -> Column:
    return safe_ratio(spent, accumulated, 3)


def snapshot_points(redemptions: DataFrame, offers: DataFrame, customer_ids: DataFrame, as_of: Column) -> DataFrame:
    """(customer, ts) of each redemption, each offer, and `as_of` for everyone.

    Points may repeat; as-of aggregation merges them in its own shuffle.
    """
    return (
        redemptions.select(KEY, TS)
        .unionByName(offers.select(KEY, F.col("offer_ts").alias(TS)))
        .filter(F.col(TS) <= as_of)
        .unionByName(customer_ids.select(KEY, as_of.alias(TS)))
    )


def features_asof(
    anchors: DataFrame,
    facts: DataFrame,
    at_redemptions: bool = False,
    until: Column | None = None,
    block_hours: int = BLOCK_HOURS,
    busy: DataFrame | None = None,
) -> DataFrame:
    """The eight table features as of each anchor; a missing recency is 999.

    With `at_redemptions` every redemption in `facts` is an anchor too, without
    another scan of them. `until` is the last anchor if known: what happens later
    is left out before the shuffle. With `busy`, the customers that have too many rows for
    one task, only those are scanned in blocks of time.
    """
    specs = {
        "redemption": redemption_spec(windows=(90,), anchor=at_redemptions),
        "credit": credit_spec(windows=(30,)),
        "mission": mission_spec(windows=(30,)),
    }
    calm = None
    if busy is not None:
        (rest, anchors), (rest_facts, facts) = (split_busy(df, busy, KEY) for df in (anchors, facts))
        calm = calm_measures(rest.select(KEY, TS), rest_facts, specs, until).dropDuplicates([KEY, TS])
    got = calm
    if anchors is not None:
        if until is None:
            changes = fact_changes(facts, specs)
        else:
            changes = fact_changes(facts.filter(F.col(TS) <= until), specs).filter(F.col(TS) <= until)
        scanned = measures_at(anchors, [changes], block_hours)
        got = scanned if calm is None else calm.unionByName(scanned.select(*calm.columns))
    got = got.withColumns(
        {
            "days_since_redemption": recency("last_redemption"),
            "days_since_credit": recency("last_credit"),
        }
    ).select(KEY, TS, *FEATURES)
    return fill_defaults(got, FEATURE_DEFAULTS)


def candidate_measures(
    offers: DataFrame, facts: DataFrame, block_hours: int = BLOCK_HOURS, busy: DataFrame | None = None
) -> DataFrame:
    """All raw measures as of each offer, NULL where no event came before; `busy` as in `features_asof`."""
    specs = {
        "redemption": redemption_spec(windows=(30, 60, 90), spend=True),
        "credit": credit_spec(windows=(15, 30, 60)),
        "mission": mission_spec(windows=(30,)),
    }
    if busy is not None:
        anchors = offers.withColumnRenamed("offer_ts", TS)
        return measures_of_rows(anchors, facts, specs, busy, 90, block_hours).withColumnRenamed(TS, "offer_ts")
    redemptions = facts.filter(F.col("kind") == "redemption")
    changes = [fact_changes(facts, specs), category_changes(redemptions, 90, block_hours)]
    at = measures_at(offers.select(KEY, F.col("offer_ts").alias(TS)), changes, block_hours)
    return offers.join(at.withColumnRenamed(TS, "offer_ts"), [KEY, "offer_ts"], "left")


def candidates(measures: DataFrame, recency_default: int = 0) -> DataFrame:
    """The seventeen screening candidates.

    Screening fills every missing number with 0, recency included; pass 999 as
    `recency_default` for the feature table's regime.
    """
    n, spent, got = (F.col(c) for c in ("redemptions_total", "points_spent", "points_accumulated"))
    out = measures.withColumns(
        {
            "points_balance": points_balance(got, spent, F.col("points_expired")),
            "avg_ticket": safe_ratio(spent, n, 1),
            "points_usage_rate": points_usage_rate(spent, got),
            "days_since_redemption": recency("last_redemption", "offer_ts"),
            "days_since_credit": recency("last_credit", "offer_ts"),
            "days_since_mission": recency("last_mission", "offer_ts"),
        }
    )
    keep = [c for c in measures.columns if c in ("offer_id", KEY, "offer_ts", "offer_type", "level", "accepted")]
    ages = [c for c in CANDIDATES if c.startswith("days_since")]
    return (
        out.select(*keep, *CANDIDATES)
        .na.fill(recency_default, subset=ages)
        .na.fill(0, subset=[c for c in CANDIDATES if c not in ages])
    )


FACT_COLUMNS = (KEY, "kind", TS, "points", "expiry_ts", "category")


def customer_facts(redemptions: DataFrame, credits: DataFrame, missions: DataFrame) -> DataFrame:
    """The three logs side by side in one narrow table."""
    credited = credits.withColumnRenamed("credit_ts", TS)
    out = None
    for kind, log in (("redemption", redemptions), ("credit", credited), ("mission", missions)):
        part = log.withColumn("kind", F.lit(kind)).select(*[c for c in FACT_COLUMNS if c == "kind" or c in log.columns])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.select(*FACT_COLUMNS)


def facts_measures(anchor: Column) -> list[Column]:
    """Aggregates of `customer_facts` rows as of one anchor per group."""
    ts, points, stop = F.col(TS), F.col("points"), F.col("expiry_ts")
    red, cred, mis = (F.col("kind") == k for k in ("redemption", "credit", "mission"))
    total = lambda cond, value: F.sum(F.when(cond, value).otherwise(F.lit(0).cast("long")))
    return [
        F.count_if(red).alias("redemptions_total"),
        F.count_if(red & within(ts, anchor, 60)).alias("redemptions_60d"),
        F.count_if(red & within(ts, anchor, 90)).alias("redemptions_90d"),
        total(cred, points).alias("points_accumulated"),
        total(cred & expiring(stop, anchor, 30), points).alias("points_expiring_30d"),
        total(cred & (stop <= anchor), points).alias("points_expired"),
        F.max(F.when(red, ts)).alias("last_redemption"),
        F.max(F.when(cred, ts)).alias("last_credit"),
        F.count_if(mis & within(ts, anchor, 30)).alias("missions_30d"),
    ]


def features_at(facts: DataFrame, customer_ids: DataFrame, at: Column) -> DataFrame:
    """Features of every customer at one common instant.

    Equal to the newest row of a feature table that has a snapshot at that
    instant, for the price of one map-side combined aggregation.
    """
    got = facts.filter(asof(F.col(TS), at)).groupBy(KEY).agg(*facts_measures(at))
    out = customer_ids.join(got, KEY, "left").select(
        KEY,
        at.alias(TS),
        *[c for c in got.columns if c != KEY and not c.startswith("last_")],
        days_since(F.col("last_redemption"), at).alias("days_since_redemption"),
        days_since(F.col("last_credit"), at).alias("days_since_credit"),
    )
    return fill_defaults(out, FEATURE_DEFAULTS | {"redemptions_60d": 0})


def features_at_each(facts: DataFrame, anchors: DataFrame, at: str, name: str) -> DataFrame:
    """Features of customers as of instants of their own: `anchors` has (customer_id, `name`, `at`), few for each customer.

    Equal to the rows that `features_asof` has for these instants, but facts are neither
    unrolled nor sorted: each meets its customer's instants and is summed up.
    """
    anchor = F.col("_at")
    # what a customer asks for travels as one row, so the facts are read and dealt once
    asked = anchors.groupBy(KEY).agg(F.collect_list(F.struct(F.col(name).alias("_name"), F.col(at).alias("_at"))).alias("_asked"))
    met = facts.join(asked, KEY).select(KEY, *[c for c in facts.columns if c != KEY], F.inline("_asked"))
    got = met.filter(asof(F.col(TS), anchor)).groupBy(KEY, "_name", "_at").agg(*facts_measures(anchor))
    out = anchors.withColumnsRenamed({name: "_name", at: "_at"}).join(got, [KEY, "_name", "_at"], "left").select(
        KEY,
        F.col("_name").alias(name),
        anchor.alias(at),
        *[c for c in got.columns if c in FEATURES],
        days_since(F.col("last_redemption"), anchor).alias("days_since_redemption"),
        days_since(F.col("last_credit"), anchor).alias("days_since_credit"),
    )
    return fill_defaults(out.select(KEY, name, at, *FEATURES), FEATURE_DEFAULTS)


def latest(df: DataFrame, key: str, ts: str) -> DataFrame:
    """The newest row per key, by a map-side combined maximum."""
    rest = [c for c in df.columns if c not in (key, ts)]
    newest = df.groupBy(key).agg(F.max(F.struct(ts, *rest)).alias("r"))
    return newest.select(key, "r.*").select(*df.columns)


def recent(df: DataFrame, key: str, ts: str, n: int) -> DataFrame:
    """The newest `n` rows of every key, numbered from the newest."""
    order = Window.partitionBy(key).orderBy(F.col(ts).desc())
    return df.withColumn("recent_rank", F.row_number().over(order)).filter(F.col("recent_rank") <= n)
