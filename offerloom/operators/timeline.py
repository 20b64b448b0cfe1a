"""As-of aggregates on one timeline per customer.

Every measure is a running sum of changes: a trailing count adds 1 at the event
and takes it back N days later, a lot starts and stops "expiring soon" at known
instants, and so on. Changes and anchor points meet in one table keyed by
(customer, instant); its size is linear in the input, whereas joining anchors to
events is quadratic per customer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.functions.timing import TS_TYPE, days, time_block
from offerloom.operators.scan import BLOCK, block_of, prefix_scan, split_busy

KEY = "customer_id"
TS = "ts"
ANCHOR = "anchor"
BLOCK_HOURS = 30 * 24

LAST = {"last_redemption", "last_credit", "last_mission"}

# What one event changes: instants, each with its changes by measure.
Changes = Sequence[tuple[Column, dict[str, Column]]]


def _names(*specs: Changes) -> list[str]:
    return list(dict.fromkeys(name for spec in specs for _, change in spec for name in change))


def _rows(spec: Changes, names: Sequence[str]) -> Column:
    """The changes of one event as an array of equally shaped structs."""

    def blank(name: str) -> Column:
        if name == ANCHOR:
            return F.lit(False)
        return F.lit(None).cast(TS_TYPE) if name in LAST else F.lit(0).cast("long")

    return F.array(
        *[
            F.struct(at.alias(TS), *[change.get(n, blank(n)).alias(n) for n in names])
            for at, change in spec
        ]
    )


def _unrolled(events: DataFrame, rows: Column) -> DataFrame:
    return events.select(KEY, F.explode(rows).alias("c")).select(KEY, "c.*").filter(F.col(TS).isNotNull())


def redemption_spec(windows: Sequence[int] = (), spend: bool = False, anchor: bool = False) -> Changes:
    """Lifetime and trailing counts, last redemption, points spent.

    With `anchor`, each redemption is a point at which measures are wanted.
    """
    ts, one = F.col(TS), F.lit(1).cast("long")
    start = {"redemptions_total": one, "last_redemption": ts}
    if spend:
        start["points_spent"] = F.col("points")
    if anchor:
        start[ANCHOR] = F.lit(True)
    start |= {f"redemptions_{n}d": one for n in windows}
    return [(ts, start), *[(ts + days(n), {f"redemptions_{n}d": -one}) for n in windows]]


def credit_spec(windows: Sequence[int] = (), start_column: str = TS) -> Changes:
    """Accumulated, expired and soon-expiring points, last credit."""
    start, stop, points = F.col(start_column), F.col("expiry_ts"), F.col("points")
    live = F.when(stop > start, points).otherwise(F.lit(0).cast("long"))
    ended = F.when(stop.isNotNull(), F.greatest(start, stop))
    changes = [
        (start, {"points_accumulated": points, "last_credit": start}),
        (ended, {"points_expired": points} | {f"points_expiring_{n}d": -live for n in windows}),
    ]
    for n in windows:
        opens = F.when(stop.isNotNull(), F.greatest(start, stop - days(n)))
        changes.append((opens, {f"points_expiring_{n}d": live}))
    return changes


def mission_spec(windows: Sequence[int] = (30,)) -> Changes:
    """Trailing mission counts, last mission."""
    ts, one = F.col(TS), F.lit(1).cast("long")
    start = {"last_mission": ts} | {f"missions_{n}d": one for n in windows}
    return [(ts, start), *[(ts + days(n), {f"missions_{n}d": -one}) for n in windows]]


def redemption_changes(redemptions: DataFrame, windows: Sequence[int] = (), spend: bool = False) -> DataFrame:
    spec = redemption_spec(windows, spend)
    return _unrolled(redemptions, _rows(spec, _names(spec)))


def credit_changes(credits: DataFrame, windows: Sequence[int] = ()) -> DataFrame:
    spec = credit_spec(windows, "credit_ts")
    return _unrolled(credits, _rows(spec, _names(spec)))


def mission_changes(missions: DataFrame, windows: Sequence[int] = (30,)) -> DataFrame:
    spec = mission_spec(windows)
    return _unrolled(missions, _rows(spec, _names(spec)))


def fact_changes(facts: DataFrame, specs: Mapping[str, Changes]) -> DataFrame:
    """Changes of all kinds of facts from a single scan of them."""
    names = _names(*specs.values())
    rows = None
    for kind, spec in specs.items():
        rows = (F if rows is None else rows).when(F.col("kind") == kind, _rows(spec, names))
    return _unrolled(facts, rows)


def category_changes(redemptions: DataFrame, window: int = 90, block_hours: int = BLOCK_HOURS) -> DataFrame:
    """Changes of the number of distinct categories in the trailing window.

    A category is present from each event until `window` days later or until its
    next event, whichever comes first, so presences never overlap.
    """
    seen = (
        redemptions.groupBy(KEY, "category", TS)
        .agg(F.lit(True).alias("seen"))
        .withColumn("back", -time_block(F.col(TS), block_hours))
    )
    nexts = prefix_scan(
        seen, [KEY, "category"], ["back"], [F.col(TS).desc()], {"next_ts": ("min", TS)}, inclusive=False
    )
    ts, one, name = F.col(TS), F.lit(1).cast("long"), f"categories_{window}d"
    end = F.least(ts + days(window), F.col("next_ts"))
    return _unrolled(nexts, _rows([(ts, {name: one}), (end, {name: -one})], [name]))


def measures_at(
    anchors: DataFrame, changes: Sequence[DataFrame], block_hours: int = BLOCK_HOURS
) -> DataFrame:
    """Every measure in `changes` as of each distinct (customer, ts) of `anchors`.

    Changes at one instant are summed where the scan has them. A customer is scanned
    in blocks of `block_hours`, so one with a third of all events still spreads
    over the tasks; take shorter blocks for sources with dense sub-day times.
    """
    names = list(dict.fromkeys(n for c in changes for n in c.columns if n not in (KEY, TS, ANCHOR)))
    line = anchors.select(KEY, TS, F.lit(True).alias(ANCHOR))
    for frame in changes:
        line = line.unionByName(frame, allowMissingColumns=True)
    # dealt once, by the block of the scan: changes of one instant meet there, and so do both passes
    line = line.withColumn("block", time_block(F.col(TS), block_hours)).withColumn(BLOCK, block_of([KEY], ["block"]))
    line = (
        line.repartition(BLOCK)
        .groupBy(BLOCK, KEY, TS, "block")
        .agg(
            *[(F.max(n) if n in LAST else F.sum(n)).alias(n) for n in names],
            F.coalesce(F.max(ANCHOR), F.lit(False)).alias(ANCHOR),
        )
    )
    running = {n: ("max" if n in LAST else "sum", n) for n in names}
    return prefix_scan(line, [KEY], ["block"], [TS], running, keep=ANCHOR).drop("block", ANCHOR)


def calm_measures(
    anchors: DataFrame, facts: DataFrame, specs: Mapping[str, Changes], until: Column | None = None, window: int | None = None
) -> DataFrame:
    """Every measure of `specs` as of each row of `anchors`, for customers of whom none has too many rows for one task.

    Facts and anchors are dealt by customer as they are. Behind the shuffle a fact becomes
    a row for each instant it changes something at, which says which change it is, and the
    changes are worked out on sorted rows. With `window` there is the number of distinct
    categories of that many days. Returns the columns of `anchors`, and a row for each fact
    that is an anchor too; with `until`, what happens later is left out.
    """
    kinds, next_ts = {kind: list(spec) for kind, spec in specs.items()}, F.col("_next")
    if window:
        name, one = f"categories_{window}d", F.lit(1).cast("long")
        # present until `window` days later or until the category's next event
        there = [(F.col(TS), {name: one}), (F.least(F.col(TS) + days(window), next_ts), {name: -one})]
        kinds["redemption"] = kinds.get("redemption", []) + there
    own = [c for c in anchors.columns if c not in (KEY, TS)]
    kinds[ANCHOR] = [(F.col(TS), {ANCHOR: F.lit(True)})]
    asked = anchors.select(KEY, TS, F.lit(ANCHOR).alias("kind"), F.struct(F.lit(0), *own).alias("_own"))
    needed = [KEY, "kind", TS, *[c for c in ("points", "expiry_ts", "category") if c in facts.columns]]
    given = facts.filter(F.col("kind").isin(*specs, *(["redemption"] if window else [])))
    if until is not None:
        given = given.filter(F.col(TS) <= until)
    line = given.select(*needed).unionByName(asked, allowMissingColumns=True)
    # in all the partitions there are: rows grow behind the shuffle, so its bytes are no measure for merging some
    line = line.repartition(int(line.sparkSession.conf.get("spark.sql.shuffle.partitions")), KEY)
    if window:
        line = line.withColumn("_next", F.lead(TS).over(Window.partitionBy(KEY, "kind", "category").orderBy(TS)))
    numbered, instants = [], None
    for kind, spec in kinds.items():
        first = len(numbered)
        numbered += spec
        at = F.array(*[F.struct(at.alias("_at"), F.lit(first + i).alias("_change")) for i, (at, _) in enumerate(spec)])
        instants = (F if instants is None else instants).when(F.col("kind") == kind, at)
    asks = [i for i, (_, change) in enumerate(numbered) if ANCHOR in change]
    wanted = F.col("_change").isin(*asks)
    counted = F.col("_at").isNotNull() if until is None else F.col("_at") <= until
    rows = line.select("*", F.inline(instants)).filter(counted | (F.col("_change") == len(numbered) - 1))
    names = [n for n in _names(*kinds.values()) if n != ANCHOR]
    amounts = {}
    for name in names:
        amount = None
        for i, (_, change) in enumerate(numbered):
            if name in change:
                amount = (F if amount is None else amount).when(F.col("_change") == i, change[name])
        amounts[name] = amount
    # sorted while a row is narrow; the scan keeps this order
    rows = rows.sortWithinPartitions(KEY, "_at").select(KEY, TS, "_at", "_own", wanted.alias(ANCHOR), *[a.alias(n) for n, a in amounts.items()])
    upto = Window.partitionBy(KEY).orderBy("_at")  # what is at one instant counts together
    zero = F.lit(0).cast("long")
    sums = [F.max(n).over(upto).alias(n) if n in LAST else F.coalesce(F.sum(n).over(upto), zero).alias(n) for n in names]
    return rows.select(KEY, TS, "_own", ANCHOR, *sums).filter(ANCHOR).select(KEY, TS, *[F.col(f"_own.{c}").alias(c) for c in own], *names)


def measures_of_rows(
    anchors: DataFrame,
    facts: DataFrame,
    specs: Mapping[str, Changes],
    busy: DataFrame,
    window: int | None = None,
    block_hours: int = BLOCK_HOURS,
) -> DataFrame:
    """Rows of `anchors` with every measure as of their instants, NULL without a customer or an instant.

    The customers in `busy` are scanned in blocks of time, all others as wholes.
    """
    (calm, hot), (facts, hot_facts) = (split_busy(df, busy, KEY) for df in (anchors, facts))
    got = calm_measures(calm, facts, specs, window=window)
    names = [c for c in got.columns if c not in anchors.columns]
    known = F.col(KEY).isNotNull() & F.col(TS).isNotNull()
    got = got.select(*anchors.columns, *[F.when(known, F.col(n)).alias(n) for n in names])
    if hot is None:
        return got
    changes = [fact_changes(hot_facts, specs)] if specs else []
    if window:
        changes.append(category_changes(hot_facts.filter(F.col("kind") == "redemption"), window, block_hours))
    at = measures_at(hot.select(KEY, TS), changes, block_hours)
    return got.unionByName(hot.join(at, [KEY, TS], "left").select(*got.columns))
