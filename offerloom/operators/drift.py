"""Daily profile of scored snapshots and two-sample Kolmogorov-Smirnov distance.

Both are read from value counts: how often each value was seen per day, slice and
column, a null among them. Counts of parts add up, so snapshots may be counted in any
pieces and order, as batches of a stream or all at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.functions.scalars import value_block
from offerloom.operators.scan import prefix_scan

WINDOW = "1 day"


def _long_form(snapshot: DataFrame, columns: Sequence[str], slice_by: str, ts: str) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return snapshot.select(
        F.date_trunc("day", ts).cast("timestamp_ntz").alias("window_start"), slice_by, F.explode(cells).alias("cell")
    ).select("window_start", slice_by, "cell.*")


def value_counts(snapshot: DataFrame, columns: Sequence[str], slice_by: str, ts: str) -> DataFrame:
    """(window_start, slice, column, value, n), a null value counted like any other."""
    cells = _long_form(snapshot, columns, slice_by, ts)
    return cells.groupBy("window_start", slice_by, "column", "value").agg(F.count("*").alias("n"))


def profile_measures(value: Column, n: Column) -> list[Column]:
    """Row count, mean, standard deviation and share of nulls of values seen n times each."""
    known = F.sum(F.when(value.isNotNull(), n))
    total, squares = F.sum(value * n), F.sum(value * value * n)
    spread = F.greatest(F.lit(0.0), squares - total * total / known) / (known - 1)
    return [
        F.sum(n).alias("n"),
        F.round(total / known, 4).alias("mean"),
        F.when(known > 1, F.round(F.sqrt(spread), 4)).alias("stddev"),
        F.round(F.sum(F.when(value.isNull(), n).otherwise(0)) / F.sum(n), 6).alias("null_rate"),
    ]


def profile_of_counts(counts: DataFrame, slice_by: str) -> DataFrame:
    """Profile of each column per day and slice, from value counts."""
    return counts.groupBy("window_start", slice_by, "column").agg(*profile_measures(F.col("value"), F.col("n")))


def drift_profile(snapshot: DataFrame, columns: Sequence[str], slice_by: str, ts: str) -> DataFrame:
    """Profile of each column per day and slice."""
    return profile_of_counts(value_counts(snapshot, columns, slice_by, ts), slice_by)


def ks_of_counts(now: DataFrame, old: DataFrame, slice_by: str) -> DataFrame:
    """Largest gap between a day's distribution and the baseline's, per column and slice.

    `now` and `old` are value counts, of the days asked and of the baseline, which
    counts as one whatever its days. The largest gap lies at a value of the day or just
    before one, so only the baseline's counts up to and below the values seen are
    needed: one scan of the baseline's values serves all days, and the work is
    linear in both. The sizes of both sides are the totals of their scans, so no table
    of sizes is joined.
    """
    by, zero = [slice_by, "column"], F.lit(0).cast("long")
    group = ["window_start", *by]
    now = now.filter("value is not null").select(*group, "value", F.col("n").alias("here"))
    old = old.filter("value is not null").groupBy(*by, "value").agg(F.sum("n").alias("there"))
    asked = now.select(*by, "value", zero.alias("there"), F.lit(True).alias("asked"))
    line = (
        old.withColumn("asked", F.lit(False))
        .unionByName(asked)
        .groupBy(*by, "value")
        .agg(F.sum("there").alias("there"), F.max("asked").alias("asked"))
        .withColumn("value_block", value_block(F.col("value")))
    )
    base = prefix_scan(
        line, by, ["value_block"], ["value"], {"cum_there": ("sum", "there")}, keep="asked", totals={"n_there": "there"}
    )
    seen = now.withColumn("value_block", value_block(F.col("value")))
    steps = prefix_scan(seen, group, ["value_block"], ["value"], {"cum_here": ("sum", "here")}, totals={"n_here": "here"})
    both = steps.drop("value_block").join(base.select(*by, "value", "there", "cum_there", "n_there"), [*by, "value"])
    here, there = F.col("cum_here"), F.col("cum_there")
    gap = lambda h, t: F.abs(h / F.col("n_here") - t / F.col("n_there"))
    largest = F.greatest(gap(here, there), gap(here - F.col("here"), there - F.col("there")))
    # a slice that the baseline does not have has no distance
    return (
        both.filter("n_there > 0")
        .groupBy(*group)
        .agg(F.round(F.max(largest), 6).alias("ks"), F.max("n_here").alias("n"), F.max("n_there").alias("n_baseline"))
    )


def drift_ks(snapshot: DataFrame, baseline: DataFrame, columns: Sequence[str], slice_by: str, ts: str) -> DataFrame:
    """`ks_of_counts` of the days of `snapshot` against all of `baseline`."""
    return ks_of_counts(
        value_counts(snapshot, columns, slice_by, ts), value_counts(baseline, columns, slice_by, ts), slice_by
    )
