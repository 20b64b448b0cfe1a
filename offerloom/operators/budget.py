"""Budget cut: serve the likeliest customers of a segment until its budget is spent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.operators.scan import prefix_scan, ranged
from offerloom.sources.fixtures import NO_OFFER


def running_cost(decisions: DataFrame, scenario: Sequence[str] = (), limits: DataFrame | None = None) -> DataFrame:
    """Cumulative cost within each segment by falling probability, then customer.

    `limits` has a row per (scenario and) segment, whose other columns the rows get; it
    is joined to the totals of blocks, which are few, and not to the rows.

    Segments are few and huge, and one probability may be shared by a large part
    of the customers, so blocks are ranges of (segment, probability, customer).
    """
    group = [*scenario, "segment"]
    order = [F.col("p_accept").desc(), F.col("customer_id")]
    laid = ranged(decisions, [*[F.col(g) for g in group], *order], "decisions")
    laid = laid.withColumn("spent", F.col("cost").cast("long"))
    return prefix_scan(laid, group, ["block"], order, {"running_cost": ("sum", "spent")}, known=limits).drop("spent", "block")


def apply_budget(decisions: DataFrame, budgets: DataFrame, scenario: Sequence[str] = ()) -> DataFrame:
    """Final offer per customer.

    The running cost counts rows that no longer fit, so once a segment is over
    budget every later costly row is refused. A segment without budget has 0; the
    lines of a segment listed several times add up.
    """
    limits = budgets.groupBy(*scenario, "segment").agg(F.sum("budget").alias("budget"))
    fits = (F.col("offer_type") != NO_OFFER) & (F.col("running_cost") <= F.coalesce("budget", F.lit(0)))
    return (
        running_cost(decisions, scenario, limits)
        .withColumn("eligible", fits)
        .withColumn("final_offer", F.when(F.col("eligible"), F.col("offer_type")).otherwise(NO_OFFER))
        .drop("budget")
    )
