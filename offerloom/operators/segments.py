"""Customer base and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("customer_id", "segment", "redemptions_60d", "redemptions_total", "points_accumulated", "recency_today")


def segment(recency: Column, frequency: Column) -> Column:
    """at_risk, new, champion or active; the first that applies."""
    return (
        F.when((recency > 90) & (frequency >= 2), "at_risk")
        .when(frequency <= 1, "new")
        .when((recency <= 30) & (frequency >= 5), "champion")
        .otherwise("active")
    )


def customer_base(features: DataFrame) -> DataFrame:
    """Current features per customer with recency to today and the segment.

    `features` are those at "today", so the recency of the newest redemption is
    already one of them.
    """
    out = features.withColumn("recency_today", F.col("days_since_redemption"))
    return out.withColumn("segment", segment(F.col("recency_today"), F.col("redemptions_total")))
