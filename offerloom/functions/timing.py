"""Time predicates. Timestamps are zone-less, so results do not depend on the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TS_TYPE = "timestamp_ntz"


def ts_lit(value: str) -> Column:
    return F.lit(value).cast(TS_TYPE)


def days(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} DAYS")


def asof(ts: Column, anchor: Column) -> Column:
    """The event has happened by the anchor; an event at the anchor counts."""
    return ts <= anchor


def within(ts: Column, anchor: Column, n: int) -> Column:
    """The event lies in the last `n` days; one exactly `n` days old does not count."""
    return ts > anchor - days(n)


def expiring(expiry: Column, anchor: Column, n: int) -> Column:
    """Still valid at the anchor and expiring within `n` days, the last day included."""
    return (expiry > anchor) & (expiry <= anchor + days(n))


def days_since(ts: Column, anchor: Column) -> Column:
    """Whole calendar days between an event and the anchor."""
    return F.datediff(anchor, ts)


def time_block(ts: Column, hours: int) -> Column:
    """Order-preserving block number of a timestamp; equal blocks span `hours` hours.

    Never NULL: a nullable join key would put a filter below one pass of a scan
    only, and the two passes could no longer share a shuffle.
    """
    hour = F.datediff(ts, F.lit("1970-01-01").cast("date")) * 24 + F.hour(ts)
    return F.coalesce(F.floor(hour / F.lit(hours)).cast("long"), F.lit(0))
