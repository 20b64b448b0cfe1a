"""Point-in-time lookup: the last feature row not after each spine row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerloom.functions.timing import time_block, ts_lit
from offerloom.operators.scan import BLOCK, block_of, prefix_scan, split_busy
from offerloom.operators.timeline import BLOCK_HOURS


def pit_lookup(
    spine: DataFrame,
    features: DataFrame,
    key: str,
    spine_ts: str,
    feature_ts: str,
    columns: Sequence[str],
    block_hours: int = BLOCK_HOURS,
    busy: DataFrame | None = None,
) -> DataFrame:
    """Spine rows with `columns` of the newest feature row at or before them, else NULL.

    Spine instants and feature rows form one timeline per key, where the newest
    feature row is a running maximum of (ts, values). With `busy`, the keys that have too
    many rows for one task, only those are scanned in blocks of time.
    """
    if busy is not None:
        (calm, spine), (given, features) = (split_busy(df, busy, key) for df in (spine, features))
        got = _calm_lookup(calm, given, key, spine_ts, feature_ts, columns)
        if spine is None:
            return got
        return got.unionByName(pit_lookup(spine, features, key, spine_ts, feature_ts, columns, block_hours))
    packed = F.struct(F.col(feature_ts).alias("at"), *columns)
    empty = F.lit(None).cast(features.select(packed.alias("f")).schema["f"].dataType)
    wanted = spine.select(key, F.col(spine_ts).alias("t"), empty.alias("f"), F.lit(True).alias("asked"))
    given = features.select(key, F.col(feature_ts).alias("t"), packed.alias("f"), F.lit(False).alias("asked"))
    line = (
        wanted.unionByName(given)
        .withColumn("block", time_block(F.col("t"), block_hours))
        .withColumn(BLOCK, block_of([key], ["block"]))
        .repartition(BLOCK)
        .groupBy(BLOCK, key, "t", "block")
        .agg(F.max("f").alias("f"), F.max("asked").alias("asked"))
    )
    found = prefix_scan(line, [key], ["block"], ["t"], {"f": ("max", "f")}, keep="asked")
    found = found.select(
        key, F.col("t").alias(spine_ts), F.col("f.at").alias("feature_ts"), *[F.col(f"f.{c}").alias(c) for c in columns]
    )
    return spine.join(found, [key, spine_ts], "left")


def _calm_lookup(
    spine: DataFrame, features: DataFrame, key: str, spine_ts: str, feature_ts: str, columns: Sequence[str]
) -> DataFrame:
    """`pit_lookup` by one window per key: spine rows travel with all their columns, so none is looked up again."""
    asked = spine.select(F.col(key), F.col(spine_ts).alias("_t"), F.struct(*spine.columns).alias("_own"))
    given = features.select(F.col(key), F.col(feature_ts).alias("_t"), F.struct(F.col(feature_ts).alias("at"), *columns).alias("_f"))
    upto = Window.partitionBy(key).orderBy("_t")
    line = asked.unionByName(given, allowMissingColumns=True).withColumn("_f", F.max("_f").over(upto)).filter("_own is not null")
    known = F.col(key).isNotNull() & F.col("_t").isNotNull()
    found = F.when(known, F.col("_f"))
    values = [found["at"].alias("feature_ts"), *[found[c].alias(c) for c in columns]]
    return line.select("_own.*", *values).select(key, spine_ts, *[c for c in spine.columns if c not in (key, spine_ts)], "feature_ts", *columns)


def last_before(points: DataFrame, key: str, ts: str, runs: Sequence[str]) -> DataFrame:
    """The newest instant of each key at or before each run, in one pass over `points`.

    Returns (key, scored_at, anchor_ts); a key without such an instant has no row.
    """
    newest = points.groupBy(key).agg(
        *[F.max(F.when(F.col(ts) <= ts_lit(run), F.col(ts))).alias(f"r{i}") for i, run in enumerate(runs)]
    )
    pairs = F.array(
        *[F.struct(ts_lit(run).alias("scored_at"), F.col(f"r{i}").alias("anchor_ts")) for i, run in enumerate(runs)]
    )
    return newest.select(key, F.explode(pairs).alias("r")).select(key, "r.*").filter("anchor_ts is not null")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many keys occur more than once (0 for a sound feature table)."""
    return df.groupBy(*keys).count().agg(F.count_if(F.col("count") > 1).alias("duplicate_keys"))
