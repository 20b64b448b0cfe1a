"""Continuous publication of features, and streams that read it.

What streams have published is a table of sorted runs (`sources.runs`): every
micro-batch adds a run, levels of runs are merged, and a batch that is run again is
known by its checkpoint and number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from offerloom.operators import drift
from offerloom.operators.features import FEATURE_DEFAULTS, FEATURES, fill_defaults
from offerloom.operators.pit import pit_lookup
from offerloom.operators.scan import busy_groups
from offerloom.operators.scoring import feature_score, offer_cost
from offerloom.sources.controls import Offer
from offerloom.sources.runs import FAN_OUT, Runs


def newest(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest `order` of each key; the maximum is combined map-side."""
    rest = [c for c in df.columns if c not in (*key, *order)]
    top = df.groupBy(*key).agg(F.max(F.struct(*order, *rest)).alias("r"))
    return top.select(*key, "r.*").select(*df.columns)


def _run_name(checkpoint: str) -> str:
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


def _started(source: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def published(
    spark: SparkSession, target: str, schema: StructType, key: Sequence[str], order: Sequence[str], fan_out: int = FAN_OUT
) -> Runs:
    """The published table of the newest row of each key."""
    return Runs(spark, target, schema, lambda rows: newest(rows, key, order), [*key], fan_out)


def publish_stream(
    source: DataFrame, key: Sequence[str], order: Sequence[str], target: str, checkpoint: str, fan_out: int = FAN_OUT
) -> StreamingQuery:
    """Keep the newest row per key of a stream readable under `target`.

    A batch adds its own newest rows as a run. Late rows lose to newer ones wherever
    they meet, on merging or on reading, so the order of batches does not matter. The
    work of a batch grows with the batch, and with a merge of a level now and then.
    """
    run, schema = _run_name(checkpoint), source.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        published(batch.sparkSession, target, schema, key, order, fan_out).append(batch, run, batch_id)

    return _started(source, write, checkpoint)


def read_published(
    spark: SparkSession, target: str, schema: StructType, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The current row of each key over all batches so far."""
    return published(spark, target, schema, key, order).read()


def history(
    spark: SparkSession,
    target: str,
    schema: StructType,
    key: Sequence[str],
    ts: str,
    horizon: str | None = None,
    fan_out: int = FAN_OUT,
) -> Runs:
    """The published versions of each key, for lookups at past instants.

    Of versions before `horizon` only the newest of a key stays; none goes without one.
    """
    at = F.col(ts)

    def merge(rows: DataFrame) -> DataFrame:
        once = rows.dropDuplicates([*key, ts])
        if horizon is None:
            return once
        old = at < F.lit(horizon).cast("timestamp_ntz")
        return once.filter(~old).unionByName(newest(once.filter(old), key, [ts]))

    return Runs(spark, target, schema, merge, [*key, ts], fan_out)


def publish_history(
    source: DataFrame, key: Sequence[str], ts: str, target: str, checkpoint: str, horizon: str | None = None, fan_out: int = FAN_OUT
) -> StreamingQuery:
    """Keep all versions of each key of a stream readable under `target`, from `horizon` on."""
    run, schema = _run_name(checkpoint), source.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        history(batch.sparkSession, target, schema, key, ts, horizon, fan_out).append(batch, run, batch_id)

    return _started(source, write, checkpoint)


def score_stream(
    requests: DataFrame,
    versions: Callable[[SparkSession], DataFrame],
    key: str,
    request_ts: str,
    feature_ts: str,
    catalog: Sequence[Offer],
    target: str,
    checkpoint: str,
) -> StreamingQuery:
    """Score requests with the features of their own instants.

    `versions` opens the published history; every micro-batch reads the version of it
    that is newest when the batch begins. A request meets the last row not after its
    own instant, however late or out of order it comes, as in a batch lookup; without
    one it is scored with the defaults.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        known = versions(batch.sparkSession)
        busy = busy_groups(key, known, batch)
        found = pit_lookup(batch, known, key, request_ts, feature_ts, FEATURES, busy=busy)
        scored = fill_defaults(found, FEATURE_DEFAULTS).withColumn("p_accept", feature_score())
        offer_cost(scored, catalog).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return _started(requests, write, checkpoint)


def drift_state(spark: SparkSession, target: str, slice_by: str, fan_out: int = FAN_OUT) -> Runs:
    """How often each value was seen per day, slice and column; states add up."""
    schema = StructType.fromDDL(f"window_start timestamp_ntz, {slice_by} string, `column` string, value double, n bigint")
    keys = ["window_start", slice_by, "column", "value"]
    return Runs(spark, target, schema, lambda rows: rows.groupBy(*keys).agg(F.sum("n").alias("n")), keys, fan_out)


def drift_stream(
    snapshot: DataFrame,
    columns: Sequence[str],
    slice_by: str,
    ts: str,
    target: str,
    checkpoint: str,
    fan_out: int = FAN_OUT,
) -> StreamingQuery:
    """Keep value counts of a stream of snapshots; profiles and distances are read from them.

    Counts add up, so any order of batches and rows of long past days give what a
    batch over all rows gives: nothing is dropped.
    """
    run = _run_name(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        drift_state(batch.sparkSession, target, slice_by, fan_out).append(
            drift.value_counts(batch, columns, slice_by, ts), run, batch_id
        )

    return _started(snapshot, write, checkpoint)
