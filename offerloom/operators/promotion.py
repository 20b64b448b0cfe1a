"""Choice of a run and the champion / challenger gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def best_run(runs: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """The run with the highest AUC of each experiment; a missing AUC comes last."""
    first = F.struct(F.col("auc").isNull(), -F.col("auc"), "run_id")
    best = F.min_by(F.struct(*runs.columns), first)  # combines map-side; no group is one task
    return runs.groupBy(*group).agg(best.alias("best")).filter("best is not null").select("best.*")


def promotion_ledger(versions: DataFrame, model: str = "model") -> DataFrame:
    """Verdict on each version in the order of registration.

    A version becomes champion if there is none or its AUC is not below the
    champion's. The champion's AUC never falls, so it is the running maximum of
    the AUCs before; a version without AUC is never promoted.
    """
    before = Window.partitionBy(model).orderBy("version").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(model).orderBy("version").rowsBetween(Window.unboundedPreceding, 0)
    held = F.max("auc").over(before)
    passed = F.col("auc").isNotNull() & (held.isNull() | (F.col("auc") >= held))
    return (
        versions.withColumn("champion_auc_before", held)
        .withColumn("promoted", passed)
        .withColumn("champion_version", F.max(F.when(F.col("promoted"), F.col("version"))).over(upto))
    )


def current_aliases(ledger: DataFrame, model: str = "model") -> DataFrame:
    """Where each alias points after the last registration."""
    newest = ledger.groupBy(model).agg(
        F.max("version").alias("challenger"),
        F.max(F.when(F.col("promoted"), F.col("version"))).alias("champion"),
    )
    pairs = F.array(
        *[F.struct(F.lit(a).alias("alias"), F.col(a).alias("version")) for a in ("challenger", "champion")]
    )
    return newest.select(model, F.explode(pairs).alias("a")).select(model, "a.*").filter("version is not null")
