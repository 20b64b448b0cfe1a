"""Running aggregates over groups of any size.

A plain window gives each group to one task. Here a group is cut into blocks by
an order-preserving block key: every block is scanned by itself, the block
totals (few per group) are scanned on top, and each row adds what came before
its block. Sums over integers, minima and maxima combine exactly. A group's total, and
what else is known per group, rides on the block totals, so rows need no join on a
group that all of them may share.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.session import staged

_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def _combine(kind: str, inside: Column, before: Column) -> Column:
    if kind == "sum":
        zero = F.lit(0)
        return F.coalesce(inside, zero) + F.coalesce(before, zero)
    return (F.greatest if kind == "max" else F.least)(inside, before)


BLOCK = "_block"
# Rows of a group that one task may scan: some 100 MB as changes of features.
MOST = 100_000


def busy_groups(key: str, *frames: DataFrame, most: int = MOST) -> DataFrame:
    """(key): the groups with more than `most` rows in all `frames`; they are few, as each has so many. Null is a group.

    The frames are read for it: stage costly ones.
    """
    rows = None
    for frame in frames:
        part = frame.select(key)
        rows = part if rows is None else rows.unionByName(part)
    return staged(rows.groupBy(key).count().filter(F.col("count") > most).select(key), "busy")


def split_busy(df: DataFrame, busy: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows of `df` by whether their group is in `busy`; the second part is None if no group is."""
    if busy.isEmpty():
        return df, None
    listed = F.broadcast(busy.select(F.col(key).alias("_busy")))
    same = F.col(key).eqNullSafe(F.col("_busy"))
    return df.join(listed, same, "left_anti"), df.join(listed, same, "left_semi")


def block_of(group: Sequence[str], block: Sequence[str]) -> Column:
    """The key that `prefix_scan` cuts by; rows that have it as `_block`, and are dealt by it, are not dealt again."""
    return F.struct(*group, *block)


def prefix_scan(
    df: DataFrame,
    group: Sequence[str],
    block: Sequence[str],
    order: Sequence[Column | str],
    running: Mapping[str, tuple[str, str]],
    inclusive: bool = True,
    keep: str | None = None,
    totals: Mapping[str, str] | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """Add running aggregates `{output: (sum|max|min, column)}` to `df`, and `totals` `{output: column}` summed over the group.

    `block` must not decrease along `order` within a group, and `order` must be
    unique within a block. Null is a group like any other. `keep` names a boolean column: rows without it feed
    the aggregates but are not returned. `known` has the columns of `group`, at most one
    row for each, and others that the group's rows get (null where it has none). Both passes read `df`; stage it first
    unless it ends in a shuffle that Spark can reuse.
    """
    # one struct, as structs with null fields are equal: rows of a null group keep their totals
    df_columns, keys = [c for c in df.columns if c != BLOCK], [BLOCK]
    if BLOCK not in df.columns:
        df = df.withColumn(BLOCK, block_of(group, block))
    upto = 0 if inclusive else -1
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)
    before = (
        Window.partitionBy(*[F.col(f"_block.{g}") for g in group])
        .orderBy(*[F.col(f"_block.{b}") for b in block])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy(*[F.col(f"_block.{g}") for g in group])
    totals = totals or {}
    sums = [_AGG[fn](col).alias(f"_t_{out}") for out, (fn, col) in running.items()]
    sums += [F.sum(col).alias(f"_s_{out}") for out, col in totals.items()]
    if keep:
        sums.append(F.max(keep).alias("_wanted"))
    offsets = df.groupBy(*keys).agg(*sums)
    offsets = offsets.select(
        *keys,
        *(["_wanted"] if keep else []),
        *[F.sum(f"_s_{out}").over(whole).alias(f"_all_{out}") for out in totals],
        *[
            _AGG[fn](f"_t_{out}").over(before).alias(f"_off_{out}")
            for out, (fn, _) in running.items()
        ],
    )
    more = [c for c in known.columns if c not in group] if known is not None else []
    if known is not None:
        given = known.select(*[F.col(g).alias(f"_g_{g}") for g in group], *[F.col(c).alias(f"_all_{c}") for c in more])
        same = F.lit(True)
        for g in group:
            same = same & F.col(f"_block.{g}").eqNullSafe(F.col(f"_g_{g}"))
        offsets = offsets.join(given, same, "left").drop(*[f"_g_{g}" for g in group])
    within = [_AGG[fn](col).over(inside).alias(f"_in_{out}") for out, (fn, col) in running.items()]
    if keep:
        # blocks without a wanted row end here; only the others are sorted and scanned
        rows = df.join(offsets.filter("_wanted").drop("_wanted"), keys).select("*", *within).filter(F.col(keep))
    else:
        rows = df.select("*", *within).join(offsets, keys)
    return rows.select(
        *[F.col(c) for c in df_columns if c not in {*running, *totals, *more}],
        *[
            _combine(fn, F.col(f"_in_{out}"), F.col(f"_off_{out}")).alias(out)
            for out, (fn, _) in running.items()
        ],
        *[F.col(f"_all_{out}").alias(out) for out in (*totals, *more)],
    )


def whole_scan(
    df: DataFrame,
    group: Sequence[str],
    block: Sequence[str],
    order: Sequence[Column | str],
    running: Mapping[str, tuple[str, str]],
    inclusive: bool = True,
) -> DataFrame:
    """What `prefix_scan` adds, by a plain window: for groups that a task can hold. `block` is not needed."""
    upto = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    zero = F.lit(0).cast("long")
    got = {out: _AGG[fn](col).over(upto) for out, (fn, col) in running.items()}
    return df.withColumns({out: F.coalesce(c, zero) if running[out][0] == "sum" else c for out, c in got.items()})


def ranged(df: DataFrame, order: Sequence[Column | str], name: str = "ranged") -> DataFrame:
    """Lay `df` out in ranges of `order` and number the ranges in a column `block`.

    Spark samples the order itself, so any skew in its leading columns is split
    as long as the whole order is unique. The ranges are written once: both
    passes of a scan, and any retry, then see the same block numbers.
    """
    cut = df.repartitionByRange(*order).withColumn("block", F.spark_partition_id().cast("long"))
    return staged(cut, name)
