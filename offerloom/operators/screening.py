"""Signal, redundancy and selection of candidate features."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerloom.session import staged

# Thresholds of the selection.
WEAK_BELOW = 0.001
REDUNDANT_ABOVE = 0.9


def _pearson(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson correlation of each pair of columns without NULLs.

    One pass sums values, squares and products; the pairs are then unrolled from
    a single row.
    """
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    x = {c: F.col(c).cast("double") for c in names}
    one = df.agg(
        F.count("*").cast("double").alias("n"),
        F.array(*[F.sum(x[c]) for c in names]).alias("s"),
        F.array(*[F.sum(x[c] * x[c]) for c in names]).alias("q"),
        F.array(*[F.sum(x[a] * x[b]) for a, b in pairs]).alias("cross"),
    )
    at = F.col("k") + 1
    rows = one.select("n", "s", "q", F.posexplode("cross").alias("k", "xy")).withColumns(
        {
            "first": F.element_at(F.array(*[F.lit(a) for a, _ in pairs]), at),
            "second": F.element_at(F.array(*[F.lit(b) for _, b in pairs]), at),
            "i": F.element_at(F.array(*[F.lit(names.index(a) + 1) for a, _ in pairs]), at),
            "j": F.element_at(F.array(*[F.lit(names.index(b) + 1) for _, b in pairs]), at),
        }
    )
    n, pick = F.col("n"), F.element_at
    spread = lambda k: n * pick("q", F.col(k)) - pick("s", F.col(k)) * pick("s", F.col(k))
    joint = n * F.col("xy") - pick("s", F.col("i")) * pick("s", F.col("j"))
    norm = F.sqrt(spread("i")) * F.sqrt(spread("j"))
    return rows.select("first", "second", F.when(norm > 0, F.round(joint / norm, 6)).alias("correlation"))


def label_correlation(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Correlation of each candidate with the label."""
    got = _pearson(df, [(c, label) for c in columns])
    return got.select(F.col("first").alias("candidate"), "correlation")


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of every pair of candidates, the earlier one first."""
    return _pearson(df, list(combinations(columns, 2)))


def select_features(importance: DataFrame, correlations: DataFrame) -> DataFrame:
    """(place, candidate, importance, verdict): candidates by falling importance, kept unless weak or redundant.

    A candidate is redundant with the first kept one above it that it correlates with.
    Candidates with none above them are kept, and those next to such a one are not; what
    is left hangs together only through others that are left, and a recursive query settles
    these one by one, so its depth is the length of such chains and not the number of
    candidates. `importance` (column, importance) has a row per candidate column.
    """
    spark = importance.sparkSession
    by_weight = Window.orderBy(F.desc("importance"), F.asc("column"))  # a row per column of a table
    ranked = staged(
        importance.select(
            F.row_number().over(by_weight).alias("place"),
            F.col("column").alias("candidate"),
            F.col("importance").cast("double").alias("importance"),
            (F.col("importance") < WEAK_BELOW).alias("weak"),
        ),
        "ranked",
    )
    strong = ranked.filter("not weak").select("place", "candidate")
    close = correlations.filter(F.abs("correlation") > REDUNDANT_ABOVE)
    one, other = (strong.select(F.col("place").alias(p), F.col("candidate").alias(c)) for p, c in (("p", "first"), ("q", "second")))
    met = close.join(one, "first").join(other, "second")
    above = staged(met.select(F.greatest("p", "q").alias("place"), F.least("p", "q").alias("above")).distinct(), "above")
    free = strong.select("place").join(above.select("place"), "place", "left_anti")
    settled = above.join(free.withColumnRenamed("place", "above"), "above", "left_semi").select("place").distinct()
    open_pairs = above.join(settled, "place", "left_anti")
    step = F.row_number().over(Window.orderBy("place")).alias("step")
    waiting = open_pairs.groupBy("place").agg(F.collect_list("above").alias("above")).select("place", "above", step)
    chosen = spark.sql(
        """
        with recursive walk(step, chosen) max recursion level 1000000 as (
          select 0, cast(array() as array<int>)
          union all
          select w.step + 1,
            case when arrays_overlap(w.chosen, o.above) then w.chosen else array_append(w.chosen, o.place) end
          from walk w join {waiting} o on o.step = w.step + 1)
        select explode(max_by(chosen, step)) as place from walk
        """,
        waiting=staged(waiting, "waiting"),
    )
    kept = staged(free.unionByName(chosen), "kept")
    names = strong.select(F.col("place").alias("above"), F.col("candidate").alias("twin"))
    first = above.join(kept.withColumnRenamed("place", "above"), "above", "left_semi").groupBy("place").agg(F.min("above").alias("above"))
    twins = first.join(names, "above").select("place", "twin")
    verdict = (
        F.when(F.col("weak"), F.lit("weak"))
        .when(F.col("twin").isNotNull(), F.concat(F.lit("redundant with "), F.col("twin")))
        .otherwise(F.lit("kept"))
    )
    return ranked.join(twins, "place", "left").select("place", "candidate", "importance", verdict.alias("verdict"))
