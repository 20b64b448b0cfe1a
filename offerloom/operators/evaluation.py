"""Splits, exact AUC, accuracy and permutation importance."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.functions.scalars import unit_block
from offerloom.operators.scan import BLOCK, prefix_scan, ranged
from offerloom.session import given_up, staged

NO_COLUMN = "(none)"


def _hash_block(digest: str) -> Column:
    """4,096 equal, order-preserving blocks of an md5 text."""
    return F.conv(F.substring(digest, 1, 3), 16, 10).cast("long")


def stratified_split(df: DataFrame, key: str, label: str, test_share: float = 0.25) -> DataFrame:
    """Mark the first `ceil(share * n)` rows of each label, by md5 of the key, as test.

    The share of every label is exact, and the split does not depend on the
    partitioning. The label's size rides on the totals of its blocks. `df` is read several times: stage it when it is costly.
    """
    marked = df.withColumn("mark", F.md5(F.col(key).cast("string"))).withColumns(
        {"hash_block": _hash_block("mark"), "one": F.lit(1).cast("long")}
    )
    placed = prefix_scan(
        marked, [label], ["hash_block"], ["mark", key], {"position": ("sum", "one")}, totals={"stratum": "one"}
    )
    test = F.col("position") <= F.ceil(F.col("stratum") * test_share)
    return placed.withColumn("is_test", test).select(*df.columns, "is_test")


def score_counts(df: DataFrame, score: str, label: str, group: Sequence[str] = ()) -> DataFrame:
    """(group, score, pos, neg): rows shrunk to distinct scores (at most a million for probabilities of six decimals)."""
    return df.groupBy(*group, F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum(1 - F.col(label).cast("long")).alias("neg")
    )


def auc(df: DataFrame, score: str, label: str, group: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties counting half, per group."""
    return auc_of_counts(score_counts(df, score, label, group), group)


def auc_of_counts(counts: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """`auc` from `score_counts`: each score adds its positives times the negatives below. Stage costly counts, they are read twice."""
    below = prefix_scan(
        counts.withColumn("score_block", unit_block(F.col("score"), 4096)),
        [*group],
        ["score_block"],
        ["score"],
        {"pos_below": ("sum", "pos"), "neg_below": ("sum", "neg")},
        inclusive=False,
    )
    wide = lambda c: c.cast("decimal(19,0)")
    pairs = F.sum(wide(F.col("pos")) * wide(2 * F.col("neg_below") + F.col("neg"))).cast("double")
    all_pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    value = F.when(all_pairs > 0, F.round(pairs / (2 * all_pairs), 6))
    return below.groupBy(*group).agg(value.alias("auc"), F.sum(F.col("pos") + F.col("neg")).alias("n"))


def accuracy(df: DataFrame, score: str, label: str, group: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    """Share of rows whose score falls on the label's side of the threshold."""
    hit = (F.col(score) >= threshold).cast("int") == F.col(label)
    return df.groupBy(*group).agg(
        F.round(F.count_if(hit) / F.count("*"), 6).alias("accuracy"), F.count("*").alias("n")
    )


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every 64-bit number."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def deals(columns: Sequence[str], repeats: int) -> list[tuple[str, int, int, int]]:
    """(column, repeat, multiplier, shift) of each dealing out.

    Multipliers are the primes above 2^61, one each: no table has so many rows, so each has
    no factor in common with the number of rows, and position -> multiplier * position +
    shift, modulo that number, meets every row once.
    """
    out, prime = [], 2**61 + 1
    for column in columns:
        for repeat in range(1, repeats + 1):
            while not _is_prime(prime):
                prime += 2
            shift = int(hashlib.md5(f"{repeat}:{column}".encode()).hexdigest()[:8], 16)
            out.append((column, repeat, prime, shift))
            prime += 2
    return out


def permutation_importance(
    test: DataFrame,
    key: str,
    columns: Sequence[str],
    score: Column | Callable[[DataFrame], DataFrame],
    label: str,
    repeats: int = 5,
) -> DataFrame:
    """Mean loss of AUC when one column's values are dealt out anew.

    Row number i by `key` receives the column's value from row number i by
    md5(key:repeat:column), so each of the `repeats` deals of a column is a shuffle of its
    own. Decks go by a number; their marks travel as 16 bytes, and the values of all decks
    meet their rows in one exchange, a bounded number for each row. `score` is a column, or
    a function that adds a column `p`, such as a fitted model.
    """
    kept = test.withColumns({c: F.col(c).cast("double") for c in columns})
    laid = ranged(kept, [F.col(key)], "test-rows")
    placed = prefix_scan(laid.withColumn("_one", F.lit(1).cast("long")), [], ["block"], [key], {"_place": ("sum", "_one")}).drop("_one", "block")
    base = staged(placed, "placed-rows")
    given_up(laid)
    decks = [(c, r) for c in columns for r in range(1, repeats + 1)]
    column_of, repeat_of = F.array(*[F.lit(c) for c, _ in decks]), F.array(*[F.lit(r) for _, r in decks])
    entries = F.array(
        *[F.struct(F.lit(k).alias("deck"), F.lit(f":{r}:{c}").alias("suffix"), F.col(c).alias("dealt")) for k, (c, r) in enumerate(decks)]
    )
    deck = base.select(F.col(key).alias("_key"), F.inline(entries))
    deck = deck.withColumn("mark", F.md5(F.concat(F.col("_key").cast("string"), "suffix"))).select(
        "deck",
        "_key",
        "dealt",
        F.unhex("mark").alias("mark"),
        F.lit(1).cast("long").alias("_one"),
        F.struct("deck", _hash_block("mark").alias("hash_block")).alias(BLOCK),
    )
    ranked = prefix_scan(deck, ["deck"], ["hash_block"], ["mark", "_key"], {"_to": ("sum", "_one")})
    dealt = ranked.groupBy("_to").agg(F.collect_list(F.struct("deck", "dealt")).alias("_hand"))
    met = base.join(dealt, F.col("_place") == F.col("_to")).withColumn("_dealt", F.explode("_hand")).select("*", "_dealt.*")
    of = {c: F.col("deck").between(n * repeats, (n + 1) * repeats - 1) for n, c in enumerate(columns)}
    swapped = met.withColumns({c: F.when(of[c], F.col("dealt")).otherwise(F.col(c)) for c in columns})
    untouched = base.withColumn("deck", F.lit(-1))

    def scored(frame: DataFrame) -> DataFrame:
        if isinstance(score, Column):
            return frame.select("deck", label, score.alias("p"))
        return score(frame.drop("_hand", "_dealt")).select("deck", label, "p")

    # the deals are planned and run once; both passes over their scores read a file
    counts = staged(score_counts(scored(untouched).unionByName(scored(swapped)), "p", label, ["deck"]), "deck-scores")
    given_up(base)
    per_deck = auc_of_counts(counts, ["deck"])
    # a row per deck from here on
    own = F.col("deck") >= 0
    per_run = per_deck.select(
        F.when(own, F.get(column_of, "deck")).otherwise(F.lit(NO_COLUMN)).alias("column"),
        F.when(own, F.get(repeat_of, "deck")).otherwise(F.lit(0)).alias("repeat"),
        "auc",
    )
    means = per_run.groupBy("column").agg(F.avg("auc").alias("mean_auc"))
    baseline = F.max(F.when(F.col("column") == NO_COLUMN, F.col("mean_auc"))).over(Window.partitionBy())
    return (
        means.withColumn("importance", F.round(baseline - F.col("mean_auc"), 6))
        .filter(F.col("column") != NO_COLUMN)
        .select("column", "importance")
    )


def evaluate(df: DataFrame, score: str, label: str, group: Sequence[str]) -> DataFrame:
    """AUC and accuracy per group; `df` is staged because both read it."""
    held = staged(df.select(*group, score, label), "scored-rows")
    hits = accuracy(held, score, label, group).drop("n")
    return auc(held, score, label, group).join(hits, list(group))
