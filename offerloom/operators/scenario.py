"""Two rule and budget scenarios side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.operators.budget import apply_budget
from offerloom.operators.rules import compile_rules, resolve_action
from offerloom.sources.controls import Offer, active_rules, control_rows
from offerloom.sources.fixtures import NO_OFFER

CURRENT, PROPOSED = "current", "proposed"


def override_budgets(budgets: DataFrame, overrides: Mapping[str, int]) -> DataFrame:
    """Budgets with some segments set anew."""
    value = F.col("budget")
    for segment, amount in overrides.items():
        value = F.when(F.col("segment") == segment, F.lit(int(amount)).cast("long")).otherwise(value)
    return budgets.withColumn("budget", value)


def decide_scenarios(
    customers: DataFrame,
    catalog: Sequence[Offer],
    rules: Mapping[str, DataFrame],
    budgets: Mapping[str, DataFrame],
) -> DataFrame:
    """Final offers under every scenario, in one job over customers with candidates."""
    tagged = customers.withColumn("scenario", F.explode(F.array(*[F.lit(s) for s in rules])))
    won = None
    for name, table in rules.items():
        compiled = compile_rules(control_rows(active_rules(table)))
        won = (F if won is None else won).when(F.col("scenario") == name, compiled)
    matched = tagged.withColumn("won", won).select(*tagged.columns, "won.*")
    decisions = resolve_action(matched, catalog, keys=("scenario", "customer_id"))
    limits = None
    for name, table in budgets.items():
        part = table.select(F.lit(name).alias("scenario"), "segment", "budget")
        limits = part if limits is None else limits.unionByName(part)
    return apply_budget(decisions, limits, scenario=("scenario",))


def scenario_kpis(decisions: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Reach, cost and expected acceptances; rounding is half-even.

    Probabilities are summed as decimals, so the figures do not depend on the
    order in which partitions arrive.
    """
    served = F.col("final_offer") != NO_OFFER
    n, hit = F.count("*"), F.count_if(served)
    p_sum = F.coalesce(F.sum(F.when(served, F.col("p_accept").cast("decimal(10,6)"))).cast("double"), F.lit(0.0))
    return decisions.groupBy(*group).agg(
        n.alias("customers"),
        hit.alias("served"),
        F.bround(100 * hit / F.greatest(n, F.lit(1)), 1).alias("coverage_pct"),
        F.coalesce(F.sum(F.when(served, F.col("cost").cast("long"))), F.lit(0)).alias("points_spent"),
        F.when(hit > 0, F.bround(p_sum / hit, 3)).otherwise(0.0).alias("mean_p"),
        F.bround(p_sum, 0).cast("long").alias("expected_acceptances"),
    )


def scenario_delta(kpis: DataFrame, base: str = CURRENT, other: str = PROPOSED) -> DataFrame:
    """Differences of the figures, coverage in percentage points."""

    def of(name: str, column: str) -> Column:
        return F.max(F.when(F.col("scenario") == name, F.col(column)))

    figures = ("served", "coverage_pct", "points_spent", "expected_acceptances")
    diff = lambda c: of(other, c) - of(base, c)
    return kpis.agg(
        *[
            (F.bround(diff(c), 1) if c == "coverage_pct" else diff(c)).alias(f"{c}_delta")
            for c in figures
        ]
    )


def compare_distribution(decisions: DataFrame, base: str = CURRENT, other: str = PROPOSED) -> DataFrame:
    """Final offers counted under both scenarios; an offer missing in one counts 0 there."""
    return decisions.groupBy("final_offer").agg(
        F.count_if(F.col("scenario") == base).alias(base),
        F.count_if(F.col("scenario") == other).alias(other),
    )
