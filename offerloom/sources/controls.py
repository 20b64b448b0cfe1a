"""Control tables: offer catalogue, segment budgets and eligibility rules.

They are edited by people and small by nature. Before any of them becomes part
of a plan its size is checked, so a wrong table fails instead of flooding the
driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from offerloom.sources import versioned
from offerloom.sources.fixtures import BEST_ML, NO_OFFER, OFFER_TYPES

CONTROL_ROWS = 10_000

CATALOG_SCHEMA = "offer_type string, active boolean, base_cost int"
BUDGET_SCHEMA = "segment string, priority int, budget long"
RULE_SCHEMA = "id int, priority int, name string, active boolean, conditions string, action string, action_level int"

# Seed of the control tables.
CATALOG_ROWS = [
    ("cashback", True, 100),
    ("bonus", True, 80),
    ("discount", True, 40),
    ("mission", True, 20),
]
BUDGET_ROWS = [("at_risk", 1, 300000), ("new", 2, 200000), ("active", 3, 200000), ("champion", 4, 60000)]
BUDGET_CUSTOMERS = 12000
# The programme's own rules: every operator, text and number fields, an inactive rule, two bounds on one field.
RULE_ROWS = [
    (11, 10, "cold start", True,
     '[{"field":"score","op":"<","value":0.35},{"field":"segment","op":"=","value":"new"}]', NO_OFFER, 1),
    (12, 20, "top shelf", True,
     '[{"field":"segment","op":"=","value":"champion"},{"field":"score","op":">","value":0.8}]', "bonus", 2),
    (13, 25, "paused trial", False, '[{"field":"score","op":">=","value":0.0}]', "cashback", 3),
    (14, 30, "within reach", True,
     '[{"field":"segment","op":"!=","value":"at_risk"},{"field":"score","op":">=","value":0.65},'
     '{"field":"score","op":"<=","value":0.8}]', BEST_ML, 1),
    (15, 40, "win back", True, '[{"field":"segment","op":"=","value":"at_risk"}]', BEST_ML, 3),
    (16, 50, "first steps", True, '[{"field":"segment","op":"=","value":"new"}]', "mission", 1),
    (17, 90, "everyone else", True, "[]", "discount", 1),
]
ACTIONS = (BEST_ML, *OFFER_TYPES, NO_OFFER)


@dataclass(frozen=True)
class Offer:
    offer_type: str
    active: bool
    base_cost: int


def control_rows(df: DataFrame, limit: int = CONTROL_ROWS) -> list[Row]:
    """Rows of a control table, refused beyond `limit`."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"control table has more than {limit} rows")
    return rows


def catalog_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATALOG_ROWS, CATALOG_SCHEMA)


def catalog_offers(catalog: DataFrame) -> list[Offer]:
    return [Offer(r.offer_type, r.active, r.base_cost) for r in control_rows(catalog)]


def seed_catalog() -> list[Offer]:
    return [Offer(*row) for row in CATALOG_ROWS]


def store_controls(path: str, catalog: DataFrame, budgets: DataFrame, rules: DataFrame) -> None:
    """Write the control tables as next versions; what runs keep reading is the version they opened."""
    for name, table in (("catalog", catalog), ("budgets", budgets), ("rules", rules)):
        versioned.write_version(table, f"{path}/{name}")


def stored(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A stored control table: catalog, budgets or rules."""
    return versioned.read_version(spark, f"{path}/{name}")


def rules_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULE_ROWS, RULE_SCHEMA)


def budgets_table(customer_ids: DataFrame) -> DataFrame:
    """Seed budgets scaled to the number of customers."""
    seed = customer_ids.sparkSession.createDataFrame(BUDGET_ROWS, BUDGET_SCHEMA)
    size = customer_ids.agg(F.count("*").alias("n")).withColumn("seed", F.lit(True))
    scaled = F.floor(F.col("budget") * F.col("n") / BUDGET_CUSTOMERS).cast("long")
    return (
        seed.withColumn("seed", F.lit(True))
        .join(size, "seed")
        .select("segment", "priority", scaled.alias("budget"))
    )


def active_rules(rules: DataFrame) -> DataFrame:
    """Rules in force, in the order they are tried."""
    return rules.filter("active").orderBy("priority", "id")
