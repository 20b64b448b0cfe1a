"""Loyalty-programme views over the star-schema tables.

Customers, redemptions, credit lots, missions and offers are projections of
customer / orders / lineitem; nothing is generated.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.functions.timing import TS_TYPE, days

# The offer types in catalogue order, and "now" for the given tables.
OFFER_TYPES = ("cashback", "bonus", "discount", "mission")
NO_OFFER = "no_offer"
BEST_ML = "best_ml"
NO_RULE = "no_rule"
LEVELS = (1, 2, 3)
AS_OF = "2001-08-02 00:00:00"
CREDIT_VALID_DAYS = 365


class Tables:
    """The named tables of one data folder, read lazily."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._loaded: dict[str, DataFrame] = {}

    def load(self, name: str) -> DataFrame:
        """A scan of one table; its footers are read once."""
        if name not in self._loaded:
            self._loaded[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._loaded[name]

    @cached_property
    def customers(self) -> DataFrame:
        place = (
            self.load("nation")
            .join(self.load("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region"))
        )
        return (
            self.load("customer")
            .join(place, "c_nationkey", "left")
            .select(
                F.col("c_custkey").alias("customer_id"),
                "region",
                F.col("c_mktsegment").alias("market"),
            )
        )

    @cached_property
    def customer_ids(self) -> DataFrame:
        return self.load("customer").select(F.col("c_custkey").alias("customer_id"))

    def _lines(self, flag: str) -> DataFrame:
        lines = self.load("lineitem").filter(F.col("l_returnflag") == flag)
        owners = self.load("orders").select("o_orderkey", "o_custkey")
        return lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
            "customer_id", F.col("o_custkey")
        )

    @cached_property
    def redemptions(self) -> DataFrame:
        return self._lines("R").select(
            "customer_id",
            F.col("l_shipdate").cast(TS_TYPE).alias("ts"),
            (F.col("l_quantity").cast("long") * 10).alias("points"),
            F.col("l_linenumber").cast("string").alias("category"),
            F.col("l_orderkey").alias("order_id"),
        )

    @cached_property
    def credits(self) -> DataFrame:
        start = F.col("l_shipdate").cast(TS_TYPE)
        return self._lines("A").select(
            "customer_id",
            start.alias("credit_ts"),
            (F.col("l_quantity").cast("long") * 10).alias("points"),
            (start + days(CREDIT_VALID_DAYS)).alias("expiry_ts"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line"),
        )

    @cached_property
    def missions(self) -> DataFrame:
        return (
            self._lines("N")
            .filter(F.col("l_linestatus") == "F")
            .select("customer_id", F.col("l_shipdate").cast(TS_TYPE).alias("ts"))
        )

    @cached_property
    def facts(self) -> DataFrame:
        """Redemptions, credits and missions in one table, from one scan of the lines."""
        flag, ts = F.col("l_returnflag"), F.col("l_shipdate").cast(TS_TYPE)
        kind = (
            F.when(flag == "R", "redemption")
            .when(flag == "A", "credit")
            .when((flag == "N") & (F.col("l_linestatus") == "F"), "mission")
        )
        owners = self.load("orders").select("o_orderkey", "o_custkey")
        return (
            self.load("lineitem")
            .withColumn("kind", kind)
            .filter("kind is not null")
            .join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("o_custkey").alias("customer_id"),
                "kind",
                ts.alias("ts"),
                (F.col("l_quantity").cast("long") * 10).alias("points"),
                F.when(flag == "A", ts + days(CREDIT_VALID_DAYS)).alias("expiry_ts"),
                F.when(flag == "R", F.col("l_linenumber").cast("string")).alias("category"),
            )
        )

    @cached_property
    def offers(self) -> DataFrame:
        code = F.substring("o_orderpriority", 1, 1)
        kind = (
            F.when(code == "1", OFFER_TYPES[0])
            .when(code == "2", OFFER_TYPES[1])
            .when(code == "3", OFFER_TYPES[2])
            .otherwise(OFFER_TYPES[3])
        )
        return self.load("orders").select(
            F.col("o_orderkey").alias("offer_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast(TS_TYPE).alias("offer_ts"),
            kind.alias("offer_type"),
            (F.col("o_orderkey") % 3 + 1).cast("int").alias("level"),
        )

    @cached_property
    def events(self) -> DataFrame:
        return self.load("events").select(
            "event_id", "user_id", F.col("ts").cast(TS_TYPE).alias("ts"), "event_type", "value"
        )
