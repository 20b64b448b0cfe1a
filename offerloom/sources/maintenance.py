"""Writing, updating, comparing and exporting tables."""

from __future__ import annotations

from collections.abc import Sequence

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.operators.pit import duplicate_keys
from offerloom.operators.scan import prefix_scan, ranged
from offerloom.sources import versioned

# Fixed value: rows per insert statement of an export.
EXPORT_BATCH = 2000
FEATURE_MONTH, RUN_DATE, BUCKET = "feature_month", "scored_date", "bucket"
BUCKETS = 64


def save(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Replace a table, schema included, by its next version; the row count is taken while writing."""
    return versioned.write_version(df, path, partition_by=partition_by).rows


def load(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """A table that `save` or `write_feature_table` wrote; what is read stays the version that was opened."""
    return versioned.read_version(spark, path, number)


def write_feature_table(df: DataFrame, path: str, keys: Sequence[str], ts: str | None = None) -> int:
    """Replace a keyed time-series table, by month of `ts`; refuse it if a key occurs twice.

    The rows are checked where they are stored, before the version is named, so readers
    never see a refused table.
    """

    def unique(stored: DataFrame) -> None:
        twice = duplicate_keys(stored.select(*keys), keys).first()[0]
        if twice:
            raise ValueError(f"{twice} keys of {list(keys)} occur more than once")

    if ts is None:
        return versioned.write_version(df, path, unique).rows
    dated = df.withColumn(FEATURE_MONTH, F.date_format(ts, "yyyy-MM"))
    # ranges of time, so a task writes to few folders and a busy month still has many tasks
    return versioned.write_version(dated.repartitionByRange(FEATURE_MONTH, *keys), path, unique, [FEATURE_MONTH]).rows


def append_runs(df: DataFrame, path: str, ts: str) -> None:
    """Append rows by day and instant of `ts`; running an instant again replaces its rows only."""
    spark = df.sparkSession
    run = F.date_format(ts, "yyyyMMddHHmmssSSSSSS")
    (
        df.withColumns({RUN_DATE: F.to_date(ts), "run": run})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(RUN_DATE, "run")
        .parquet(path)
    )
    spark.catalog.refreshByPath(path)


def append_snapshot(df: DataFrame, path: str, ts: str = "scored_at") -> None:
    """Append scored runs to a snapshot table; running one again replaces that run only."""
    append_runs(df, path, ts)


def read_snapshot(spark: SparkSession, path: str, days: Sequence[str] | None = None) -> DataFrame:
    """Stored runs with their `scored_date`; of the folders only those of `days` are read, if given."""
    stored = spark.read.parquet(path).drop("run")
    return stored if days is None else stored.filter(F.col(RUN_DATE).isin(*[date.fromisoformat(d[:10]) for d in days]))


def _digest(columns: Sequence[str], salt: int) -> Column:
    """64 bits of a row; a null differs from any value and from a null elsewhere."""
    parts = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return F.sum(F.xxhash64(F.lit(salt), *parts).cast("decimal(38,0)"))


def bucket_digests(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """{bucket: [rows, two sums of row digests]}: equal for equal rows, whatever their order."""
    sums = df.groupBy(BUCKET).agg(F.count("*").alias("n"), _digest(columns, 1).alias("a"), _digest(columns, 2).alias("b"))
    return {str(r[BUCKET]): [str(r["n"]), str(r["a"]), str(r["b"])] for r in sums.collect()}  # a row a bucket


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> int:
    """Replace a keyed table by its next version, stored by bucket of the key, a digest of each in its manifest.

    Returns the version's number. Versions to be compared need the same number of buckets.
    """
    placed = df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).repartition(BUCKET)
    held: dict = {"buckets": buckets, "keys": list(keys)}

    def digest(stored: DataFrame) -> None:
        held["digests"] = bucket_digests(stored, df.columns)

    return versioned.write_version(placed, path, digest, [BUCKET], held).number


def changed_buckets(spark: SparkSession, path: str, old: int, new: int) -> list[int]:
    """Buckets whose rows differ between two versions, from the manifests alone."""
    left, right = (versioned.version(spark, path, n).info for n in (old, new))
    if (left["buckets"], left["keys"]) != (right["buckets"], right["keys"]):
        raise ValueError("the versions are bucketed in different ways")
    a, b = left["digests"], right["digests"]
    return sorted(int(k) for k in {*a, *b} if a.get(k) != b.get(k))


def versioned_change_feed(spark: SparkSession, path: str, old: int, new: int, keys: Sequence[str]) -> DataFrame:
    """`change_feed` of two versions that `write_bucketed` wrote; equal buckets are neither read nor shuffled."""
    differ = F.col(BUCKET).isin(*changed_buckets(spark, path, old, new))
    before, after = (load(spark, path, n).filter(differ).drop(BUCKET) for n in (old, new))
    return change_feed(before, after, keys)


def _sides(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Both rows of each key as structs `l` and `r`, NULL where a side has none."""
    pack = lambda df, name: df.select(*keys, F.struct(*df.columns).alias(name))
    return pack(left, "l").join(pack(right, "r"), list(keys), how)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert rows with new keys, replace rows with known ones. Keys are unique on each side."""
    both = _sides(target, updates.select(*target.columns), keys, "full_outer")
    return both.select(F.coalesce("r", "l").alias("row")).select("row.*")


def update_by_key(target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Set some columns of known keys, to NULL too; unknown keys are ignored."""
    new = updates.select(*keys, F.struct(*columns).alias("new"))

    def value(c: str) -> Column:
        if c not in columns:
            return F.col(c)
        return F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(c)).alias(c)

    return target.join(new, list(keys), "left").select(*[value(c) for c in target.columns])


def replace_table(df: DataFrame, order: Sequence[Column], ident: str = "id") -> DataFrame:
    """All rows with new ids 1..n in the given unique order, numbered in parallel."""
    laid = ranged(df.drop(ident), order, "renumbered").withColumn("one", F.lit(1).cast("long"))
    return prefix_scan(laid, [], ["block"], order, {ident: ("sum", "one")}).drop("one", "block")


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row-level changes between two versions: insert, delete, and both images of an update."""
    both = _sides(old, new.select(*old.columns), keys, "full_outer").filter(~F.col("l").eqNullSafe(F.col("r")))
    row = lambda kind, side: F.struct(F.lit(kind).alias("change"), F.col(side).alias("row"))
    images = (
        F.when(F.col("l").isNull(), F.array(row("insert", "r")))
        .when(F.col("r").isNull(), F.array(row("delete", "l")))
        .otherwise(F.array(row("update_preimage", "l"), row("update_postimage", "r")))
    )
    return both.select(F.explode(images).alias("c")).select("c.change", "c.row.*")


def audit(feed: DataFrame, user: str, action: str, at: str) -> DataFrame:
    """One audit row per kind of change, with the count as JSON detail and the given instant."""
    return (
        feed.groupBy("change")
        .agg(F.count("*").alias("n"))
        .select(
            F.lit(user).alias("user"),
            F.lit(action).alias("action"),
            F.to_json(F.struct("change", "n")).alias("detail"),
            F.lit(at).cast("timestamp_ntz").alias("audited_at"),
        )
    )


def append_audit(rows: DataFrame, path: str) -> None:
    """Append audit rows; an instant that is written again replaces its rows, so a retry adds nothing."""
    append_runs(rows, path, "audited_at")


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(RUN_DATE, "run")


def export_customers(customer_scores: DataFrame) -> DataFrame:
    """The typed projection of the customer base that is exported."""
    return customer_scores.select(
        "customer_id",
        "segment",
        "score_max",
        F.col("redemptions_60d").cast("int").alias("redemptions_60d"),
        F.col("recency_today").cast("int").alias("recency_today"),
        F.col("redemptions_total").cast("int").alias("redemptions_total"),
        F.col("points_accumulated").cast("long").alias("points_accumulated"),
    )


def export_scores(scored: DataFrame) -> DataFrame:
    return scored.select("customer_id", "offer_type", "level", "p_accept")


def export_jdbc(df: DataFrame, url: str, table: str, options: dict[str, str] | None = None) -> None:
    """Bulk export from the executors, one connection per partition.

    An index on the exported key is left to the database.
    """
    writer = df.write.format("jdbc").mode("overwrite")
    writer.options(url=url, dbtable=table, batchsize=str(EXPORT_BATCH), **(options or {})).save()


def reconcile(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Row counts of two tables in one row."""
    count = lambda df, name: df.agg(F.count("*").alias(name)).withColumn("one", F.lit(1))
    return count(left, left_name).join(count(right, right_name), "one").drop("one")


def step_counts(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Write each step's table under `path`; the row counts are those seen by the writers."""
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame([(name, save(df, f"{path}/{name}")) for name, df in tables.items()], "step string, n long")
