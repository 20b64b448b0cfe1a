"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", memory: str = "8g", app: str = "offerloom") -> SparkSession:
    """A session for tests and the local benchmark; a cluster brings its own settings."""
    partitions = "8" if cpus == "*" else str(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.files.minPartitionNum", partitions)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in `spark.checkpoint.dir`.

    Only a local session may fall back to a folder of its own: on a cluster a
    machine-local path would lose its blocks with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="offerloom-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and read it back.

    Used where a plan reads the same costly input more than once: the input is
    computed a single time, lineage ends at a file that outlives any executor,
    and the readers still prune columns. What the write has shuffled is removed at
    its end, as nothing reads it again, and not when the driver collects garbage.
    """
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)
    held = df.sparkSession.read.schema(df.schema).parquet(path)
    held.staged_at = (path,)
    return held


def given_up(*tables: DataFrame) -> None:
    """Remove tables that `staged` has written, once all that reads them is written too."""
    for held in tables:
        for path in held.staged_at:
            removed(held.sparkSession, path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete what is at a path that Spark can reach."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
