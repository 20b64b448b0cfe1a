"""Versions, their switch, and levelled runs."""

import random

import pytest
from pyspark.sql import functions as F

from offerloom.session import scratch_path
from offerloom.sources import versioned
from offerloom.sources.runs import Runs


def values(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_readers_see_whole_versions(spark):
    path = scratch_path(spark, "versions")
    assert versioned.version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        versioned.read_version(spark, path)
    assert versioned.write_version(spark.range(3), path).rows == 3
    pinned = versioned.read_version(spark, path)
    seen = []
    # what a reader sees while the next version is written but not named yet
    versioned.write_version(spark.range(10, 15), path, check=lambda df: seen.append((values(df), values(versioned.read_version(spark, path)))))
    assert seen == [([10, 11, 12, 13, 14], [0, 1, 2])]
    assert values(pinned) == [0, 1, 2]
    assert values(versioned.read_version(spark, path)) == [10, 11, 12, 13, 14]
    assert values(versioned.read_version(spark, path, 1)) == [0, 1, 2]


def test_a_refused_version_is_never_seen(spark):
    path = scratch_path(spark, "versions")
    versioned.write_version(spark.range(3), path)

    def refuse(df):
        raise ValueError("no")

    before = versioned._names(spark, path)
    with pytest.raises(ValueError, match="no"):
        versioned.write_version(spark.range(9), path, check=refuse)
    assert versioned.version(spark, path).number == 1 and versioned._names(spark, path) == before
    assert values(versioned.read_version(spark, path)) == [0, 1, 2]


def test_of_two_writers_one_fails(spark):
    path = scratch_path(spark, "versions")
    versioned.write_version(spark.range(1), path)
    with pytest.raises(versioned.Conflict):
        versioned.write_version(spark.range(2), path, check=lambda df: versioned.write_version(spark.range(3), path))
    assert values(versioned.read_version(spark, path)) == [0, 1, 2]
    assert versioned.version(spark, path).number == 2


def test_a_broken_write_leaves_the_old_table(spark):
    path = scratch_path(spark, "versions")
    versioned.write_version(spark.range(3), path)
    torn = spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("torn"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="torn"):
        versioned.write_version(torn, path)
    assert values(versioned.read_version(spark, path)) == [0, 1, 2]


def test_old_versions_go(spark, monkeypatch):
    monkeypatch.setattr(versioned, "KEEP", 3)
    path = scratch_path(spark, "versions")
    for n in range(1, 7):
        versioned.write_version(spark.range(n), path)
    assert versioned._numbers(spark, path) == [4, 5, 6]
    assert len([n for n in versioned._names(spark, path) if n.startswith("data-")]) == 3
    assert values(versioned.read_version(spark, path, 4)) == [0, 1, 2, 3]


def _newest(df):
    return df.groupBy("id").agg(F.max("v").alias("v"))


@pytest.fixture
def small_shuffles(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_hundred_batches_stay_few_runs(spark, small_shuffles):
    schema = spark.createDataFrame([(1, 1)], "id long, v long").schema
    runs = Runs(spark, scratch_path(spark, "runs"), schema, _newest, ["id"], fan_out=4)
    rng, want = random.Random(3), {}
    for n in range(100):
        rows = [(rng.randrange(20), rng.randrange(1000)) for _ in range(5)]
        for k, v in rows:
            want[k] = max(v, want.get(k, -1))
        assert runs.append(spark.createDataFrame(rows, schema).coalesce(1), "s", n)
    assert runs.depth() <= 3 * 4  # 100 is below 4 ** 4
    assert {r["id"]: r["v"] for r in runs.read().collect()} == want
    assert not runs.append(spark.createDataFrame([(1, 9999)], schema), "s", 99)
    assert runs.append(spark.createDataFrame([(1, 9999)], schema), "another", 0)
    assert {r["id"]: r["v"] for r in runs.read().collect()} == want | {1: 9999}


def test_a_crash_between_merge_and_switch_loses_nothing(spark, monkeypatch):
    schema = spark.createDataFrame([(1, 1)], "id long, v long").schema
    path = scratch_path(spark, "runs")
    runs = Runs(spark, path, schema, _newest, ["id"], fan_out=2)
    runs.append(spark.createDataFrame([(1, 1)], schema), "s", 0)
    whole, calls = versioned.publish, []

    def crash(spark, path, new):
        calls.append(new)
        if len(calls) == 2:  # the batch is in, the merged run is written, its manifest is not
            raise RuntimeError("lost")
        return whole(spark, path, new)

    monkeypatch.setattr(versioned, "publish", crash)
    with pytest.raises(RuntimeError, match="lost"):
        runs.append(spark.createDataFrame([(1, 5), (2, 2)], schema), "s", 1)
    monkeypatch.setattr(versioned, "publish", whole)
    assert {r["id"]: r["v"] for r in runs.read().collect()} == {1: 5, 2: 2}
    # the batch comes again: known, and the merge is made up for with the next one
    assert not runs.append(spark.createDataFrame([(1, 5), (2, 2)], schema), "s", 1)
    runs.append(spark.createDataFrame([(3, 3)], schema), "s", 2)
    assert {r["id"]: r["v"] for r in runs.read().collect()} == {1: 5, 2: 2, 3: 3} and runs.depth() <= 2
