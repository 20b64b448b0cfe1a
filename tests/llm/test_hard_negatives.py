"""Hard negatives against scoring all rows in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerloom.llm import hard_negatives
from offerloom.llm.hard_negatives import Bucket, _bucketed

TABLE = "vec_id bigint, embedding array<float>, label int"


def plain(rows, step=10, first=5, low=80, high=100):
    own = []
    for key, vector, label in rows:
        if key is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        own.append((key, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for key, label, vector in own:
        if key % step:
            continue
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), k, m == label) for k, m, v in own if k != key)
        for s, k, _ in [x for x in scored if x[2]][:first]:
            fit = [x for x in scored if not x[2] and low * -s <= 100 * -x[0] <= high * -s][:first]
            out += [(key, k, rank, x[1], -s, -x[0]) for rank, x in enumerate(fit, 1)]
    return sorted(out)


def found(spark, rows, step=10, **options):
    frame = spark.createDataFrame(rows, TABLE)
    return sorted(map(tuple, hard_negatives.hard_negatives(frame, F.col("vec_id") % step == 0, **options).collect()))


def random_rows(seed, n, dims, lengths=False):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    rows = []
    for k in range(n):
        label = rng.randrange(5)
        near = centres[rng.randrange(5)] if rng.random() < 0.3 else centres[label]
        size = rng.choice([0, 0.01, 1, 1, 3]) if lengths else 0.3
        rows.append((k, [size * (x + rng.gauss(0, 0.4)) for x in near], label))
    return rows


@pytest.mark.parametrize("lengths", [False, True])
def test_equals_plain(spark, lengths, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BUCKET_ROWS", 40)
    rows = random_rows(4, 400, 8, lengths)
    want = plain(rows)
    assert len(want) > 200 and found(spark, rows) == want
    assert found(spark, rows, first=2, low=50, focus=6) == plain(rows, first=2, low=50)


def test_ties_copies_and_hot_label(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BUCKET_ROWS", 16)
    same = [0.5, 0.25, -0.5]
    rows = [(k, same, 1 if k % 3 else 2) for k in range(200)] + random_rows(6, 100, 3)
    rows = [(k, v, m) for k, (_, v, m) in enumerate(rows)]
    assert found(spark, rows) == plain(rows)


def test_rows_that_take_no_part_and_odd_lengths(spark):
    rows = random_rows(9, 60, 4)
    rows += [(60, None, 1), (70, [1.0, None], 1), (80, [float("nan"), 1.0], 1), (90, [float("inf")], 2), (100, [1.0, 1.0], None), (None, [1.0], 1)]
    rows += [(110, [], 1), (120, [0.5], 1), (130, [0.0] * 9, 2), (140, [0.1] * 9, 2)]
    assert found(spark, rows) == plain(rows)


def test_numbers_beyond_doubles(spark):
    rows = [(k, [(-1.0) ** k * 1e9 * (k + 1), 3.3e9, 1.0], k % 2) for k in range(40)]
    assert found(spark, rows) == plain(rows)
    # beyond 10^31 all scores count as equal and go by id
    large = [(k, [3e38, 1.0 * k], k % 2) for k in range(12)]
    got = found(spark, large)
    assert [r[:4] for r in got if r[0] == 0 and r[1] == 2] == [(0, 2, k, 2 * k - 1) for k in range(1, 6)]
    assert {r[4:] for r in got} == {(2**63 - 1, 2**63 - 1)}


def test_repeated_rows_and_extra_columns(spark):
    rows = random_rows(12, 50, 4)
    twice = [*rows, *rows[:3]]
    frame = spark.createDataFrame(twice, TABLE)
    extra = frame.select("*", *[F.lit(1).alias(c) for c in "anchor home wants bucket tag rank score block slot length vector".split()])
    got = hard_negatives.hard_negatives(extra, F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    # the repeated anchor 0 comes once and does not meet itself; rows 1 and 2 come as often as they are there
    want = plain([*rows, *rows[1:3]])
    assert [r for r in sorted(map(tuple, got.collect())) if r[0] == 0] == [r for r in want if r[0] == 0]


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(5, [1.0], 1)]) == []
    assert found(spark, [(10, [1.0], 1)]) == []


def test_pruning_keeps_all_and_prunes(spark):
    """Candidates hold every row that reaches the score, and are fewer than all for high ones."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    vectors = np.floor(256 * rng.normal(size=(500, 6)) * rng.choice([0.1, 0.5, 1], 500)[:, None])
    lengths = np.sqrt((vectors**2).sum(axis=1))
    order = np.argsort(-lengths)
    batch = pa.record_batch(
        [pa.array(order), pa.array(order % 3), pa.array(vectors[order].tolist(), pa.list_(pa.float64())), pa.array([0] * 500)],
        ["vec_id", "label", "vector", "part"],
    )
    hard_negatives.BUCKET_ROWS, kept = 100, hard_negatives.BUCKET_ROWS
    try:
        made = [Bucket(r) for b in _bucketed(iter([batch.slice(0, 130), batch.slice(130)])) for r in b.to_pylist()]
    finally:
        hard_negatives.BUCKET_ROWS = kept
    assert [len(b.ids) for b in made] == [100] * 5
    few = 0
    for q in vectors[:40]:
        unit, length = hard_negatives._unit(q[None, :])
        for bucket in made:
            scores = bucket.vectors @ q
            for least in (*np.quantile(scores, [0.5, 0.9, 0.99, 1]), -5.0, 0.0):
                rows = bucket.candidates(unit[0], float(length[0]), float(least), 3)
                if rows is None:
                    continue
                assert set(np.flatnonzero(scores >= least)) <= set(rows.tolist())
                few += len(rows) < 100
    assert few > 50
