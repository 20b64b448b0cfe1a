"""Phrase collocations against counting in plain Python."""

import random
import re
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_operators import docs, hard, none  # noqa: F401

from offerloom.llm import phrases

TEXT = "lang string, text string"


def plain_collocations(rows, least=10, share=50, first=2000):
    """{(lang, phrase): (rank, a, l, r, n, score)}."""
    counts: dict = {}
    for lang, text in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", brute.lower(text)):
            words = re.findall("[^ \t]+", piece)
            for size in (1, 2, 3):
                own.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = {}
    for lang, own in counts.items():
        total = sum(n for p, n in own.items() if len(p) == 1)
        large = {p: n for p, n in own.items() if len(p) > 1 and n >= least}
        inside = {
            q for p, n in large.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * n >= share * own[q]
        }
        scored = []
        for p, a in large.items():
            if p not in inside:
                cuts = [(10**6 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:first], 1):
            out[lang, phrase.decode()] = (rank, -a, left, right, total, -score)
    return out


def got(frame, **options):
    return {(r["lang"], r["phrase"]): tuple(r[c] for c in ("rank", "a", "l", "r", "n", "score")) for r in phrases.collocations(frame, **options).collect()}


@pytest.fixture(scope="module")
def random_rows():
    rng = random.Random(2)
    rows = []
    for _ in range(300):
        words = rng.choices(["a", "B", "c", "dé", "e\x00f", "g-h", "of", "the"], weights=[9, 8, 3, 2, 1, 1, 9, 9], k=rng.randint(0, 80))
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for w in words)
        rows.append((rng.choice([None, "en", "und", "x\ny", ""]), text))
    return [*rows, ("en", None), (None, None), ("en", ""), ("only null", None), ("en", "the of the " * 3000)]


def test_equals_plain_counting(spark, random_rows):
    frame = spark.createDataFrame(random_rows, TEXT)
    want = plain_collocations(random_rows)
    assert len(want) > 50 and got(frame) == want
    assert got(frame, least=3, share=80, first=7) == plain_collocations(random_rows, 3, 80, 7)


def test_ranges_that_cut_groups(spark, random_rows, monkeypatch):
    """Many more ranges than words, so most ranges begin amid a group."""
    frame = spark.createDataFrame(random_rows, TEXT)
    want = plain_collocations(random_rows, 2)
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert got(frame, least=2) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def walked(rows, ends):
    """`_walk` over a range that comes in batches cut at `ends`."""
    table = pa.table({c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(zip([*phrases.KEYS, "f"], [pa.string()] * 4 + [pa.int64()]))})
    parts = [table.slice(i, j - i).combine_chunks().to_batches() for i, j in zip([0, *ends], [*ends, len(rows)])]
    return [r for batch in phrases._walk(iter([b for p in parts for b in p])) for r in batch.to_pylist()]


def test_batches_do_not_matter():
    rng = random.Random(8)
    keys = sorted({tuple(rng.choices("abcd", k=rng.randint(1, 3))) for _ in range(60)})
    keys = sorted({k[:n] for k in keys for n in range(1, len(k) + 1)})
    rows = [("en", *[*k, None, None][:3], rng.randint(1, 99)) for k in keys]
    order = lambda r: tuple(str(r[c]) for c in (*phrases.KEYS, "kind"))
    for start in (0, 3, 7, 11):
        want = sorted(walked(rows[start:], []), key=order)
        for _ in range(20):
            ends = sorted(rng.sample(range(1, len(rows) - start), 6))
            assert sorted(walked(rows[start:], ends), key=order) == want


def test_a_full_bitmap_changes_nothing(spark, random_rows, monkeypatch):
    """Bits of other phrases let more rows through, not other results."""
    monkeypatch.setattr(phrases, "_bitmap", lambda frequent: b"\xff" * (1 << (phrases.BITMAP_BITS - 3)))
    assert got(spark.createDataFrame(random_rows, TEXT)) == plain_collocations(random_rows)


def test_bits_are_those_of_the_frequent(spark):
    rows = [("en", "a"), ("en", "b c"), ("de", "a"), ("x\ny", "é ü")]
    bits = np.frombuffer(phrases._bitmap(spark.createDataFrame([r for r in rows if " " in r[1]], "lang string, phrase string")), np.uint8)
    assert int(np.unpackbits(bits).sum()) == 2
    words = [phrases._hashes(pa.array([w])) for w in ("b", "c")]
    assert phrases._set(bits, phrases._slots(words, "en")).all() and not phrases._set(bits, phrases._slots(words, "de")).any()


def test_scores_beyond_64_bits(spark):
    a = 10**13
    row = spark.createDataFrame([(a, 3 * a, 7 * a)], "a bigint, l bigint, r bigint").select(phrases._score("l", "r").alias("s")).first()
    assert row["s"] == 10**6 * a * a // (21 * a * a)


def test_edges(spark, hard, none):  # noqa: F811
    assert phrases.collocations(none).count() == 0
    frame = hard.withColumn("f", F.lit(1)).withColumn("key", F.lit("k")).withColumn("n", F.lit(2))
    rows = [(r["lang"], r["text"]) for r in hard.collect()]
    assert got(frame) == plain_collocations(rows)
