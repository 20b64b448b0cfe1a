"""MinHash near-dedup with an LSH forest.

Sketch: each text's set of word shingles becomes `ORDERS * DEPTH` min-hashes. Texts
with the same set are one class from here on, so copies cost nothing more.

Forest: an order starts its signature at its own `DEPTH` values and goes on through
the others. Classes whose first `DEPTH` values are shared by no one drop out of the
order; the rest are sorted by the whole signature, by ranges, so a crowded region is
spread over tasks like any other. A class's candidates are its next `NEIGHBOURS` in
the sorted order with the same first `DEPTH` values: where few classes agree they are
all of those, where many do they are the ones with the longest common prefix, so the
depth adapts to the region. A pair with similarity 0.8 and no others around is missed
by all orders with probability 3e-6. Classes with the same first values stay in one
range unless they are a crowd, so no range's end hides a pair.

Crowds: classes that share their first values with more others than `NEIGHBOURS` have
pairs that no order puts side by side. These are found without any cap: sets as alike
as the threshold share one of their rarest shingles, so the rare shingles of crowded
classes are joined, between classes that no link connects so far: a shingle whose
classes are all connected makes no pair, however many they are.

Links: a pair goes on if its sizes allow the threshold and its share of equal
min-hashes is at most five standard deviations below it. Then the full sets are
compared, in two rounds: each class's most promising pair first, and after that
every other pair that components do not join already.

Defined results: null and empty texts, and texts without words, have an empty set
and are linked with nothing; a text of fewer words than a shingle is one shingle;
rows that repeat an id are one document, with the links of all their texts; a null
id is linked with nothing and has a null component; only doc_id and text are read;
ids are whole numbers of any type, and others raise an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerloom.llm.components import components
from offerloom.llm.frames import map_arrow
from offerloom.llm.words import NON_SPACE, distinct_sets, mix, shingles, slices, texts_of, words_of
from offerloom.session import staged

ORDERS, DEPTH = 24, 4
VALUES = ORDERS * DEPTH
NEIGHBOURS = 6
PERCENT = 80
BINS = 1 << 20  # of the table that says which shingles are rare; fewer only make it blunter
_RNG = np.random.Generator(np.random.PCG64(77))
_FLIP = _RNG.integers(0, 2**32, VALUES, dtype=np.uint32)
_SPREAD = _RNG.integers(0, 2**32, VALUES, dtype=np.uint32) | np.uint32(1)


def text_sets(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, last, hashes, first per text) of the sets of some texts, slice by slice."""
    raw, offsets = texts_of(column)
    for a, b in slices(offsets):
        words = words_of(raw[offsets[a] : offsets[b]], offsets[a : b + 1], NON_SPACE)
        yield a, b, *distinct_sets(*shingles(words, size))


def min_hashes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, VALUES) min-hashes; zeros for empty sets."""
    sizes = np.diff(first)
    some = np.flatnonzero(sizes)
    out = np.zeros((len(sizes), VALUES), np.uint32)
    if len(some):
        half = (hashes >> np.uint64(32)).astype(np.uint32)
        for k in range(VALUES):
            out[some, k] = np.minimum.reduceat((half ^ _FLIP[k]) * _SPREAD[k], first[some])
    return out


def contents(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """16 bytes that stand for each set: two sums over its members."""
    out = np.zeros((len(first) - 1, 2), np.uint64)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        out[some, 0] = np.add.reduceat(hashes, first[some])
        out[some, 1] = np.add.reduceat(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), first[some])
    return out


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, content, marks, prefixes) of each document.

    `marks` has the low byte of each min-hash; `prefixes` a hash of the first
    `DEPTH` whole values of each order, which tells the orders apart too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, hashes, first in text_sets(batch.column(1), size):
                values = min_hashes(hashes, first)
                begin = values.reshape(b - a, ORDERS, DEPTH).astype(np.uint64)
                prefix = np.zeros((b - a, ORDERS), np.uint64) + np.arange(1, ORDERS + 1, dtype=np.uint64)
                for k in range(DEPTH):
                    prefix = mix(prefix * np.uint64(0x9E3779B97F4A7C15) + begin[:, :, k])
                ends = pa.array(np.arange(b - a + 1) * ORDERS, pa.int32())
                yield pa.record_batch(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array([x.tobytes() for x in contents(hashes, first)], pa.binary()),
                        pa.array([x.tobytes() for x in values.astype(np.uint8)], pa.binary()),
                        pa.ListArray.from_arrays(ends, pa.array(prefix.ravel().view(np.int64))),
                    ],
                    ["doc_id", "n_shingles", "content", "marks", "prefixes"],
                )

    schema = "doc_id bigint, n_shingles bigint, content binary, marks binary, prefixes array<bigint>"
    return map_arrow(docs.select("doc_id", F.col("text").cast("string").alias("text")), run, schema)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of equally long binary values as a matrix of bytes."""
    parts = []
    for chunk in column.chunks:
        offsets = np.frombuffer(chunk.buffers()[1], np.int32)
        raw = np.frombuffer(chunk.buffers()[2], np.uint8)
        at = offsets[chunk.offset]
        parts.append(raw[at : at + len(chunk) * width].reshape(-1, width))
    return np.concatenate(parts)


def _neighbour_pairs(batches: Iterator[pa.RecordBatch], percent: int, neighbours: int) -> Iterator[pa.RecordBatch]:
    """Pairs of near rows of one sorted range, whose sizes and marks allow the threshold."""
    share = percent / 100
    least = share - 5 * (share * (1 - share) / VALUES) ** 0.5
    carry = None
    for batch in batches:
        table, old = pa.Table.from_batches([batch]), 0
        if carry is not None:
            table, old = pa.concat_tables([carry, table]), len(carry)
        n = len(table)
        ids, sizes, prefix = (table[c].to_numpy() for c in ("id", "n_shingles", "prefix"))
        marks = _matrix(table["signature"], VALUES)
        for step in range(1, neighbours + 1):
            at = np.arange(max(0, old - step), n - step)  # pairs that end in this batch
            at = at[(prefix[at] == prefix[at + step]) & (ids[at] != ids[at + step])]
            small, large = np.minimum(sizes[at], sizes[at + step]), np.maximum(sizes[at], sizes[at + step])
            at = at[100 * small >= percent * large]
            same = (marks[at] == marks[at + step]).mean(axis=1)
            at, same = at[same >= least], same[same >= least]
            a, b = ids[at], ids[at + step]
            yield pa.record_batch(
                [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(same, pa.float32())],
                ["a", "b", "share"],
            )
        carry = table.slice(max(0, n - neighbours))


def _keys(classes: DataFrame) -> DataFrame:
    return classes.select("id", F.posexplode("prefixes").alias("order", "prefix"))


def shared_prefixes(classes: DataFrame) -> DataFrame:
    """(prefix, count): the beginnings that several classes have."""
    return staged(_keys(classes).groupBy("prefix").count().filter("count > 1"), "prefixes")


def crowded(classes: DataFrame, shared: DataFrame, neighbours: int = NEIGHBOURS) -> DataFrame:
    """(id): the classes with more partners in some order than are compared there."""
    full = shared.filter(F.col("count") > neighbours + 1).select("prefix")
    return _keys(classes).join(full, "prefix", "left_semi").select("id").distinct()


def candidates(
    classes: DataFrame, shared: DataFrame, percent: int = PERCENT, neighbours: int = NEIGHBOURS
) -> DataFrame:
    """(a, b, share): distinct pairs of neighbours in the orders of the forest, a < b.

    `classes` is a written table (id, n_shingles, marks, prefixes) of distinct sets.
    """
    # ids that are alone in an order go before anything wide moves
    kept = _keys(classes).join(shared, "prefix")
    turned = F.concat(
        F.expr(f"substring(marks, order * {DEPTH} + 1)"), F.expr(f"substring(marks, 1, order * {DEPTH})")
    ).alias("signature")
    rows = kept.join(classes.select("id", "n_shingles", "marks"), "id")
    rows = staged(rows.select("prefix", turned, "id", "n_shingles", "count"), "orders")
    # only crowds are cut between ranges; what a cut hides there, `passed_over` finds
    crowd = F.col("count") > neighbours + 1
    laid = rows.repartitionByRange("prefix", F.when(crowd, F.col("signature")), F.when(crowd, F.col("id")))
    laid = laid.sortWithinPartitions("prefix", "signature", "id").drop("count")
    found = map_arrow(
        laid, lambda batches: _neighbour_pairs(batches, percent, neighbours), "a bigint, b bigint, share float"
    )
    return found.groupBy("a", "b").agg(F.max("share").alias("share"))


def rarity(texts: DataFrame, size: int) -> np.ndarray:
    """How many sets of (id, text) have a shingle of each of `BINS` bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            for _, _, hashes, _ in text_sets(batch.column(1), size):
                total += np.bincount((hashes % np.uint64(BINS)).astype(np.int64), minlength=BINS)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bin", "n"])

    counted = map_arrow(texts.select("id", "text"), run, "bin int, n bigint").groupBy("bin").agg(F.sum("n").alias("n"))
    table = counted.toArrow()  # at most BINS rows
    out = np.zeros(BINS, np.int64)
    out[table["bin"].to_numpy()] = table["n"].to_numpy()
    return out


def rare_shingles(texts: DataFrame, size: int, percent: int = PERCENT) -> DataFrame:
    """(shingle, id, n, place): the rarest shingles of each set, counted from 0.

    As many as it takes for two sets that reach the threshold to have one in common.
    """
    often = texts.sparkSession.sparkContext.broadcast(rarity(texts, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, hashes, first in text_sets(batch.column(1), size):
                n = np.diff(first)
                owner = np.repeat(np.arange(b - a), n)
                line = np.lexsort((hashes, often.value[(hashes % np.uint64(BINS)).astype(np.int64)], owner))
                place = np.arange(len(hashes)) - np.repeat(first[:-1], n)
                kept = place <= np.repeat(n - (percent * n + 99) // 100, n)
                owner = owner[kept]
                ids = batch.column(0).slice(a, b - a).to_numpy()
                columns = [hashes[line][kept].view(np.int64), ids[owner], n[owner].astype(np.int32), place[kept].astype(np.int32)]
                yield pa.record_batch([pa.array(c) for c in columns], ["shingle", "id", "n", "place"])

    return map_arrow(texts.select("id", "text"), run, "shingle bigint, id bigint, n int, place int")


def passed_over(texts: DataFrame, roots: DataFrame, size: int, percent: int = PERCENT) -> DataFrame:
    """(a, b, share): all pairs of (id, text) that may reach the threshold and that `roots` does not connect.

    The first rare shingle that a pair has in common leaves room for enough others;
    `share` is the number of those that do.
    """
    rare = staged(rare_shingles(texts, size, percent).join(roots, "id", "left"), "rare-shingles")
    found = meetings(rare.withColumn("component", F.coalesce("component", "id")), percent)
    return found.groupBy("a", "b").agg(F.count("*").cast("float").alias("share"))


def meetings(rare: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): for each shingle in common, the pairs of different components whose sizes and places allow the threshold.

    `rare` has (shingle, id, n, place, component). The rows of a shingle are dealt to
    cells of two neighbouring size bands; sizes that allow the threshold are at most one
    band apart. A cell of one component is left out before anything meets. In the others
    the rows outside the cell's largest component meet all rows of the cell, which makes
    at most twice as many pairs as the cell has of different components.
    """
    band = F.floor(F.log("n") / math.log(100 / percent) + 1e-9).cast("int") if percent < 100 else F.col("n")
    cells = rare.withColumn("band", band).withColumn("cell", F.explode(F.array(F.col("band") - 1, F.col("band"))))
    cell = ["shingle", "cell"]
    sizes = cells.groupBy(*cell, "component").count()
    main = sizes.groupBy(*cell).agg(F.max(F.struct("count", "component")).alias("main"), F.count("*").alias("components"))
    main = staged(main.filter("components > 1").select(*cell, F.col("main.component").alias("main")), "rare-cells")
    rows = cells.join(main, cell).withColumn("outside", F.col("component") != F.col("main")).drop("main")
    rows = staged(rows, "rare-shared")
    left, right = (
        rows.select(*cell, *[F.col(c).alias(f"{c}_{s}") for c in ("id", "n", "place", "component", "band", "outside")])
        for s in "ab"
    )
    room = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    fits = (100 + percent) * room >= percent * (F.col("n_a") + F.col("n_b"))
    # two rows outside meet twice, two of one band in two cells; one of these counts
    once = (~F.col("outside_b") | (F.col("id_a") < F.col("id_b"))) & ~(
        (F.col("band_a") == F.col("band_b")) & (F.col("band_a") != F.col("cell"))
    )
    found = left.filter("outside_a").join(right, cell).filter(once & (F.col("component_a") != F.col("component_b")) & fits)
    return found.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold; `texts` is a written table (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, ends = texts_of(batch.column(2))
            for i, j in slices(ends):
                part, sets = batch.slice(i, j - i), []
                for c in (2, 3):
                    found = list(text_sets(part.column(c), size))
                    hashes = np.concatenate([f[2] for f in found])
                    sets.append((hashes, np.repeat(np.arange(j - i), np.concatenate([np.diff(f[3]) for f in found]))))
                hashes, owner = (np.concatenate([s[k] for s in sets]) for k in (0, 1))
                line = np.lexsort((hashes, owner))
                hashes, owner = hashes[line], owner[line]
                twice = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
                common = np.bincount(owner[1:][twice], minlength=j - i)
                union = np.bincount(owner, minlength=j - i) - common
                yield part.select(["a", "b"]).filter(pa.array(100 * common >= percent * union))

    both = (
        pairs.select("a", "b")
        .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    )
    return map_arrow(both.select("a", "b", "text_a", "text_b"), run, "a bigint, b bigint")


def links(
    pairs: DataFrame, texts: DataFrame, size: int, percent: int = PERCENT, known: DataFrame | None = None
) -> DataFrame:
    """Links (a, b) that join what the confirmed ones of `pairs` (a, b, share) and the `known` ones all join."""
    ends = pairs.select("a", "b", "share").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "share"))
    best = ends.groupBy("a").agg(F.max(F.struct("share", (-F.col("b")).alias("b"))).alias("best"))
    other = -F.col("best.b")
    first = staged(best.select(F.least("a", other).alias("a"), F.greatest("a", other).alias("b")).distinct(), "first-pairs")
    sure = staged(confirmed(first, texts, size, percent), "links")
    if known is not None:
        sure = sure.unionByName(known)
    joined = staged(components(sure), "joined")
    apart = pairs.join(first, ["a", "b"], "left_anti")
    for side in ("a", "b"):
        root = joined.select(F.col("id").alias(side), F.col("component").alias(f"root_{side}"))
        apart = apart.join(root, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    rest = staged(apart.filter("root_a <> root_b").select("a", "b"), "pairs-apart")
    return sure.unionByName(staged(confirmed(rest, texts, size, percent), "links"))


def near_classes(docs: DataFrame, size: int, percent: int = PERCENT, neighbours: int = NEIGHBOURS) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per document."""
    ids = docs.schema["doc_id"].dataType
    if not isinstance(ids, T.IntegralType):
        raise TypeError(f"doc_id must be a whole number, not {ids.simpleString()}")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = staged(sketches(docs, size), "sketches")
    linkable = known.filter("n_shingles > 0 and doc_id is not null")
    by_set = staged(linkable.groupBy("content").agg(F.min("doc_id").alias("doc_id")), "sets")
    firsts = linkable.join(by_set, ["content", "doc_id"], "left_semi").dropDuplicates(["content", "doc_id"])
    classes = staged(firsts.select(F.col("doc_id").alias("id"), "n_shingles", "marks", "prefixes"), "classes")
    shared = shared_prefixes(classes)
    pairs = staged(candidates(classes, shared, percent, neighbours), "candidates")
    paired = pairs.select(F.explode(F.array("a", "b")).alias("id"), F.lit(False).alias("crowded"))
    crowd = crowded(classes, shared, neighbours).withColumn("crowded", F.lit(True))
    involved = staged(paired.unionByName(crowd).groupBy("id").agg(F.max("crowded").alias("crowded")), "involved")
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    texts = staged(texts.join(involved, "id"), "texts")
    roots = staged(components(links(pairs, texts, size, percent)), "components")
    crowd = texts.filter("crowded")
    if not crowd.isEmpty():
        missed = staged(passed_over(crowd, roots, size, percent), "passed-over")
        held = roots.select(F.col("id").alias("a"), F.col("component").alias("b"))
        roots = staged(components(links(missed, texts, size, percent, held)), "components")
    groups = by_set.join(roots.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    groups = staged(groups.select("content", F.coalesce("component", "doc_id").alias("component_id")), "groups")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return (
        known.select("doc_id", "n_shingles", "content")
        .join(groups, "content", "left")
        .select(F.col("doc_id").cast(ids), "n_shingles", F.when(F.col("doc_id").isNotNull(), own).cast(ids).alias("component_id"))
    )


def report(found: DataFrame) -> DataFrame:
    """`near_classes` with kept: whether a document is the one of its component that stays."""
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_dedup(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one with the smallest id, with all columns of `docs`."""
    gone = report(near_classes(docs, size, percent)).filter("not kept").select("doc_id").distinct()
    gone = staged(gone, "near-copies").withColumnRenamed("doc_id", "_gone")
    row = docs.select("doc_id", F.struct(*docs.columns).alias("_row"))
    return row.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti").select("_row.*")
