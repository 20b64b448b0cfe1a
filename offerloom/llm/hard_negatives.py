"""Hard negatives by coordinate pruning, after LEMP.

Vectors are sorted by length and cut into buckets. A bucket keeps its vectors at length
one, and for every coordinate the list of its vectors in the coordinate's order. An anchor
that looks for scores of at least t needs a cosine of at least t / (anchor's length *
bucket's largest length). If that is over one, the bucket is passed by. Otherwise each
of the anchor's focus coordinates, those of largest absolute value, limits the values
that a vector may have there: with the anchor's own value cos(x) and a cosine of at
least cos(y), only values from cos(x + y) to cos(x - y). The lists give these ranges by
binary search, the sets of all focus coordinates are intersected, and only what is in
all of them is scored, by the exact integer inner product of whole vectors.

Thresholds come from the anchor's own bucket first: its k-th score there is a lower
bound of the final one. Then blocks of anchors meet all buckets, each bucket gives at
most k rows for an anchor and a range of scores, and Spark keeps the first k of these.
The same search finds positives (the anchor's label, no range) and negatives (other
labels, a range for each positive).

Integers are exact: products are made in doubles only where no sum can pass 2^53, else
in Python integers. Scores beyond 64 bits are returned as the nearest 64-bit number, and
those beyond 10^31 count as equal.

Defined results: rows with a null id, label or vector, or a null or non-finite component
take no part; shorter vectors count as filled up with zeros; equal scores go to the smaller
id; an anchor's other rows are those with another id; a repeated row is a row of its own, and a
repeated anchor comes once for each distinct row; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerloom.llm.frames import map_arrow
from offerloom.session import staged

FIRST = 5
LOW, HIGH = 80, 100  # percent of the positive's score
SCALE = 256
FOCUS = 3
BUCKET_BYTES = 1 << 21
BUCKET_ROWS = 4096
BLOCK = 256  # anchors that meet a bucket together
EXACT = float(1 << 53)
LARGEST = (1 << 63) - 1
LIMIT = 10**31  # scores beyond count as this one
SLACK = 1e-6  # rounding of lengths and angles; what it lets in is scored and thrown out
VECTOR = "vec_id bigint, label bigint, vector array<double>"
BUCKET = "bucket string, top double, bottom double, width int, ids binary, labels binary, vectors binary, lists binary"


def quantised(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, vector, length) of the rows that take part."""
    numbers = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    # floor gives a 64-bit number; beyond it a double has no fraction anyway
    big = F.transform("embedding", lambda x: F.lit(float(scale)) * x.cast("double"))
    fits = F.forall(big, lambda x: F.abs(x) < F.lit(9e18))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = table.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    rows = rows.filter(F.coalesce(finite, F.lit(False)))
    vector = F.when(fits, numbers).otherwise(big)
    square = F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vector.alias("vector"), F.sqrt(square).alias("length"))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    ends = column.offsets.to_numpy()
    sizes, flat = np.diff(ends), column.values.to_numpy()
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(ends[0], ends[-1]) - np.repeat(ends[:-1], sizes)] = flat[ends[0] : ends[-1]]
    return out


def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vectors at length one, lengths); a vector of zeros stays one."""
    largest = np.abs(vectors).max(axis=1, initial=0.0)
    scaled = vectors / np.where(largest > 0, largest, 1)[:, None]
    lengths = np.sqrt((scaled * scaled).sum(axis=1))
    return scaled / np.where(lengths > 0, lengths, 1)[:, None], lengths * largest


def _bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of rows (vec_id, label, vector, part) sorted by falling length."""
    names = [c.split()[0] for c in BUCKET.split(", ")]
    count, held, size = 0, [], 0
    part = None

    def closed() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        lists = rows.column("vector")
        width = int(np.diff(lists.offsets.to_numpy()).max(initial=0))
        vectors = _matrix(lists, width)
        unit, lengths = _unit(vectors)
        # for every coordinate the rows in its order
        ordered = np.argsort(unit, axis=0, kind="stable").T.astype(np.int32)
        ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        values = [f"{part}-{count}", lengths.max(), lengths.min(), width]
        values += [x.tobytes() for x in (ids, labels, vectors, np.ascontiguousarray(ordered))]
        types = [pa.string(), pa.float64(), pa.float64(), pa.int32(), *[pa.binary()] * 4]
        return pa.record_batch([pa.array([v], t) for v, t in zip(values, types)], names)

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.column("part")[at].as_py() if part is None else part
            width = max(1, max((len(v) for v in batch.column("vector").slice(at, 1).to_pylist()), default=1))
            room = max(1, min(BUCKET_ROWS, BUCKET_BYTES // (8 * width)) - size)
            piece = batch.slice(at, room)
            held.append(piece)
            at, size = at + piece.num_rows, size + piece.num_rows
            if size >= min(BUCKET_ROWS, max(1, BUCKET_BYTES // (8 * width))):
                yield closed()
                count, held, size = count + 1, [], 0
    if held:
        yield closed()


def buckets(rows: DataFrame) -> DataFrame:
    """Buckets of `quantised` rows by falling length, each with its sorted coordinate lists."""
    by = [F.desc("length"), F.asc("vec_id")]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    ranged = ranged.select("vec_id", "label", "vector", F.spark_partition_id().alias("part"))
    return staged(map_arrow(ranged, _bucketed, BUCKET), "buckets")


class Bucket:
    """A bucket in a task."""

    def __init__(self, row: dict) -> None:
        self.name, self.top, self.bottom, width = row["bucket"], row["top"], row["bottom"], row["width"]
        self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        n = len(self.ids)
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(n, width)
        self.lists = np.frombuffer(row["lists"], np.int32).reshape(width, n)
        self.unit, _ = _unit(self.vectors)
        self.largest = np.abs(self.vectors).max(initial=0.0)
        self.values: dict[int, np.ndarray] = {}

    def within(self, coordinate: int, low: float, high: float) -> np.ndarray:
        """Rows whose value of the coordinate is in the range, from its sorted list."""
        if coordinate not in self.values:
            self.values[coordinate] = self.unit[self.lists[coordinate], coordinate]
        values = self.values[coordinate]
        return self.lists[coordinate][np.searchsorted(values, low, "left") : np.searchsorted(values, high, "right")]

    def candidates(self, unit: np.ndarray, length: float, least: float, focus: int) -> np.ndarray | None:
        """Rows that may have a score of `least`; None stands for all."""
        if least <= 0:
            return None
        reach = length * self.top
        if not reach or least > reach * (1 + SLACK):
            return np.zeros(0, np.int64)
        angle = np.arccos(min(1.0, least / reach))
        met = np.zeros(len(self.ids), np.int8)
        chosen = np.argsort(-np.abs(unit[: len(self.lists)]), kind="stable")[:focus]
        for c in chosen.tolist():
            own = np.arccos(np.clip(unit[c], -1, 1))
            low, high = np.cos(min(np.pi, own + angle)), np.cos(max(0.0, own - angle))
            met[self.within(c, low - SLACK, high + SLACK)] += 1
        return np.flatnonzero(met == len(chosen))

    def scores(self, vector: np.ndarray, rows: np.ndarray | None) -> np.ndarray:
        """Exact inner products with the anchor."""
        own = self.vectors if rows is None else self.vectors[rows]
        width = min(own.shape[1], len(vector))
        own, vector = own[:, :width], vector[:width]
        if self.largest * np.abs(vector).max(initial=0.0) * max(1, width) < EXACT:
            return own @ vector
        numbers = [int(x) for x in vector]
        exact = (sum(int(a) * b for a, b in zip(row, numbers)) for row in own)
        return np.array([min(LIMIT, max(-LIMIT, x)) for x in exact], object)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, equal ones by smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k] if scores.dtype != object else sorted(scores)[-k]
        kept = np.flatnonzero(scores >= least)
    else:
        kept = np.arange(len(scores))
    return np.array(sorted(kept.tolist(), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)


def _search(bucket: Bucket, anchors: list, k: int, focus: int) -> Iterator[tuple]:
    """(anchor, tag, id, score) of each anchor's first k rows within each range of scores."""
    for anchor in anchors:
        vector = anchor["vector"]
        unit, length = _unit(vector[None, :])
        lows = [w[1] for w in anchor["wants"]]
        least = None if any(x is None for x in lows) else min(lows)
        rows = None if least is None else bucket.candidates(unit[0], float(length[0]), float(least), focus)
        if rows is not None and not len(rows):
            continue
        labels, ids = (bucket.labels, bucket.ids) if rows is None else (bucket.labels[rows], bucket.ids[rows])
        fit = (labels == anchor["label"]) == anchor["same"]
        fit &= ids != anchor["anchor_id"]
        scores = bucket.scores(vector, rows)[fit]
        ids = ids[fit]
        for tag, low, high in anchor["wants"]:
            at = np.ones(len(scores), bool)
            if low is not None:
                at &= scores >= low
            if high is not None:
                at &= scores <= high
            at = np.flatnonzero(at)
            for i in _first(scores[at], ids[at], k):
                yield anchor["anchor"], tag, int(ids[at[i]]), int(scores[at[i]])


def _blocks(batch: pa.RecordBatch) -> Iterator[bytes]:
    """Blocks of at most BLOCK anchors as Arrow streams."""
    for i in range(0, batch.num_rows, BLOCK):
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, batch.schema) as stream:
            stream.write_batch(batch.slice(i, BLOCK))
        yield out.getvalue().to_pybytes()


def _anchors(block: bytes) -> list:
    """The anchors of a block, vectors and thresholds as numbers."""
    out = pa.ipc.open_stream(block).read_all().to_pylist()
    for row in out:
        row["vector"] = np.array(row["vector"], float)
        row["wants"] = [(w["tag"], *(None if w[x] is None else int(w[x]) for x in ("low", "high"))) for w in row["wants"]]
    return out


def search(index: DataFrame, anchors: DataFrame, k: int = FIRST, focus: int = FOCUS) -> DataFrame:
    """(anchor, tag, id, score): the first k rows of each anchor within each of its ranges.

    `anchors` has (anchor, anchor_id, label, same, vector, home, wants); `home` is the bucket
    whose scores give the first thresholds, `wants` an array of (tag, low, high), null where open.
    """
    anchors = staged(anchors, "anchors")
    names = ["anchor", "tag", "id", "score"]
    schema = "anchor string, tag bigint, id bigint, score decimal(38,0)"

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = None
        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column("bucket")[i].as_py()
                if bucket is None or bucket.name != name:
                    bucket = Bucket({c: batch.column(c)[i].as_py() for c in batch.schema.names if c != "block"})
                found = list(_search(bucket, _anchors(batch.column("block")[i].as_py()), k, focus))
                columns = list(zip(*found)) or [[]] * 4
                types = [pa.string(), pa.int64(), pa.int64(), pa.decimal128(38, 0)]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array(list(_blocks(batch)), pa.binary())], ["block"])

    def packed_by_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            homes = batch.column("home").to_pylist()
            ends = [i for i in range(1, len(homes) + 1) if i == len(homes) or homes[i] != homes[i - 1]]
            for i, j in zip([0, *ends], ends):
                blocks = list(_blocks(batch.slice(i, j - i)))
                yield pa.record_batch([pa.array([homes[i]] * len(blocks)), pa.array(blocks, pa.binary())], ["bucket", "block"])

    # the anchor's own bucket: its k-th score there is a bound for all the others
    at_home = anchors.repartition("home").sortWithinPartitions("home")
    blocks = staged(map_arrow(at_home, packed_by_home, "bucket string, block binary"), "home-blocks")
    home = map_arrow(index.join(blocks, "bucket"), probe, schema)
    floor = home.groupBy("anchor", "tag").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") >= k)
    floor = floor.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("tag", "least"))).alias("floors"))
    raised = anchors.join(floor, "anchor", "left").withColumn(
        "wants",
        F.transform(
            "wants",
            lambda w: F.struct(
                w["tag"].alias("tag"),
                # null where neither is known
                F.greatest(w["low"], F.try_element_at("floors", w["tag"])).alias("low"),
                w["high"].alias("high"),
            ),
        ),
    )
    blocks = staged(map_arrow(raised.drop("floors", "home"), packed, "block binary"), "blocks")
    # every block meets every bucket: buckets are dealt to slots, and blocks are copied to all slots
    slots = index.sparkSession.sparkContext.defaultParallelism * 2
    dealt = index.withColumn("slot", F.pmod(F.xxhash64("bucket"), F.lit(slots)))
    copied = blocks.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))).withColumn("slot", F.col("slot").cast("long"))
    found = map_arrow(dealt.join(copied, "slot").drop("slot"), probe, schema)
    order = Window.partitionBy("anchor", "tag").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _long(score: str) -> F.Column:
    return F.greatest(F.least(F.col(score), F.lit(LARGEST).cast("decimal(38,0)")), F.lit(-LARGEST).cast("decimal(38,0)")).cast("long")


def hard_negatives(
    table: DataFrame,
    anchors: F.Column | None = None,
    first: int = FIRST,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    focus: int = FOCUS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for (vec_id, embedding, label).

    `anchors` is a condition on vec_id and label that chooses the rows to search for; all by default.
    A negative's score lies between `low` and `high` percent of its positive's.
    """
    rows = staged(quantised(table, scale), "vectors")
    index = buckets(rows)
    where = map_arrow(
        index.select("bucket", "ids"),
        lambda batches: (
            pa.record_batch([pa.array([b.column(0)[i].as_py()] * len(ids)), pa.array(ids)], ["home", "vec_id"])
            for b in batches
            for i in range(b.num_rows)
            for ids in [np.frombuffer(b.column(1)[i].as_py(), np.int64)]
        ),
        "home string, vec_id bigint",
    )
    chosen = rows.filter(F.lit(True) if anchors is None else anchors).select("vec_id", "label", "vector").distinct()
    homes = where.groupBy("vec_id").agg(F.min("home").alias("home"))
    name = F.concat_ws(" ", F.col("vec_id").cast("string"), F.sha2(F.to_json(F.struct("label", "vector")), 256))
    chosen = chosen.join(homes, "vec_id").select(name.alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "vector", "home")
    chosen = staged(chosen, "chosen")
    none = F.lit(None).cast("decimal(38,0)")
    open_range = F.array(F.struct(F.lit(0).cast("long").alias("tag"), none.alias("low"), none.alias("high")))
    positives = staged(search(index, chosen.withColumn("same", F.lit(True)).withColumn("wants", open_range), first, focus), "positives")
    # ceil(low * s / 100) to floor(high * s / 100), where that is not empty
    low_end = F.expr(f"cast(ceil({low} * score / 100) as decimal(38,0))")
    high_end = F.expr(f"cast(floor({high} * score / 100) as decimal(38,0))")
    ranges = positives.withColumn("low", low_end).withColumn("high", high_end).filter("low <= high")
    ranges = ranges.groupBy("anchor").agg(
        F.collect_list(F.struct(F.col("rank").cast("long").alias("tag"), "low", "high")).alias("wants")
    )
    wanted = chosen.join(ranges, "anchor").withColumn("same", F.lit(False))
    negatives = search(index, wanted, first, focus)
    known = positives.select("anchor", F.col("rank").cast("long").alias("tag"), F.col("id").alias("positive_id"), F.col("score").alias("positive"))
    return (
        negatives.join(known, ["anchor", "tag"])
        .join(chosen.select("anchor", "anchor_id"), "anchor")
        .select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            F.col("id").alias("negative_id"),
            _long("positive").alias("positive_score"),
            _long("score").alias("negative_score"),
        )
    )
