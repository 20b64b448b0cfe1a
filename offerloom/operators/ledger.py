"""First-in-first-out use of credit lots by redemptions, with and without expiry."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from offerloom.functions.scalars import value_block
from offerloom.functions.timing import time_block
from offerloom.operators.scan import prefix_scan, ranged, split_busy, whole_scan
from offerloom.operators.timeline import BLOCK_HOURS, KEY
from offerloom.session import staged


def _ends(df: DataFrame, ts: str, ident: str, block_hours: int) -> DataFrame:
    """Position on the customer's points line where each row's points end."""
    cut = df.withColumn("block", time_block(F.col(ts), block_hours))
    done = prefix_scan(cut, [KEY], ["block"], [ts, ident], {"position": ("sum", "points")})
    return done.select(KEY, ident, "position")


def _whole_ends(lots: DataFrame, spends: DataFrame) -> DataFrame:
    """`_ends` of both sides, dealt by customer together."""
    both = lots.select(KEY, "ts", "lot_id", "points").unionByName(
        spends.select(KEY, "ts", "spend_id", "points"), allowMissingColumns=True
    )
    sides = both.filter("points > 0").withColumn("side", F.col("lot_id").isNull()).repartition(KEY)
    done = whole_scan(sides, [KEY, "side"], [], ["ts", "lot_id", "spend_id"], {"position": ("sum", "points")})
    return done.select(KEY, "lot_id", "spend_id", "position")


def _with_busy(fifo: Callable[..., DataFrame], lots: DataFrame, spends: DataFrame, busy: DataFrame, *cuts: int) -> DataFrame:
    """`fifo` with the customers in `busy` cut into blocks, and with all others as wholes."""
    (calm, lots), (calm_spends, spends) = (split_busy(df, busy, KEY) for df in (lots, spends))
    got = fifo(calm, calm_spends, *cuts, whole=True)
    return got if lots is None else got.unionByName(fifo(lots, spends, *cuts))


def fifo_lots(
    lots: DataFrame,
    spends: DataFrame,
    block_hours: int = BLOCK_HOURS,
    per_octave: int = 256,
    busy: DataFrame | None = None,
    whole: bool = False,
) -> DataFrame:
    """Points of each lot used by each spend, whatever the times of credit and expiry.

    Lots (`lot_id`, `ts`, `points`) and spends (`spend_id`, `ts`, `points`) tile the
    same line of points. Between two neighbouring ends lies a piece of exactly one
    lot and one spend: the nearest of each ending at or after it. Ends are swept
    in order, so no lot meets a spend it does not touch. Points are positive. With `busy`,
    the customers that have too many rows for one task, only those are cut into blocks;
    `whole` cuts none.
    """
    if busy is not None:
        return _with_busy(fifo_lots, lots, spends, busy, block_hours, per_octave)
    scan = whole_scan if whole else prefix_scan
    if whole:
        both = _whole_ends(lots, spends)
    else:
        lot_ends = _ends(lots.filter("points > 0"), "ts", "lot_id", block_hours)
        spend_ends = _ends(spends.filter("points > 0"), "ts", "spend_id", block_hours)
        both = lot_ends.unionByName(spend_ends, allowMissingColumns=True)
    ends = both.groupBy(KEY, "position").agg(F.max("lot_id").alias("lot_id"), F.max("spend_id").alias("spend_id"))
    ends = ends.withColumns(
        {
            "piece_block": value_block(F.col("position"), per_octave),
            "lot": F.when(F.col("lot_id").isNotNull(), F.struct("position", "lot_id")),
            "spend": F.when(F.col("spend_id").isNotNull(), F.struct("position", "spend_id")),
        }
    ).drop("lot_id", "spend_id")
    started = scan(
        ends, [KEY], ["piece_block"], ["position"], {"start": ("max", "position")}, inclusive=False
    ).withColumn("back", -F.col("piece_block"))
    pieces = scan(
        started,
        [KEY],
        ["back"],
        [F.col("position").desc()],
        {"lot": ("min", "lot"), "spend": ("min", "spend")},
    )
    return pieces.filter("lot is not null and spend is not null").select(
        KEY,
        "lot.lot_id",
        "spend.spend_id",
        (F.col("position") - F.coalesce("start", F.lit(0))).alias("points_used"),
    )


# Order of what happens at one instant: lots are there, then lots expire, then points are spent.
CREDIT, EXPIRY, SPEND = 0, 1, 2
EVENT = [KEY, "at", "kind", "ident"]
NEVER = (1 << 62) - 1


def _lot_line(lots: DataFrame, block_hours: int, whole: bool = False) -> DataFrame:
    """Lots with `position`, where each ends on the customer's line of lots, and the expiry that counts.

    Points leave the line from its front, so a lot's expiry counts as no earlier than
    those of the lots before it; a lot without expiry keeps all behind it.
    """
    far = F.lit("9999-12-31").cast("timestamp_ntz")
    cut = lots.filter("points > 0").withColumns(
        {"block": time_block(F.col("ts"), block_hours), "ends": F.coalesce("expiry_ts", far)}
    )
    scan = whole_scan if whole else prefix_scan
    line = scan(cut, [KEY], ["block"], ["ts", "lot_id"], {"position": ("sum", "points"), "ends": ("max", "ends")})
    return line.select(KEY, "lot_id", "ts", "position", F.when(F.col("ends") < far, F.col("ends")).alias("ends"))


def _compose(clamp: tuple[int, int, int], kind: int, amount: int, credited: int) -> tuple[int, int, int]:
    """A clamp p -> min(high, max(low, p + add)) followed by an event."""
    add, low, high = clamp
    if kind == EXPIRY:
        return add, max(low, amount), max(high, amount)
    return add + amount, min(low + amount, credited), min(high + amount, credited)


def _events(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(batch.column(c).to_pylist() for c in ("block", KEY, "kind", "amount", "credited")))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The clamps of the first and the last customer of each block; the others begin and end inside."""
    block = customer = None
    clamp, first = (0, 0, NEVER), True
    out: list[tuple] = []
    for batch in batches:
        for b, c, kind, amount, credited in _events(batch):
            if b != block or c != customer:
                if block is not None and (first or b != block):
                    out.append((block, first, customer, *clamp))
                first = b != block
                block, customer, clamp = b, c, (0, 0, NEVER)
            clamp = _compose(clamp, kind, amount, credited)
    if block is not None:
        out.append((block, first, customer, *clamp))
    columns = list(zip(*out)) or [[]] * 6
    types = [pa.int64(), pa.bool_(), *[pa.int64()] * 4]
    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], ["block", "first", "customer", "add", "low", "high"])


def _starts(summaries: list[Row]) -> dict[int, int]:
    """Where the first customer of each block stands when the block begins; the list has two rows a block at most."""
    out, standing, before = {}, 0, None
    for r in sorted(summaries, key=lambda r: (r["block"], not r["first"])):
        start = standing if r["first"] and r["customer"] == before else 0
        if r["first"]:
            out[r["block"]] = start
        standing, before = min(r["high"], max(r["low"], start + r["add"])), r["customer"]
    return out


def _walk(batches: Iterator[pa.RecordBatch], starts: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """Spends with where the front of their customer's line was before and after them."""
    block, customer, front = None, None, 0
    for batch in batches:
        begin, end = [], []
        for b, c, kind, amount, credited in _events(batch):
            if b != block:
                block, customer, front = b, c, starts[b]
            elif c != customer:
                customer, front = c, 0
            begin.append(front)
            front = max(front, amount) if kind == EXPIRY else min(front + amount, credited)
            end.append(front)
        kept = batch.append_column("start", pa.array(begin, pa.int64())).append_column("end", pa.array(end, pa.int64()))
        yield kept.filter(pc.equal(kept.column("kind"), SPEND)).select([KEY, "ident", "amount", "start", "end"])


def spent_from(
    lots: DataFrame,
    spends: DataFrame,
    block_hours: int = BLOCK_HOURS,
    busy: DataFrame | None = None,
    whole: bool = False,
    line: DataFrame | None = None,
) -> DataFrame:
    """(customer_id, spend_id, points, start, end): the stretch of the line of lots that each spend uses up.

    The line's front moves to the end of each lot that expires and by each spend, but
    not beyond what has been credited by then: what a spend lacks is not taken from
    later lots. Each of these moves is a clamp, and clamps compose to clamps, so a
    customer whose events fill many ranges is walked in all of them at once: a first
    pass sums up each range, a second one starts from where the ranges before end. With
    `busy`, the customers that have too many rows for one task, only those are cut so;
    `whole` cuts none. `line` is that of the lots if it is there already.
    """
    if busy is not None:
        return _with_busy(spent_from, lots, spends, busy, block_hours)
    if line is None:
        line = _lot_line(lots, block_hours, whole)
    zero = F.lit(0).cast("long")
    moves = (
        line.select(KEY, F.col("ts").alias("at"), F.lit(CREDIT).alias("kind"), F.col("lot_id").alias("ident"), zero.alias("amount"), F.col("position").alias("credited"))
        .unionByName(
            line.filter("ends is not null").select(
                KEY, F.greatest("ends", "ts").alias("at"), F.lit(EXPIRY).alias("kind"), F.col("lot_id").alias("ident"), F.col("position").alias("amount"), zero.alias("credited")
            )
        )
        .unionByName(
            spends.filter("points > 0").select(
                KEY, F.col("ts").alias("at"), F.lit(SPEND).alias("kind"), F.col("spend_id").alias("ident"), F.col("points").cast("long").alias("amount"), zero.alias("credited")
            )
        )
        .withColumn("time", time_block(F.col("at"), block_hours))
    )
    scan = whole_scan if whole else prefix_scan
    known = scan(moves, [KEY], ["time"], ["at", "kind", "ident"], {"credited": ("max", "credited")}).drop("time")
    known = known.filter(F.col("kind") != CREDIT)
    if whole:
        # every customer is in one place and in order
        dealt, starts = known.withColumn("block", F.lit(0).cast("long")).sortWithinPartitions(*EVENT), {0: 0}
    else:
        dealt = ranged(known, EVENT, "ledger").repartition("block").sortWithinPartitions("block", *EVENT)
        schema = "block bigint, first boolean, customer bigint, add bigint, low bigint, high bigint"
        starts = _starts(dealt.select("block", KEY, "kind", "amount", "credited").mapInArrow(_summaries, schema).collect())
    ident = spends.schema["spend_id"].dataType.simpleString()
    found = dealt.mapInArrow(lambda batches: _walk(batches, starts), f"{KEY} bigint, ident {ident}, amount bigint, start bigint, end bigint")
    return found.withColumnsRenamed({"ident": "spend_id", "amount": "points"})


def fifo_expiring(
    lots: DataFrame,
    spends: DataFrame,
    block_hours: int = BLOCK_HOURS,
    per_octave: int = 256,
    busy: DataFrame | None = None,
    whole: bool = False,
) -> DataFrame:
    """Points of each lot used by each spend: oldest lots first, none before its credit or from its expiry on.

    Lots (`lot_id`, `ts`, `points`, `expiry_ts`) and the stretches of spends lie on one
    line. Cut at all ends and starts, each piece has the nearest lot end at or after it,
    and the nearest spend end if that spend has begun. Ids are of one type. Points are
    positive; what a spend lacks has no row. `busy` and `whole` are as in `fifo_lots`.
    """
    if busy is not None:
        return _with_busy(fifo_expiring, lots, spends, busy, block_hours, per_octave)
    scan = whole_scan if whole else prefix_scan
    line = staged(_lot_line(lots, block_hours, whole), "lots")
    used = staged(spent_from(lots, spends, block_hours, whole=whole, line=line).filter("end > start"), "stretches")
    spend = F.struct(F.col("end").alias("position"), "spend_id", "start")
    ends = (
        line.select(KEY, "position", F.struct("position", "lot_id").alias("lot"))
        .unionByName(used.select(KEY, F.col("end").alias("position"), spend.alias("spend")), allowMissingColumns=True)
        .unionByName(used.select(KEY, F.col("start").alias("position")), allowMissingColumns=True)
    )
    if whole:
        ends = ends.repartition(KEY)  # all that follows is by customer
    ends = (
        ends.groupBy(KEY, "position")
        .agg(F.max("lot").alias("lot"), F.max("spend").alias("spend"))
        .withColumn("piece_block", value_block(F.col("position"), per_octave))
    )
    begun = scan(
        ends, [KEY], ["piece_block"], ["position"], {"before": ("max", "position")}, inclusive=False
    ).withColumn("back", -F.col("piece_block"))
    pieces = scan(
        begun, [KEY], ["back"], [F.col("position").desc()], {"lot": ("min", "lot"), "spend": ("min", "spend")}
    )
    return pieces.filter("lot is not null and spend is not null and spend.start < position").select(
        KEY, "lot.lot_id", "spend.spend_id", (F.col("position") - F.coalesce("before", F.lit(0))).alias("points_used")
    )
