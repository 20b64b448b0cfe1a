"""First matching rule of a long rule list, by elementary intervals and bit sets.

Rules are taken in the order they are tried, in blocks. In a block the values that
conditions name cut each field into cells: each value, what lies between two
neighbours, null and NaN. A cell has one bit per rule, set if the rule's conditions on
that field hold there. A row looks up its cell of each field, the bit sets are ANDed,
and the first bit that is left is the block's first matching rule; rows without one go on
to the next block. The work for a row grows with rules / 8 bytes per field, not with the
number of conditions, and there is no limit to the number of rules: the blocks are
handed to tasks in parts of bounded size. Rows that a part leaves open are written
before the next part takes them, so a task holds one part however many there are.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerloom.operators.rules import FIELDS, OPERATORS
from offerloom.session import staged
from offerloom.sources.controls import active_rules
from offerloom.sources.fixtures import NO_OFFER, NO_RULE

BLOCK = 1024  # rules whose bits lie side by side
PART_BYTES = 32 << 20  # of cells that are handed to tasks together
WON = T.StructType(
    [T.StructField("rule", T.StringType()), T.StructField("action", T.StringType()), T.StructField("action_level", T.IntegerType())]
)


def _order(value: object) -> object:
    """Texts go by their bytes, as in Spark."""
    return value.encode() if isinstance(value, str) else value


@dataclass
class Cells:
    """The cells of one field in one block: 2 k + 1 is the k-th value, 2 k lies before it; then null and NaN."""

    name: str
    text: bool
    values: list
    bits: np.ndarray

    @classmethod
    def build(cls, field: str, conditions: Sequence[list[tuple[str, object]]]) -> Cells:
        """`conditions` has a list of (op, value) for each rule of the block."""
        name, kind = FIELDS[field]
        text = kind == "text"
        named = {_order(v) for own in conditions for op, v in own if op in OPERATORS and _fits(v, text) and not _is_nan(v)}
        values = sorted(named)
        held = np.ones((2 * len(values) + 3, len(conditions)), bool)
        for rule, own in enumerate(conditions):
            for op, value in own:
                held[:, rule] &= _holds(op, value, values, text)
        return cls(name, text, values, np.packbits(held, axis=1))

    def find(self, column: pa.Array) -> np.ndarray:
        """The cell of each row."""
        n = 2 * len(self.values)
        if self.text:
            coded = column.dictionary_encode()
            places = np.array([self._place(v.encode()) for v in coded.dictionary.to_pylist()] or [0])
            return np.where(column.is_null().to_numpy(zero_copy_only=False), n + 1, places[coded.indices.fill_null(0).to_numpy()])
        row = column.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
        breaks = np.array(self.values, float)
        at = np.searchsorted(breaks, row, "left")
        equal = (at < len(breaks)) & (np.append(breaks, np.nan)[np.minimum(at, len(breaks))] == row)
        cell = np.where(np.isnan(row), n + 2, 2 * at + equal)
        return np.where(column.is_null().to_numpy(zero_copy_only=False), n + 1, cell)

    def _place(self, value: bytes) -> int:
        low, high = 0, len(self.values)
        while low < high:
            mid = (low + high) // 2
            low, high = (mid + 1, high) if self.values[mid] < value else (low, mid)
        return 2 * low + (low < len(self.values) and self.values[low] == value)


def _is_nan(value: object) -> bool:
    return isinstance(value, float) and math.isnan(value)


def _fits(value: object, text: bool) -> bool:
    return isinstance(value, str) if text else isinstance(value, (bool, int, float))


def _holds(op: str, value: object, values: list, text: bool) -> np.ndarray:
    """In which cells a condition holds; the same rules as for single conditions, never null."""
    n = 2 * len(values)
    cells = np.arange(n + 3)
    null, nan = cells == n + 1, cells == n + 2
    if op not in OPERATORS:
        return np.zeros(n + 3, bool)
    if value is None:
        return {"=": null, "!=": ~null}.get(op, np.zeros(n + 3, bool))
    if not _fits(value, text):
        return np.full(n + 3, op == "!=")
    if _is_nan(value):
        numbers = ~null & ~nan
        return {"=": nan, "!=": ~nan, "<": numbers, "<=": numbers}.get(op, np.zeros(n + 3, bool))
    place = 2 * bisect_left(values, _order(value)) + 1
    numbers = cells <= n
    return {
        "=": cells == place,
        "!=": cells != place,
        ">=": numbers & (cells >= place),
        "<=": numbers & (cells <= place),
        ">": numbers & (cells > place),
        "<": numbers & (cells < place),
    }[op]


@dataclass
class Block:
    """Some rules in a row, and the cells of the fields they name."""

    fields: list[Cells]
    width: int
    names: list[tuple]

    @classmethod
    def build(cls, rules: Sequence[Row]) -> Block:
        parsed = []
        for r in rules:
            if r["conditions"] is None:
                raise ValueError(f"rule {r['name']!r} has no list of conditions; a rule for everyone has an empty one")
            parsed.append([(c["field"], c["op"], c["value"]) for c in json.loads(r["conditions"] or "[]")])
        used = {field for own in parsed for field, _, _ in own}
        if unknown := used - set(FIELDS):
            raise KeyError(f"unknown field: {min(unknown)}")
        cells = [Cells.build(f, [[(op, v) for field, op, v in own if field == f] for own in parsed]) for f in sorted(used)]
        return cls(cells, len(rules), [(r["name"], r["action"], int(r["action_level"])) for r in rules])

    @property
    def bytes(self) -> int:
        return sum(c.bits.nbytes for c in self.fields) + 64 * self.width

    def first(self, batch: pa.RecordBatch) -> np.ndarray:
        """The first matching rule of each row, -1 for none."""
        left = np.full((batch.num_rows, -(-self.width // 8)), 0xFF, np.uint8)
        for cells in self.fields:
            left &= cells.bits[cells.find(batch.column(cells.name))]
        # bits beyond the last rule stand for nothing
        left[:, -1] &= 0xFF << (8 * left.shape[1] - self.width) & 0xFF
        some = left != 0
        byte = some.argmax(axis=1)
        bit = np.unpackbits(left[np.arange(len(left)), byte][:, None], axis=1).argmax(axis=1)
        return np.where(some.any(axis=1), 8 * byte + bit, -1)


def parts(rules: Iterable[Row], block: int = BLOCK, part_bytes: int = PART_BYTES) -> Iterator[list[Block]]:
    """Blocks of the rules in their order, in parts of about `part_bytes`."""
    held: list[Block] = []
    rows: list[Row] = []

    def closed() -> None:
        if rows:
            held.append(Block.build(rows))
            rows.clear()

    for r in rules:
        rows.append(r)
        if len(rows) == block:
            closed()
            if sum(b.bytes for b in held) >= part_bytes:
                yield list(held)
                held.clear()
    closed()
    if held:
        yield held


def match_rules_indexed(customers: DataFrame, rules: DataFrame, block: int = BLOCK, part_bytes: int = PART_BYTES) -> DataFrame:
    """Rule, action and level of each customer, as `match_rules` gives them, for rule lists of any length.

    The driver reads the rules a partition at a time, in their order. Numbers are compared as
    doubles, so whole numbers beyond 2^53 are not told apart.
    """
    spark, names = customers.sparkSession, customers.columns
    schema = T.StructType([*customers.schema.fields, *WON.fields])
    left, tried, won = customers, None, []
    for part in parts(active_rules(rules).toLocalIterator(), block, part_bytes):
        if tried is not None:
            # another part follows: what the last one left open is written and goes on
            tried = staged(tried, "tried")
            won.append(tried.filter("action_level is not null"))
            left = tried.filter("action_level is null").select(*names)
        index = spark.sparkContext.broadcast(part)

        def match(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: list[list] = [[None] * batch.num_rows for _ in WON.names]
                open_rows = np.arange(batch.num_rows)
                for piece in index.value:
                    if not len(open_rows):
                        break
                    first = piece.first(batch.take(pa.array(open_rows)))
                    for k, rule in zip(open_rows[first >= 0].tolist(), first[first >= 0].tolist()):
                        out[0][k], out[1][k], out[2][k] = piece.names[rule]
                    open_rows = open_rows[first < 0]
                types = [pa.string(), pa.string(), pa.int32()]
                yield pa.record_batch(
                    [*batch.select([*names]).columns, *[pa.array(c, t) for c, t in zip(out, types)]], [*names, *WON.names]
                )

        tried = left.mapInArrow(match, schema)
    if tried is None:
        nothing = (F.lit(None).cast(f.dataType).alias(f.name) for f in WON.fields)
        tried = customers.select("*", *nothing)
    found = reduce(DataFrame.unionByName, won, tried)
    missed = F.col("action_level").isNull()
    default = {"rule": F.lit(NO_RULE), "action": F.lit(NO_OFFER), "action_level": F.lit(1)}
    return found.select(*names, *[F.when(missed, default[c]).otherwise(F.col(c)).alias(c) for c in WON.names])
