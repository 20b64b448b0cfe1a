"""Tables that grow by batches, kept as few sorted runs.

Every batch becomes a run of level 0. When a level has `FAN_OUT` runs they are merged
into one run of the next level, so after n batches a reader meets at most
FAN_OUT - 1 runs on each of log(n) levels, and a row is rewritten once a level. Which
runs count is said by a manifest that is replaced whole: a crash between a merge and
its manifest loses nothing, and a batch that comes again is known by its source and
number and left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from offerloom.sources import versioned
from offerloom.sources.versioned import Version

FAN_OUT = 8


@dataclass(frozen=True)
class Runs:
    """A table of runs under `path`.

    `merge` turns the rows of several runs into what they say together; it must be
    associative and not depend on the order of runs, and is applied on reading too.
    `sort` are the columns whose ranges a run is laid out by.
    """

    spark: SparkSession
    path: str
    schema: StructType
    merge: Callable[[DataFrame], DataFrame]
    sort: Sequence[str]
    fan_out: int = FAN_OUT

    def _state(self) -> Version:
        known = versioned.version(self.spark, self.path)
        return known or Version(0, [], self.schema.json(), None, {"levels": [], "done": {}})

    def _switch(self, state: Version, levels: list[list[str]], done: dict) -> Version:
        folders = [f for level in levels for f in level]
        new = Version(state.number + 1, folders, state.schema, None, {"levels": levels, "done": done})
        return versioned.publish(self.spark, self.path, new)

    def _write(self, rows: DataFrame) -> str:
        laid = rows.select(*self.schema.names).repartitionByRange(*self.sort).sortWithinPartitions(*self.sort)
        return versioned.write_folder(laid, self.path)[0]

    def append(self, batch: DataFrame, source: str = "", number: int | None = None) -> bool:
        """Add a batch; False if batch `number` of `source` is there already."""
        state = self._state()
        levels, done = [list(x) for x in state.info["levels"]], dict(state.info["done"])
        if number is not None and number <= done.get(source, -1):
            return False
        levels = levels or [[]]
        levels[0].append(self._write(self.merge(batch)))
        if number is not None:
            done[source] = number
        self._switch(state, levels, done)
        self.compact()
        return True

    def compact(self) -> None:
        """Merge every level that has `fan_out` runs into a run of the next one."""
        state = self._state()
        for k in range(len(state.info["levels"]) + 1):
            levels = [list(x) for x in state.info["levels"]]
            if k >= len(levels) or len(levels[k]) < self.fan_out:
                continue
            if k + 1 == len(levels):
                levels.append([])
            merged = self._write(self.merge(versioned.read_folders(self.spark, self.path, levels[k], self.schema)))
            levels[k] = []
            levels[k + 1].append(merged)
            state = self._switch(state, levels, state.info["done"])

    def read(self) -> DataFrame:
        """What all batches so far say together."""
        return self.merge(versioned.read_folders(self.spark, self.path, self._state().folders, self.schema))

    def depth(self) -> int:
        """Runs that a reader meets."""
        return len(self._state().folders)
