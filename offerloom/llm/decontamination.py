"""Benchmark decontamination: windows of benchmark words looked up in whole documents.

The benchmark's windows are made in Spark and collected as a hash set of bounded
size. Each task hashes every window of its documents' words, looks the hashes up,
and compares the words of each hit, so a result never rests on a hash. More
windows than `max_windows` are handled in blocks of about that many: one pass over
the documents for each, the hits of earlier passes carried along.

Defined results: null text has no words; a text of fewer words than a window can
only be hit by items that short; an item without words is ignored; windows of an
item without id count as hits but name no item; rows of one item_id are one item;
repeated documents get a row each; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerloom.llm.frames import map_arrow
from offerloom.llm.words import ALNUM, slices, texts_of, window_hashes, word_hashes, words_of
from offerloom.session import staged

WINDOW = 10
MAX_WINDOWS = 1_000_000  # at about 200 bytes each, with their words
_TOP = np.uint64(64 - 22)


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, length, words): every window of every item, words joined by a space."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = texts_of(batch.column(1))
            ids = batch.column(0)
            for a, b in slices(offsets):
                words = words_of(raw[offsets[a] : offsets[b]], offsets[a : b + 1], ALNUM)
                rows: tuple[list, list, list] = ([], [], [])
                for k, n in enumerate(words.counts):
                    size = min(window, int(n))
                    item = ids[a + k].as_py()
                    for i in range(words.first[k], words.first[k + 1] - size + 1 if n else words.first[k]):
                        rows[0].append(item)
                        rows[1].append(size)
                        rows[2].append(words.text(i, i + size))
                yield pa.record_batch(
                    [pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.binary())],
                    ["item", "length", "words"],
                )

    source = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return map_arrow(source, cut, "item string, length int, words binary").distinct()


class WindowSet:
    """A block of windows as a task needs them."""

    def __init__(self, rows: list) -> None:
        self.items: dict[bytes, list[str]] = {}
        self.lengths = sorted({r["length"] for r in rows})
        by_length: dict[int, list[int]] = {n: [] for n in self.lengths}
        for r in rows:
            words = bytes(r["words"])
            if words not in self.items:
                text = np.frombuffer(words, np.uint8)
                hashes = word_hashes(words_of(text, np.array([0, len(text)]), ALNUM))
                by_length[r["length"]].append(int(window_hashes(hashes, r["length"])[0]))
            self.items.setdefault(words, [])
            if r["item"] is not None:
                self.items[words].append(r["item"])
        self.sorted = {n: np.unique(np.array(h, np.uint64)) for n, h in by_length.items()}
        self.seen = {n: np.zeros(1 << 22, bool) for n in self.lengths}
        for n, h in self.sorted.items():
            self.seen[n][h >> _TOP] = True

    def found(self, length: int, hashes: np.ndarray) -> np.ndarray:
        """Positions whose hash is one of the windows of this length."""
        maybe = np.flatnonzero(self.seen[length][hashes >> _TOP])
        known = self.sorted[length]
        at = np.minimum(np.searchsorted(known, hashes[maybe]), len(known) - 1)
        return maybe[known[at] == hashes[maybe]]


def scan_texts(column: pa.Array, windows: WindowSet) -> tuple[np.ndarray, list, list, np.ndarray]:
    """Per text: number of words, hit words as [first, end) runs, items found; and n_hit."""
    raw, offsets = texts_of(column)
    counts, runs, items, hit_counts = [], [], [], []
    for a, b in slices(offsets):
        words = words_of(raw[offsets[a] : offsets[b]], offsets[a : b + 1], ALNUM)
        hashes = word_hashes(words)
        found: dict[int, set] = {}
        delta = np.zeros(len(hashes) + 1, np.int32)
        for length in windows.lengths:
            at = windows.found(length, window_hashes(hashes, length)) if len(hashes) >= length else np.zeros(0, int)
            text = np.searchsorted(words.first, at, "right") - 1
            whole = at + length <= words.first[text + 1]
            for i, k in zip(at[whole].tolist(), text[whole].tolist()):
                names = windows.items.get(words.text(i, i + length))
                if names is not None:
                    found.setdefault(k, set()).update(names)
                    delta[i] += 1
                    delta[i + length] -= 1
        hit = np.cumsum(delta[:-1]) > 0
        for k in range(b - a):
            if k not in found:
                runs.append([])
                items.append([])
                hit_counts.append(0)
                continue
            own = np.concatenate([[False], hit[words.first[k] : words.first[k + 1]], [False]])
            turn = np.flatnonzero(own[1:] != own[:-1]).tolist()
            runs.append(list(zip(turn[::2], turn[1::2])))
            items.append(sorted(found[k]))
            hit_counts.append(int(own.sum()))
        counts.append(words.counts)
    return np.concatenate(counts or [np.zeros(0, int)]), runs, items, np.array(hit_counts, np.int64)


def _blocks(items: DataFrame, window: int, max_windows: int) -> Iterator[list]:
    """The windows in blocks of about `max_windows`; the first may be empty."""
    windows = staged(benchmark_windows(items, window), "benchmark-windows")
    blocks = max(1, math.ceil(windows.count() / max_windows))
    part = F.pmod(F.xxhash64("words"), F.lit(blocks))
    for k in range(blocks):
        yield windows.filter(part == k).collect()


_HITS = "n_words bigint, runs array<struct<first:bigint,end:bigint>>, items array<string>"


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS
) -> DataFrame:
    """One row per document: its id and text, n_words, the runs of hit words, and the items found.

    `runs` are [first, end) positions counted in words, neither touching nor
    overlapping; `items` are distinct ids, sorted as strings.
    """
    out = docs.select("doc_id", "text")
    schema = T.StructType([*out.schema.fields, *T.StructType.fromDDL(_HITS).fields])
    for k, rows in enumerate(_blocks(items, window, max_windows)):
        known = docs.sparkSession.sparkContext.broadcast(WindowSet(rows))
        if k:
            out = staged(out, "contamination")
        out = map_arrow(out, lambda batches, known=known: _annotate(batches, known.value), schema)
    return out


def _merged(old: list, new: list) -> list:
    """The union of two lists of runs."""
    out: list = []
    for first, end in sorted([*old, *new]):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def _annotate(batches: Iterator[pa.RecordBatch], windows: WindowSet) -> Iterator[pa.RecordBatch]:
    run = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        text = batch.column(batch.schema.get_field_index("text"))
        counts, runs, items, _ = scan_texts(text, windows)
        if "runs" in batch.schema.names:
            before = batch.column(batch.schema.get_field_index("runs")).to_pylist()
            runs = [_merged([(r["first"], r["end"]) for r in old], new) for old, new in zip(before, runs)]
            names = batch.column(batch.schema.get_field_index("items")).to_pylist()
            items = [sorted({*old, *new}) for old, new in zip(names, items)]
        spans = [[{"first": f, "end": e} for f, e in r] for r in runs]
        yield pa.record_batch(
            [
                *batch.columns[:2],
                pa.array(counts, pa.int64()),
                pa.array(spans, run),
                pa.array(items, pa.list_(pa.string())),
            ],
            [*batch.schema.names[:2], "n_words", "runs", "items"],
        )


def remove_spans(found: DataFrame) -> DataFrame:
    """`contamination` with a column `clean_text`: the text without its hit words.

    A run goes with everything between its words; what surrounds it stays.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            runs = batch.column(batch.schema.get_field_index("runs")).to_pylist()
            out = text.to_pylist()
            for k, own in enumerate(runs):
                if own:
                    raw, offsets = texts_of(text.slice(k, 1))
                    words, kept, at = words_of(raw, offsets, ALNUM), [], 0
                    for r in own:
                        kept.append(raw[at : words.start[r["first"]]].tobytes())
                        at = words.end[r["end"] - 1]
                    out[k] = b"".join([*kept, raw[at:].tobytes()]).decode()
            yield pa.record_batch([*batch.columns, pa.array(out, pa.string())], [*batch.schema.names, "clean_text"])

    schema = T.StructType([*found.schema.fields, T.StructField("clean_text", T.StringType())])
    return map_arrow(found, cut, schema)


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """The documents without a hit, all their columns as they were."""
    out = docs
    for k, rows in enumerate(_blocks(items, window, max_windows)):
        known = docs.sparkSession.sparkContext.broadcast(WindowSet(rows))

        def keep(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = scan_texts(batch.column(batch.schema.get_field_index("text")), known.value)[3]
                yield batch.filter(pa.array(hits == 0))

        out = map_arrow(staged(out, "clean") if k else out, keep, docs.schema)
    return out


def report(found: DataFrame) -> DataFrame:
    """The digest columns: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["first"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def items_digest(items: list[str]) -> str:
    """What `items_sha256` holds, for tests."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
