"""Phrase collocations from sorted count streams.

Texts are cut into pieces, pieces into words. Phrases of one, two and three words are
counted, combined in each Arrow slice before Spark adds them up by phrase. What is rare
cannot be part of a frequent phrase, so phrases of two words are counted only where
both words are frequent, and those of three only where both pairs are. Frequent
phrases of the length before are known in the tasks from a bitmap of fixed size; a
wrong bit costs a row that is dropped by its exact count later, never a phrase.

The frequent phrases form one stream, as in external estimation of language models.
In suffix order (last word first) a phrase stands behind its last word and its last two
words; in prefix order behind its first word and its first two. Ranges of the sorted
stream are walked in lockstep: each row takes the counts of the last shorter phrases
above it, and a pair keeps the largest count of the phrases below it, its extensions.
No table of phrases is built and nothing is looked up by hash. A range that begins
amid a group lacks what stands above; each range gives its last word and last pair,
and what it found for a pair begun before, so these tables have at most as many rows
as there are ranges.

Scores are exact decimals. The first phrases of a language are chosen in salted parts
first, so no language is one task.

Defined results: null text counts as empty, null lang as `und`; counts are per
language; repeated rows count each; texts of any length are read whole; empty tables
give no rows; columns other than text and lang are not read. Counts may reach 10^15.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerloom.llm.frames import map_arrow
from offerloom.llm.words import Words, mix, slices, texts_of, word_hashes, words_of
from offerloom.session import staged

LEAST = 10  # occurrences that make a candidate
SHARE = 50  # percent of a candidate's occurrences that lie in a longer one, to drop it
FIRST = 2000  # phrases returned per language
SLICE_BYTES = 1 << 22
OUT_ROWS = 1 << 16
BITMAP_BITS = 27  # 16 MB, whatever the input
SALTS = 64
BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?\n\x0b\x0c\r"]] = True
# A-Z in lower case; blanks and the ends of pieces become spaces
CUT = bytes(0x20 if b in b" \t" or BREAKS[b] else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_RNG = np.random.Generator(np.random.PCG64(90125))
_STEPS = _RNG.integers(0, 2**64, 3, dtype=np.uint64) | np.uint64(1)


def _slots(hashes: list[np.ndarray], lang: str) -> np.ndarray:
    """Bit of each phrase, given the hashes of its words."""
    seed = np.uint64(int.from_bytes(hashlib.blake2b(f"{len(hashes)} {lang}".encode(), digest_size=8).digest(), "little"))
    total = np.full(len(hashes[0]), seed)
    for h, step in zip(hashes, _STEPS):
        total += h * step
    return (mix(total) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of non-empty words."""
    raw, offsets = texts_of(words)
    return word_hashes(Words(raw, offsets[:-1], offsets[1:], offsets[:0]))


def _set(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bitmap[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, bytes, offsets) of slices of texts of one language."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        codes = langs.indices.to_numpy()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            raw, offsets = texts_of(batch.column(1).take(pa.array(np.flatnonzero(codes == k))))
            for a, b in slices(offsets, SLICE_BYTES, 1 << 14):
                yield lang, raw[offsets[a] : offsets[b]], offsets[a : b + 1]


def _rows(key: pa.Array, n: np.ndarray, lang: str) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(n), OUT_ROWS):
        # a phrase has no line feed, so the first one ends it
        part = pc.binary_join_element_wise(key.slice(i, OUT_ROWS), lang, "\n")
        yield pa.record_batch([part, pa.array(n[i : i + OUT_ROWS])], ["key", "n"])


def _count(batches: Iterator[pa.RecordBatch], order: int, bitmaps: list) -> Iterator[pa.RecordBatch]:
    """(key, n) of the phrases of `order` words whose parts may be frequent; the empty phrase counts all words."""
    flags = [np.frombuffer(b.value, np.uint8) for b in bitmaps]
    for lang, raw, offsets in _sliced(batches):
        cut = words_of(raw, offsets, CUT)
        if not len(cut.start):
            continue
        ends = np.concatenate([[0], np.cumsum(cut.end - cut.start)])
        data = pa.py_buffer(cut.low[cut.low != 0x20].tobytes())
        words = pa.Array.from_buffers(pa.large_string(), len(cut.start), [None, pa.py_buffer(ends), data])
        coded = words.cast(pa.string()).dictionary_encode()
        code, known = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        if order == 1:
            yield from _rows(known, np.bincount(code, minlength=len(known)), lang)
            yield pa.record_batch([pa.array(["\n" + lang]), pa.array([len(code)])], ["key", "n"])
            continue
        piece = np.searchsorted(np.flatnonzero(BREAKS[raw]), cut.start)
        text = np.searchsorted(cut.first, np.arange(len(code)), "right")
        hashes = _hashes(known)
        good = _set(flags[0], _slots([hashes], lang))[code]
        both = good[:-1] & good[1:] & (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        at = np.flatnonzero(both)
        pairs, which, n = np.unique(code[at] * len(known) + code[at + 1], return_inverse=True, return_counts=True)
        first, second = pairs // len(known), pairs % len(known)
        if order == 2:
            key = pc.binary_join_element_wise(known.take(pa.array(first)), known.take(pa.array(second)), " ")
            yield from _rows(key, n, lang)
            continue
        frequent = _set(flags[1], _slots([hashes[first], hashes[second]], lang))[which]
        at, which = at[frequent], which[frequent]
        begin = np.flatnonzero(at[1:] == at[:-1] + 1)
        triples, n = np.unique(which[begin] * len(known) + code[at[begin] + 2], return_counts=True)
        pair, third = triples // len(known), triples % len(known)
        parts = [known.take(pa.array(x)) for x in (first[pair], second[pair], third)]
        yield from _rows(pc.binary_join_element_wise(*parts, " "), n, lang)


def _bitmap(frequent: DataFrame) -> bytes:
    """The bits of frequent phrases (lang, phrase): 2^BITMAP_BITS of them, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            codes = langs.indices.to_numpy()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                phrases = batch.column(1).take(pa.array(np.flatnonzero(codes == k)))
                cut = pc.list_flatten(pc.split_pattern(phrases, " "))
                hashes = _hashes(cut).reshape(len(phrases), -1)
                yield pa.record_batch([pa.array(_slots(list(hashes.T), lang))], ["slot"])

    # the functions number bits from 1, 32,768 of them to a row
    bit = F.col("slot") + 1
    rows = (
        map_arrow(frequent.select("lang", "phrase"), run, "slot bigint")
        .groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
        .collect()
    )
    out = bytearray(1 << (BITMAP_BITS - 3))
    for r in rows:
        start = (r["bucket"] - 1) * 4096
        out[start : start + 4096] = r["bits"]
    return bytes(out)


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, w1, w2, w3, f) of all phrases of one to three words with f >= least, and (lang, n) of all words."""
    text = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    text = text.filter("text is not null")
    context = docs.sparkSession.sparkContext
    found, bitmaps = [], []
    for order in (1, 2, 3):
        if found:
            bitmaps.append(context.broadcast(_bitmap(found[-1].filter("phrase <> ''"))))
        given = list(bitmaps)
        counted = map_arrow(text, lambda batches, k=order, b=given: _count(batches, k, b), "key string, n bigint")
        counted = counted.groupBy("key").agg(F.sum("n").alias("f")).filter((F.col("f") >= least) | F.col("key").startswith("\n"))
        phrase = F.substring_index("key", "\n", 1)
        lang = F.expr("substr(key, instr(key, '\n') + 1)")
        found.append(staged(counted.select(lang.alias("lang"), phrase.alias("phrase"), "f"), f"phrases-{order}"))
    totals = found[0].filter("phrase = ''").select("lang", F.col("f").alias("n"))
    both = found[0].filter("phrase <> ''").unionByName(found[1]).unionByName(found[2])
    word = F.split("phrase", " ")
    return both.select("lang", "phrase", *[F.get(word, F.lit(k)).alias(f"w{k + 1}") for k in range(3)], "f"), totals


KEYS = ["lang", "k1", "k2", "k3"]
ROW, HEAD, LATE = 0, 1, 2


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k1, k2, k3, f, ...) of a sorted range with f(k1), f(k1 k2) and the largest f(k1 k2 x).

    0 stands for a count that is above the range. Behind the rows come the last row of
    one and of two words (HEAD), and the largest count below a pair begun above (LATE).
    """
    above = {1: 0, 2: 0}
    heads: dict[int, pa.RecordBatch] = {}
    held, most = None, 0  # the last pair, not given out until all below it is read
    late, late_most = None, 0

    def told(rows: pa.RecordBatch, one, two, most, kind: int) -> pa.RecordBatch:
        columns = [np.broadcast_to(np.asarray(x, np.int64), rows.num_rows) for x in (one, two, most, kind)]
        return pa.record_batch([*rows.columns, *map(pa.array, columns)], [*rows.schema.names, "one", "two", "most", "kind"])

    for batch in batches:
        if not batch.num_rows:
            continue
        f = batch.column("f").to_numpy()
        order = 1 + batch.column("k2").is_valid().to_numpy(zero_copy_only=False) + batch.column("k3").is_valid().to_numpy(zero_copy_only=False)
        place = np.arange(len(f))
        last_one = np.maximum.accumulate(np.where(order == 1, place, -1))
        last_two = np.maximum.accumulate(np.where(order == 2, place, -1))
        one = np.where(last_one >= 0, f[last_one], above[1])
        two = np.where(order == 3, np.where(last_two >= 0, f[last_two], above[2]), 0)
        starts = np.flatnonzero(order <= 2)
        below = np.where(order == 3, f, 0)
        top = int(below[: starts[0] if len(starts) else len(f)].max(initial=0))
        if held is not None:
            most = max(most, top)
        elif top:
            late, late_most = late or batch.slice(0, 1), max(late_most, top)
        if not len(starts):
            yield told(batch, one, two, 0, ROW)
            continue
        if held is not None:
            yield told(held[0], held[1], 0, most, ROW)
            held = None
        largest = np.zeros(len(f), np.int64)
        largest[starts] = np.maximum.reduceat(below, starts)
        keep = np.ones(len(f), bool)
        end = int(starts[-1])
        if order[end] == 2:
            held, most = (batch.slice(end, 1), one[end]), int(largest[end])
            keep[end] = False
        kept = batch.filter(pa.array(keep))
        yield told(kept, one[keep], two[keep], largest[keep], ROW)
        for k, last in ((1, int(last_one[-1])), (2, int(last_two[-1]))):
            if last >= 0:
                above[k], heads[k] = int(f[last]), batch.slice(last, 1)
    if held is not None:
        yield told(held[0], held[1], 0, most, ROW)
    for row in heads.values():
        yield told(row, 0, 0, 0, HEAD)
    if late is not None:
        yield told(late, 0, 0, late_most, LATE)


def lockstep(stream: DataFrame, name: str) -> DataFrame:
    """`stream` (lang, k1, k2, k3, f, ...) with one = f(k1), two = f(k1 k2) and most = largest f(k1 k2 x), 0 where there is none."""
    ordered = stream.repartitionByRange(*KEYS).sortWithinPartitions(*KEYS)
    schema = stream.schema.simpleString()[7:-1].replace(":", " ") + ", one bigint, two bigint, most bigint, kind bigint"
    walked = staged(map_arrow(ordered, _walk, schema), name)
    head, late = walked.filter(F.col("kind") == HEAD), walked.filter(F.col("kind") == LATE)
    # at most one row a range each
    ones = head.filter("k2 is null").select("lang", "k1", F.col("f").alias("_one"))
    twos = head.filter("k2 is not null").select("lang", "k1", "k2", F.col("f").alias("_two"))
    more = late.groupBy("lang", "k1", "k2").agg(F.max("most").alias("_most"))
    rows = walked.filter(F.col("kind") == ROW).join(F.broadcast(ones), ["lang", "k1"], "left")
    rows = rows.join(F.broadcast(twos), ["lang", "k1", "k2"], "left").join(F.broadcast(more), ["lang", "k1", "k2"], "left")
    pair = F.col("k2").isNotNull() & F.col("k3").isNull()
    return rows.select(
        *stream.columns,
        F.when(F.col("one") > 0, F.col("one")).otherwise(F.coalesce("_one", F.lit(0))).alias("one"),
        F.when((F.col("two") > 0) | F.col("k3").isNull(), F.col("two")).otherwise(F.coalesce("_two", F.lit(0))).alias("two"),
        F.when(pair, F.greatest("most", F.coalesce("_most", F.lit(0)))).otherwise(0).alias("most"),
    )


def candidates(stream: DataFrame) -> DataFrame:
    """(lang, w1, w2, w3, a, first, first_two, last, last_two, longer) of phrases of two and three words.

    `longer` is the largest count of a phrase that extends the candidate by a word on either side.
    """
    three, two = F.col("w3").isNotNull(), F.col("w2").isNotNull()
    turned = stream.select(
        "lang",
        F.coalesce("w3", "w2", "w1").alias("k1"),
        F.when(three, F.col("w2")).when(two, F.col("w1")).alias("k2"),
        F.when(three, F.col("w1")).alias("k3"),
        "f",
    )
    suffix = lockstep(turned, "suffix-order")
    three, two = F.col("k3").isNotNull(), F.col("k2").isNotNull()
    back = suffix.select(
        "lang",
        F.coalesce("k3", "k2", "k1").alias("k1"),
        F.when(three, F.col("k2")).when(two, F.col("k1")).alias("k2"),
        F.when(three, F.col("k1")).alias("k3"),
        "f",
        F.col("one").alias("last"),
        F.col("two").alias("last_two"),
        F.col("most").alias("before"),
    )
    prefix = lockstep(staged(back, "suffix-counts"), "prefix-order")
    return prefix.filter("k2 is not null").select(
        "lang",
        *[F.col(f"k{k}").alias(f"w{k}") for k in (1, 2, 3)],
        F.col("f").alias("a"),
        F.col("one").alias("first"),
        F.col("two").alias("first_two"),
        "last",
        "last_two",
        F.greatest("before", "most").alias("longer"),
    )


def _score(left: str, right: str) -> F.Column:
    a, b, c = (f"cast({x} as decimal(15, 0))" for x in ("a", left, right))
    return F.expr(f"(cast(1000000 as decimal(7, 0)) * ({a} * {a})) div ({b} * {c})")


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, first: int = FIRST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases by score, count and bytes."""
    stream, totals = frequent_phrases(docs, least)
    found = candidates(stream.drop("phrase"))
    found = found.filter(~((F.col("longer") > 0) & (100 * F.col("longer") >= share * F.col("a"))))
    pair = F.col("w3").isNull()
    early, late = _score("first", "last_two"), _score("first_two", "last")
    found = found.select(
        "lang", "w1", "w2", "w3", "a", "first", "first_two", "last", "last_two",
        F.when(pair, _score("first", "last")).alias("only"),
        F.when(~pair, early).alias("early"),
        F.when(~pair, late).alias("late"),
    )
    cut_late = F.coalesce(F.col("late") < F.col("early"), F.lit(False))
    scored = found.select(
        "lang",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        "a",
        F.when(cut_late, F.col("first_two")).otherwise(F.col("first")).alias("l"),
        F.when(pair | cut_late, F.col("last")).otherwise(F.col("last_two")).alias("r"),
        F.coalesce("only", F.least("early", "late")).alias("score"),
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    part = F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))
    scored = scored.withColumn("_part", part).filter(F.col("_part") <= first).drop("_part")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    best = scored.withColumn("rank", rank).filter(F.col("rank") <= first)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
