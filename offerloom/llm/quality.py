"""Quality classifier from weak labels.

Overlapping heuristic labellers vote junk, good or nothing on each document. How
often each pattern of votes occurs is counted over all documents; there are at most
3 to the power of the number of labellers patterns, whatever the corpus. Expectation
maximisation on these counts estimates how each labeller votes on junk and on good
documents. The posterior of a pattern labels its documents, and posterior labels
train a linear scorer over hashed word features, on a sample of at most `max_train`
documents (those with the smallest hashed ids). The scorer judges every document.

Defined results: a text without words (null too) gets score 0 and is not kept;
repeated rows get the same score, and rows that repeat an id are one of the sample; short texts lean towards the corpus; an empty
table gives an empty result, and a corpus without any junk or good label keeps
what its posterior says; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerloom.llm.frames import map_arrow
from offerloom.llm.words import NON_SPACE, slices, texts_of, word_hashes, words_of
from offerloom.session import staged

JUNK, GOOD = "j", "g"
NOTHING = "-"
MAX_TRAIN = 8_000
BUCKETS = 2_048
SHRINK = 5.0

# Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "the of and to in is that it for as was with be by on are this from "
    "der die und das von den ist ein eine im des für mit nicht zu "
    "le la les et de des un une du que qui dans est pour en au "
    "el los las y del se por con una su para es al lo como"
).split()


def _known() -> np.ndarray:
    text = " ".join(sorted({*FUNCTION_WORDS})).encode()
    raw = np.frombuffer(text, np.uint8)
    return np.unique(word_hashes(words_of(raw, np.array([0, len(raw)]), NON_SPACE)))


_KNOWN = _known()
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#$%&*@^~<>{}[]\\_=+|")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


@dataclass
class Facts:
    """What labellers and features need of some texts, per word and per text."""

    n: np.ndarray  # words per text
    owner: np.ndarray  # text of each word
    shares: dict[str, np.ndarray]
    features: np.ndarray  # (words, 3) buckets


def facts_of(raw: np.ndarray, offsets: np.ndarray, features: bool) -> Facts:
    words = words_of(raw, offsets, NON_SPACE)
    hashes, n = word_hashes(words), words.counts
    texts = len(n)
    owner = np.repeat(np.arange(texts), n)
    size = words.end - words.start
    last = raw[words.end - 1]
    before = raw[np.maximum(words.end - 2, words.start)]
    upto = np.concatenate([[0], np.cumsum(_UPPER[raw], dtype=np.int64)])
    upper = upto[words.end] - upto[words.start]
    marks = np.concatenate([[0], np.cumsum(_SYMBOL[raw], dtype=np.int64)])
    symbols = marks[words.end] - marks[words.start]
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    thrice = np.zeros(len(hashes), bool)
    thrice[2:] = again[2:] & again[1:-1]
    order = np.lexsort((hashes, owner))
    old = np.zeros(len(hashes), bool)
    old[1:] = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    known = _KNOWN[np.minimum(np.searchsorted(_KNOWN, hashes), len(_KNOWN) - 1)] == hashes
    doubled = (last == before) & _SYMBOL[last] & (size > 2)
    word_share = {
        "symbols": symbols / np.maximum(size, 1),
        "shouted": (upper * 2 > size) & (size > 1),
        "bang": last == ord("!"),
        "bars": (size == 1) & (last == ord("|")),
        "ends": (last == ord(".")) | (last == ord("?")),
        "again": again,
        "thrice": thrice,
        "old": old,  # said before in the text, counted in some order
        "doubled": doubled,
        "known": known,
    }
    least = np.maximum(n, 1)
    shares = {k: np.bincount(owner, weights=v, minlength=texts) / least for k, v in word_share.items()}
    buckets = np.zeros((0, 3), np.int64)
    if features:
        kind = (upper * 2 > size) * 8 + thrice * 4 + again * 2 + known
        length = np.minimum(np.log2(np.maximum(size, 1)).astype(np.int64), 7)
        shape = ((kind * 8 + length) * 4 + np.minimum(symbols, 3)) * 256 + last
        ending = last.astype(np.int64) * 256 + before + 1_000_003
        buckets = np.stack([_bucket(shape), _bucket(ending), _bucket(kind + 7_000_003)], axis=1)
    return Facts(n, owner, shares, buckets)


def _bucket(key: np.ndarray) -> np.ndarray:
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) % BUCKETS


# Each labeller: (share, words needed, junk from, good up to); a share that should be high is listed as negative.
LABELLERS = (
    ("symbols", 10, 0.15, 0.01),
    ("doubled", 5, 0.10, 0.005),
    ("shouted", 5, 0.30, 0.10),
    ("bang", 5, 0.20, 0.02),
    ("bars", 5, 0.10, 0.0),
    ("again", 5, 0.15, 0.05),
    ("thrice", 5, 0.10, 0.02),
    ("old", 30, 0.70, 0.55),
    ("known", 30, -0.01, -0.05),
    ("ends", 30, -0.005, -0.03),
)


def votes_of(facts: Facts) -> list[str]:
    """One letter per labeller for each text."""
    columns = []
    for share, needed, junk, good in LABELLERS:
        x = facts.shares[share] * (-1 if junk < 0 else 1)
        vote = np.where(x >= junk, JUNK, np.where(x <= good, GOOD, NOTHING))
        columns.append(np.where(facts.n < needed, NOTHING, vote))
    return ["".join(v) for v in zip(*columns)]


def _map_texts(docs: DataFrame, schema: str, work) -> DataFrame:
    """Per slice of texts: the ids and what `work(raw, offsets)` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = texts_of(batch.column(1))
            for a, b in slices(offsets):
                made = work(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield pa.record_batch([batch.column(0).slice(a, b - a), *made], names)

    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    whole = T.StructType([source.schema["doc_id"], *T.StructType.fromDDL(schema).fields])
    names = whole.names
    return map_arrow(source, run, whole)


def votes(docs: DataFrame) -> DataFrame:
    """(doc_id, votes)."""
    return _map_texts(docs, "votes string", lambda raw, at: [pa.array(votes_of(facts_of(raw, at, False)), pa.string())])


def estimate(counts: dict[str, int], rounds: int = 200) -> tuple[dict[str, float], list[dict]]:
    """Expectation maximisation: the posterior of good for each pattern, and each labeller's behaviour.

    A labeller's behaviour is the share of its votes on junk and on good documents
    that are right, and how often it votes at all; no vote counts as no evidence.
    """
    if not counts:
        return {}, []
    patterns = sorted(counts)
    weight = np.array([counts[p] for p in patterns], float)
    letters = np.array([[{JUNK: 0, NOTHING: 1, GOOD: 2}[c] for c in p] for p in patterns])
    given = np.stack([letters == v for v in range(3)]).astype(float)  # vote, pattern, labeller
    junk = given[0].sum(axis=1)
    # the start: labellers are better than chance, and overlap, so two junk votes are more than an accident
    q = np.select([junk >= 2, junk == 1], [0.05, 0.5], 0.95)
    for _ in range(rounds):
        mass = np.stack([1 - q, q]) * weight
        prior = (mass.sum(axis=1) + 1) / (mass.sum() + 2)
        table = np.einsum("yp,vpl->yvl", mass, given) + 0.1
        table /= table[:, [0, 2]].sum(axis=1, keepdims=True)
        table[:, 1] = 1  # no vote is no evidence
        score = np.log(prior)[:, None] + np.einsum("yvl,vpl->yp", np.log(table), given)
        new = 1 / (1 + np.exp(np.clip(score[0] - score[1], -50, 50)))
        done = np.abs(new - q).max() < 1e-9
        q = new
        if done:
            break
    behaviour = [
        {
            "labeller": name,
            "right_on_junk": float(table[0, 0, k]),
            "right_on_good": float(table[1, 2, k]),
            "votes": float(((letters[:, k] != 1) * weight).sum() / weight.sum()),
        }
        for k, (name, *_) in enumerate(LABELLERS)
    ]
    return dict(zip(patterns, q.tolist())), behaviour


@dataclass
class Scorer:
    """Weights per bucket and a bias; the score is the probability of good."""

    weights: np.ndarray
    bias: float

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        facts = facts_of(raw, offsets, True)
        own = self.weights[facts.features].sum(axis=1)
        total = np.bincount(facts.owner, weights=own, minlength=len(facts.n)) / (facts.n + SHRINK)
        return np.where(facts.n > 0, 1 / (1 + np.exp(-np.clip(total + self.bias, -50, 50))), 0.0)


def _rows_of_features(raw: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    """Each text's bucket counts over its words, as float32 bytes."""
    facts = facts_of(raw, offsets, True)
    texts = len(facts.n)
    cell = (facts.owner[:, None] * BUCKETS + facts.features).ravel()
    x = np.bincount(cell, minlength=texts * BUCKETS).reshape(texts, BUCKETS) / (facts.n + SHRINK)[:, None]
    return [pa.array([r.tobytes() for r in x.astype(np.float32)], pa.binary())]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, votes, cells, counts) from (doc_id, votes, x): the buckets that are not empty, as bytes of uint16 and float32."""
    for batch in batches:
        rows = [np.frombuffer(x.as_buffer(), np.float32) for x in batch.column(2)]
        cells = [np.flatnonzero(x).astype(np.uint16) for x in rows]
        columns = [[c.tobytes() for c in cells], [x[c].tobytes() for x, c in zip(rows, cells)]]
        yield pa.record_batch(
            [batch.column(0), batch.column(1), *[pa.array(c, pa.binary()) for c in columns]], ["doc_id", "votes", "cells", "counts"]
        )


def _dense(cells: pa.ChunkedArray, counts: pa.ChunkedArray) -> np.ndarray:
    """What `_packed` has packed, a row of `BUCKETS` float32 for each text."""
    out = np.zeros((len(cells), BUCKETS), np.float32)
    for row, at, x in zip(out, cells, counts):
        row[np.frombuffer(at.as_buffer(), np.uint16)] = np.frombuffer(x.as_buffer(), np.float32)
    return out


def train(features: np.ndarray, target: np.ndarray, steps: int = 400, decay: float = 1e-4) -> Scorer:
    """Logistic regression on soft labels by accelerated gradient steps; both labels weigh the same in all.

    `features` is standardised in place, and no copy of it is made: it is the most that the driver holds.
    """
    if not len(target):
        return Scorer(np.zeros(BUCKETS), 0.0)
    x = features
    middle = x.mean(axis=0)
    spread = np.concatenate([x[:, k : k + 64].std(axis=0) for k in range(0, x.shape[1], 64)]) + x.dtype.type(0.01)
    x -= middle
    x /= spread
    pull = np.where(target > 0.5, 0.5 / max(1e-9, target.sum()), 0.5 / max(1e-9, (1 - target).sum()))
    pull = (pull / pull.sum()).astype(np.float32)
    w, b, mw, mb = np.zeros(BUCKETS, np.float32), 0.0, np.zeros(BUCKETS, np.float32), 0.0
    length = np.concatenate([(part * part).sum(axis=1) for part in np.array_split(x, len(x) // 256 + 1)])
    rate = 4.0 / float((pull * length).sum() + 1)
    for k in range(steps):
        z = x @ w + b
        gap = pull * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target)
        gw, gb = x.T @ gap + decay * w, float(gap.sum())
        turn = k / (k + 3)
        mw_new, mb_new = w - rate * gw, b - rate * gb
        w, b = mw_new + turn * (mw_new - mw), mb_new + turn * (mb_new - mb)
        mw, mb = mw_new, mb_new
    weights = mw / spread
    return Scorer(weights.astype(np.float64), float(mb - weights @ middle))


def fit(docs: DataFrame, voted: DataFrame, max_train: int = MAX_TRAIN) -> tuple[Scorer, dict[str, float], list[dict]]:
    """The scorer, the posterior of each pattern, and the labellers' behaviour."""
    counts = {r["votes"]: r["count"] for r in voted.groupBy("votes").count().collect()}
    posterior, behaviour = estimate(counts)
    # hashes are even, so those up to here hold the sample and the sort sees a bounded number of ids
    share = min(1.0, (2 * max_train + 1_000) / max(1, sum(counts.values())))
    hashed = F.xxhash64("doc_id")
    sample = (
        voted.filter(F.col("doc_id").isNotNull() & (hashed <= min(2**63 - 1, int((share - 0.5) * 2**64))))
        .groupBy("doc_id")
        .agg(F.min("votes").alias("votes"))
        .orderBy(hashed, "doc_id")
        .limit(max_train)
    )
    chosen = F.broadcast(sample)  # at most max_train rows
    rows = _map_texts(docs.join(chosen, "doc_id", "left_semi"), "x binary", _rows_of_features)
    rows = rows.groupBy("doc_id").agg(F.min("x").alias("x")).join(chosen, "doc_id").select("doc_id", "votes", "x")
    packed = T.StructType([*rows.schema.fields[:2], T.StructField("cells", T.BinaryType()), T.StructField("counts", T.BinaryType())])
    # at most max_train rows, without their empty buckets
    held = map_arrow(rows, _packed, packed).toArrow().sort_by("doc_id")
    target = np.array([posterior[v] for v in held["votes"].to_pylist()], np.float32)
    features = _dense(held["cells"], held["counts"])
    del held
    return train(features, target), posterior, behaviour


def classify(docs: DataFrame, max_train: int = MAX_TRAIN, keep_from: float = 0.5) -> DataFrame:
    """(doc_id, votes, posterior, score, kept), one row per document."""
    scorer, posterior, _ = fit(docs, staged(votes(docs), "votes"), max_train)
    known = docs.sparkSession.sparkContext.broadcast((scorer, posterior))

    def work(raw: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        scorer, posterior = known.value
        own = votes_of(facts_of(raw, offsets, False))
        score = scorer.score(raw, offsets).round(6)
        chance = np.array([posterior.get(v, 0.5) for v in own]).round(6)
        return [pa.array(own, pa.string()), pa.array(chance), pa.array(score), pa.array(score >= keep_from)]

    return _map_texts(docs, "votes string, posterior double, score double, kept boolean", work)


def keep_good(docs: DataFrame, max_train: int = MAX_TRAIN, keep_from: float = 0.5) -> DataFrame:
    """The documents that the scorer keeps, all their columns as they were."""
    scorer, _, _ = fit(docs, staged(votes(docs), "votes"), max_train)
    known = docs.sparkSession.sparkContext.broadcast(scorer)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = texts_of(batch.column(batch.schema.get_field_index("text")))
            parts = [
                known.value.score(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for a, b in slices(offsets)
            ]
            yield batch.filter(pa.array(np.concatenate([np.zeros(0), *parts]) >= keep_from))

    return map_arrow(docs, keep, docs.schema)
