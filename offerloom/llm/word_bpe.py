"""Vocabularies of pair merges with word ends: encoding and decoding whole texts in linear time.

A word is a sequence of base symbols, one per byte, the last one marked as a word's
end. Tokens that merging can produce are put into an Aho-Corasick automaton, and one
pass over the word finds the longest of them at every place. The encoder goes from
left to right with the longest match and keeps it if it may stand behind the token
before; else it tries the next shorter prefix that is a token, and where none is left
it takes the last token back and never enters that place again. So each place is
given up at most once, and the work is linear in the word's length.

Two tokens may stand side by side if merging both of their words together makes no
merge across the border. This is read from the merges: going back in time from the
finished pair, the younger of the two symbols at the border is undone, until a merge
of the two is found that came before either was merged away (then they may not), or
both are base symbols (then they may). Answers are kept in a table of bounded size. A
sequence whose neighbours all may stand so is the one that merging gives.

Decoding gathers the tokens' texts from one buffer by a table of offsets, joined by a
space, as the vocabulary names no other way.

Before that, special tokens are taken from the raw text, the rest is normalised (NFC,
lower case) and cut into letters, single digits and runs of other signs; white space
vanishes. Characters are compared once per process with the library's own rules, and a
text with one that differs, or not in NFC, is cut by the library.

Defined results: null counts as empty, and an empty text has no ids and decodes to an
empty text; any length is encoded whole; repeated rows get a row each; the type of
doc_id is the source's, null ids included; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerloom.llm.frames import map_arrow
from offerloom.llm.words import slices, texts_of

# The way of cutting that the vocabulary file names, and the same for texts that are ASCII.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
NORMAL = ["NFC", "Replace", "Lowercase"]
REMEMBERED = 32 << 20  # bytes of words in each of the two generations a process keeps
ENTRY = 250  # bytes that a remembered word takes besides its letters and ids
PAIRS = 1 << 18  # answers in the table of pairs before it starts anew
LONGEST = 64  # longer words are not remembered
NEVER = 1 << 60


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself if it is visible, else the next free one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Merges:
    """Tokens by number, the merge that made each, and which may stand side by side."""

    def __init__(self, base: Sequence[int], merges: Sequence[tuple[int, int, int]], size: int) -> None:
        """`base`: tokens that are single symbols; `merges`: (left, right, token) from first to last."""
        import ahocorasick

        self.left, self.right = [-1] * size, [-1] * size
        self.born = [NEVER] * size
        self.pair: dict[int, int] = {}
        self.text: list[str] = [""] * size
        for k, token in enumerate(base):
            self.born[token], self.text[token] = -1, chr(k + 1)
        for rank, (a, b, token) in enumerate(merges):
            if self.born[token] != NEVER or self.born[a] == NEVER or self.born[b] == NEVER:
                raise ValueError(f"merge {rank} is made twice or before its parts")
            self.left[token], self.right[token], self.born[token] = a, b, rank
            self.pair[a << 24 | b] = rank
            self.text[token] = self.text[a] + self.text[b]
        self.sizes = [len(t) for t in self.text]
        self.table: dict[int, bool] = {}
        # a token whose own symbols merge in another way never comes up
        made = [b == -1 for b in self.born]
        for a, b, token in merges:
            made[token] = made[a] and made[b] and self._apart(a, b, self.born[token])
        number = {self.text[t]: t for t in range(size) if made[t]}
        self.shorter = [-1] * size
        self.automaton = ahocorasick.Automaton()
        for text, token in number.items():
            self.automaton.add_word(text, token)
            self.shorter[token] = next((number[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in number), -1)
        self.automaton.make_automaton()

    def _apart(self, a: int, b: int, until: int = NEVER) -> bool:
        """Whether nothing merges across the border of `a` and `b` before the merge `until`."""
        born, pair = self.born, self.pair
        end_a = end_b = until
        while True:
            met = pair.get(a << 24 | b, NEVER)
            # of equal merges the left one comes first, so the right side's own merge is no obstacle at its rank
            if met < end_a and (met <= end_b if end_b < until else met < until):
                return False
            if born[a] < 0 and born[b] < 0:
                return True
            if born[a] >= born[b]:
                end_a, a = born[a], self.right[a]
            else:
                end_b, b = born[b], self.left[b]

    def tokens(self, symbols: str) -> list[int]:
        """The tokens of one word."""
        sizes, shorter, table = self.sizes, self.shorter, self.table
        n = len(symbols)
        longest = [-1] * n
        for end, token in self.automaton.iter(symbols):
            longest[end - sizes[token] + 1] = token  # ends come in rising order
        given_up = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            last = out[-1] if out else -1
            while token >= 0:
                if not given_up[at + sizes[token]]:
                    if last < 0:
                        break
                    key = last << 24 | token
                    apart = table.get(key)
                    if apart is None:
                        if len(table) >= PAIRS:
                            table.clear()
                        apart = table[key] = self._apart(last, token)
                    if apart:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += sizes[token]
                if at == n:
                    return out
                token = longest[at]
            else:
                if not out:
                    raise ValueError("a symbol is no token")
                given_up[at] = 1
                token = out.pop()
                at -= sizes[token]


class WordBpe:
    """A vocabulary read from a tokenizer file's bytes."""

    def __init__(self, data: bytes) -> None:
        import regex
        from tokenizers import Tokenizer

        told = json.loads(data)
        model, suffix = told["model"], told["model"]["end_of_word_suffix"]
        parts = told["pre_tokenizer"]["pretokenizers"]
        plain = (
            model["type"] == "BPE" and suffix and not model["continuing_subword_prefix"] and not model["ignore_merges"]
            and [n["type"] for n in told["normalizer"]["normalizers"]] == NORMAL
            and [p["type"] for p in parts] == ["Split", "ByteLevel"] and parts[0]["pattern"] == {"Regex": CUT}
            and told["decoder"] is None and not any(t["normalized"] for t in told["added_tokens"])
        )
        if not plain:
            raise ValueError("the file asks for another kind of tokenizer")
        self.library = Tokenizer.from_str(data.decode())
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.byte_of = _byte_letters()
        inner = {b: vocab[c] for c, b in self.byte_of.items()}
        final = {b: vocab[c + suffix] for c, b in self.byte_of.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges(
            [*(inner[b] for b in range(256)), *(final[b] for b in range(256))],
            [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs],
            size,
        )
        self.shift = {b: chr(b + 1) for b in range(256)}
        self.cut = regex.compile(CUT.replace(r"\s", r"\p{White_Space}"))
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        names = [b""] * size
        for name, token in (*vocab.items(), *self.special.items()):
            names[token] = name.encode()
        self.name_sizes = np.array([len(n) + 1 for n in names], np.int64)
        self.name_places = np.concatenate([[0], np.cumsum(self.name_sizes)])[:-1]
        self.names = np.frombuffer(b"".join(n + b" " for n in names), np.uint8)
        self.alike: set[str] = set(map(chr, range(128)))
        self.unlike: set[str] = set()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def ids(self, word: str) -> list[int]:
        """The tokens of one word, already normalised and cut."""
        raw = word.encode()
        # symbols 1 to 256 are bytes inside the word, 257 to 512 the last one
        return self.merges.tokens("".join(map(self.shift.__getitem__, raw[:-1])) + chr(raw[-1] + 257))

    def _own_words(self, text: str) -> list[str]:
        """Words of a text in NFC."""
        # one letter at a time, as the library does: no other form at a word's end
        low = text.replace("Σ", "σ").lower()
        return ASCII_CUT.findall(low) if low.isascii() else self.cut.findall(low)

    def _library_words(self, text: str) -> list[str]:
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, word)).decode() for word, _ in cut]

    def _same(self, char: str) -> bool:
        """Whether the library treats this character as `_own_words` does."""
        # unassigned here may be assigned there
        if unicodedata.category(char) in ("Cn", "Cs"):
            return False
        return all(self._own_words(t) == self._library_words(t) for t in (f"a{char}{char}", f"1{char}", f"!{char}a"))

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if not text.isascii():
            letters = set(text)
            for char in letters - self.alike - self.unlike:
                (self.alike if self._same(char) else self.unlike).add(char)
            if not letters.isdisjoint(self.unlike) or not unicodedata.is_normalized("NFC", text):
                return self._library_words(text)
        return self._own_words(text)

    def _parts(self, text: str) -> list:
        """Words, and the ids of special tokens as numbers."""
        if self.special_cut is None or "<" not in text:
            return self.words(text)
        out: list = []
        for k, part in enumerate(self.special_cut.split(text)):
            if k % 2:
                out.append(self.special[part])
            elif part:
                out += self.words(part)
        return out

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as int32 bytes."""
        cut = [self._parts(t) if t else [] for t in texts]
        young, old = self.young, self.old
        brief = []
        for part in set(chain.from_iterable(cut)).difference(young):
            known = old.get(part) if isinstance(part, str) else np.int32(part).tobytes()
            if known is None:
                known = np.array(self.ids(part), np.int32).tobytes()
            young[part] = known
            self.held += ENTRY + 5 * len(known)
            if isinstance(part, str) and len(part) > LONGEST:
                brief.append(part)
        out = [b"".join(map(young.__getitem__, parts)) for parts in cut]
        for part in brief:
            self.held -= ENTRY + 5 * len(young.pop(part))
        if self.held > REMEMBERED:
            self.old, self.young, self.held = young, {}, 0
        return out

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Texts of the sequences `ids[ends[i]:ends[i + 1]]`: names joined by a space."""
        sizes = self.name_sizes[ids]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        step = np.ones(int(upto[-1]), np.int32)
        # from one byte to the next by one, from one name to the next by a jump
        if len(ids):
            jump = self.name_places[ids].copy()
            jump[1:] -= self.name_places[ids[:-1]] + sizes[:-1] - 1
            step[upto[:-1]] = jump
        data = self.names[np.cumsum(step, dtype=np.int32)]
        some = np.flatnonzero(ends[1:] > ends[:-1])
        keep = np.ones(len(data), bool)
        keep[upto[ends[some + 1]] - 1] = False
        drop = np.zeros(len(ends) - 1, np.int64)
        drop[some] = 1
        offsets = upto[ends] - np.concatenate([[0], np.cumsum(drop)])
        return pa.Array.from_buffers(
            pa.string(), len(drop), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[keep].tobytes())]
        )


_loaded: dict[int, WordBpe] = {}


def _vocabulary(data: bytes) -> WordBpe:
    """The vocabulary of this task's process."""
    key = hash(data)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = WordBpe(data)
    return _loaded[key]


def encode(docs: DataFrame, vocabulary_file: str) -> DataFrame:
    """(doc_id, ids array<int>, decoded string), one row per document.

    `vocabulary_file` is read once on the driver and broadcast (the size of a
    vocabulary, under two megabytes here). `decoded` is made from the ids.
    """
    with open(vocabulary_file, "rb") as file:
        data = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _vocabulary(data.value)
        for batch in batches:
            _, offsets = texts_of(batch.column(1))
            for a, b in slices(offsets):
                coded = own.encode([t or "" for t in batch.column(1).slice(a, b - a).to_pylist()])
                ids = np.frombuffer(b"".join(coded), np.int32)
                ends = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])])
                yield pa.record_batch(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                        own.decode_all(ids, ends),
                    ],
                    ["doc_id", "ids", "decoded"],
                )

    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = T.StructType(
        [
            source.schema["doc_id"],
            T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
            T.StructField("decoded", T.StringType()),
        ]
    )
    return map_arrow(source, run, schema)


def report(coded: DataFrame) -> DataFrame:
    """The digest columns: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
