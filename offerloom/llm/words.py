"""Words and shingles of whole texts as numpy arrays, for use inside Arrow tasks.

Nothing here touches Spark. Texts stay UTF-8 bytes; a word is a maximal run of
word bytes, so the work is a handful of vector operations per byte and no Python
object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts are handled in slices of about this size; a longer text is one slice
_SPACE = 0x20


def _lower(byte: int) -> int:
    return byte + 32 if 0x41 <= byte <= 0x5A else byte


def _table(is_word) -> bytes:
    return bytes(_lower(b) if is_word(_lower(b)) else _SPACE for b in range(256))


# Both lower-case A-Z and turn every byte outside words into a space.
ALNUM = _table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
NON_SPACE = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)

_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE_CODE = _RNG.integers(1, 2**64, 256, dtype=np.uint64)
_BYTE_CODE[_SPACE] = 0
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_ORDER = _RNG.integers(1, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_SHORT = _RNG.integers(1, 2**64, 64, dtype=np.uint64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(which: str, n: int) -> np.ndarray:
    """Powers 0..n-1 of the step (or of its inverse) modulo 2**64."""
    if len(_powers[which]) < n:
        base = np.full(max(n, CHUNK_BYTES + 1), _STEP if which == "up" else _STEP_BACK, np.uint64)
        base[0] = 1
        _powers[which] = np.multiply.accumulate(base)
    return _powers[which][:n]


def forget() -> None:
    """Drop the powers, which grow with the longest text met."""
    for which in _powers:
        _powers[which] = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit sums so that every bit depends on every input bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = CHUNK_BYTES, most: int = 1024) -> Iterator[tuple[int, int]]:
    """Ranges of at most `most` rows that hold about `size` bytes; one row at least."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1, first + 1)
        last = min(last, first + most)
        yield first, min(last, rows)
        first = min(last, rows)


@dataclass
class Words:
    """The words of some texts: byte ranges in `low`, and where each text's words begin."""

    low: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # per text, and the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def word(self, i: int) -> bytes:
        return self.low[self.start[i] : self.end[i]].tobytes()

    def text(self, i: int, j: int) -> bytes:
        """Words i to j - 1, joined by a space."""
        return b" ".join(self.word(k) for k in range(i, j))


def words_of(raw: np.ndarray, offsets: np.ndarray, table: bytes) -> Words:
    """Words of the texts `raw[offsets[i]:offsets[i + 1]]`; a text's end ends a word."""
    low = np.frombuffer(raw.tobytes().translate(table), np.uint8)
    inside = low != _SPACE
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets - offsets[0]] = True
    begins, ends = inside.copy(), inside.copy()
    if len(low):
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(low, start, end, np.searchsorted(start, offsets - offsets[0]))


def word_hashes(words: Words) -> np.ndarray:
    """64-bit hashes of the words."""
    if not len(words.start):
        return np.zeros(0, np.uint64)
    code = _BYTE_CODE[words.low] * _power("up", len(words.low))
    total = np.add.reduceat(code, words.start)
    return mix(total * _power("down", len(words.low))[words.start])


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` words from each position on; the caller drops those that cross a text's end."""
    out = np.zeros(max(0, len(hashes) - length + 1), np.uint64)
    for j in range(length):
        out += hashes[j : j + len(out)] * _ORDER[j]
    return mix(out + _SHORT[length])


def shingles(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first per text) of all shingles, repeats included.

    A text of fewer words, but not none, has its whole sequence as one shingle.
    """
    hashes, counts = word_hashes(words), words.counts
    number = np.where(counts >= length, counts - length + 1, (counts > 0).astype(counts.dtype))
    first = np.concatenate([[0], np.cumsum(number)])
    whole = window_hashes(hashes, length)
    begin = np.repeat(words.first[:-1] - first[:-1], number) + np.arange(first[-1])
    out = whole[np.minimum(begin, len(whole) - 1)] if len(whole) else np.zeros(first[-1], np.uint64)
    for n in range(1, length):
        texts = np.flatnonzero(counts == n)
        if len(texts):
            out[first[texts]] = window_hashes(hashes, n)[words.first[texts]]
    return out, first


def distinct_sets(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of each text, and where each text's begin."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, owner)) if len(hashes) else np.zeros(0, np.int64)
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    owner = owner[new]
    return hashes[new], np.searchsorted(owner, np.arange(len(first)))
