"""Merge-type piece vocabularies: encoding and decoding whole texts.

Encoding keeps an agenda of adjacent symbol pairs whose concatenation is a piece.
The best score is merged first, the leftmost pair on a tie, and each merge offers
its new neighbours to the agenda. Pieces hold the space mark only at their front
(looked up in the vocabulary), so marks cut a text into units that never merge
with each other, and so do line breaks and other characters that no piece holds; a task remembers the units it has met, in bounded memory. New
units are compared with the sentencepiece library, one call for each slice of an
Arrow batch, and a difference stops the job.

Defined results: null counts as empty, and an empty text has no ids and decodes
to an empty text; any length is encoded whole; repeated rows get a row each;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerloom.llm.frames import map_arrow
from offerloom.llm.words import slices, texts_of

MARK = "▁"
REMEMBERED = 48 << 20  # bytes of units in each of the two generations a process keeps
ENTRY = 220  # bytes that a remembered unit takes besides its ids
LONGEST = 48  # longer units are not remembered, and worked off one by one
_NEVER = np.int32(2**31 - 1)


class Pieces:
    """A vocabulary read from a model file's bytes."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        sp, size = self.library, self.library.get_piece_size()
        normal = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        # the agenda orders by falling score: rank 0 is the best one, equal scores share a rank
        scores = sorted({sp.get_score(i) for i in normal}, reverse=True)
        rank = {s: k for k, s in enumerate(scores)}
        self.id_of = {sp.id_to_piece(i): i for i in normal}
        self.rank_of = {sp.id_to_piece(i): rank[sp.get_score(i)] for i in normal}
        self.byte_id = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.unknown = sp.unk_id()
        splits = not any(MARK in piece.lstrip(MARK) for piece in self.id_of)
        # so does a control character that is in no piece
        self.breaks = "".join(c for c in map(chr, range(32)) if not any(c in piece for piece in self.id_of))
        b = re.escape(self.breaks)
        each = f"|[^{MARK}{b}]+|[{b}]" if b else ""
        self.unit = re.compile(f"{MARK}+[^{MARK}{b}]*{each}" if splits else "(?s).+")
        surface = [
            b"" if sp.is_control(i) else bytes([self.byte_of[i]]) if i in self.byte_of
            else " ⁇ ".encode() if i == self.unknown else sp.id_to_piece(i).replace(MARK, " ").encode()
            for i in range(size)
        ]
        self.surface = surface
        self.sizes = np.array([len(s) for s in surface], np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.sizes)])
        self.bytes = np.frombuffer(b"".join(surface), np.uint8)
        self.is_byte = np.array([i in self.byte_of for i in range(size)])
        self.is_control = np.array([sp.is_control(i) for i in range(size)])
        self.is_marked = np.array([sp.id_to_piece(i).startswith(MARK) for i in range(size)])
        self._table()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def merge(self, unit: str) -> list[str]:
        """The unit's symbols after all merges."""
        symbols: list = list(unit)
        rank_of, n = self.rank_of, len(symbols)
        agenda = []
        for i in range(n - 1):
            rank = rank_of.get(symbols[i] + symbols[i + 1])
            if rank is not None:
                agenda.append((rank, i, i + 1, symbols[i] + symbols[i + 1]))
        if not agenda:
            return symbols
        heapq.heapify(agenda)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            _, left, right, piece = heapq.heappop(agenda)
            # stale if either side has been merged since; both together have the piece's length only if not
            if not symbols[left] or not symbols[right] or after[left] != right or symbols[left] + symbols[right] != piece:
                continue
            symbols[left], symbols[right] = piece, None
            nxt = after[left] = after[right]
            if nxt < n:
                before[nxt] = left
                both = piece + symbols[nxt]
                rank = rank_of.get(both)
                if rank is not None:
                    heapq.heappush(agenda, (rank, left, nxt, both))
            prev = before[left]
            if prev >= 0:
                both = symbols[prev] + piece
                rank = rank_of.get(both)
                if rank is not None:
                    heapq.heappush(agenda, (rank, prev, left, both))
        return [s for s in symbols if s]

    def ids(self, unit: str) -> list[int]:
        out: list[int] = []
        for symbol in self.merge(unit):
            found = self.id_of.get(symbol)
            if found is not None:
                out.append(found)
            elif self.byte_id:
                out.extend(self.byte_id[b] for b in symbol.encode())
            else:
                out.append(self.unknown)
        return out

    def ids_of(self, units: list[str]) -> list[bytes]:
        """`ids` of many units as int32 bytes, their agendas worked off side by side."""
        out: list = [None] * len(units)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        for least, most in ((1, 6), (7, 10), (11, 16), (17, LONGEST)):
            own = np.flatnonzero((sizes >= least) & (sizes <= most)).tolist()
            for k, ids in zip(own, self._side_by_side([units[k] for k in own], most)):
                out[k] = ids
        return [np.array(self.ids(u), np.int32).tobytes() if o is None else o for u, o in zip(units, out)]

    def _side_by_side(self, units: list[str], width: int) -> list:
        """None for a unit with a character that is no piece."""
        n = len(units)
        if not n:
            return []
        points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.array([len(u) for u in units])
        begin = np.cumsum(sizes) - sizes
        known = self.char_id[np.minimum(points, len(self.char_id) - 1)]
        symbols = np.full((n, width + 1), -1, np.int32)
        row = np.repeat(np.arange(n), sizes)
        symbols[row, np.arange(len(points)) - np.repeat(begin, sizes)] = known
        strange = np.minimum.reduceat(known, begin) < 0
        ranks, merged = self._pairs(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
        ranks, merged = ranks.reshape(n, width), merged.reshape(n, width)
        left = sizes.copy()
        active = np.arange(n)
        S, R, M = symbols, ranks, merged
        column = np.arange(width)
        while len(active):
            best = R.argmin(axis=1)  # the leftmost of the best
            lines = np.arange(len(active))
            go = R[lines, best] < _NEVER
            symbols[active[~go]] = S[~go]
            active, S, R, M, best = active[go], S[go], R[go], M[go], best[go]
            if not len(active):
                break
            lines = np.arange(len(active))
            left[active] -= 1
            S[lines, best] = M[lines, best]
            tail = column[None, :] > best[:, None]
            S[:, :-1] = np.where(tail, S[:, 1:], S[:, :-1])
            S[:, -1] = -1
            R[:, :-1] = np.where(tail[:, :-1], R[:, 1:], R[:, :-1])
            M[:, :-1] = np.where(tail[:, :-1], M[:, 1:], M[:, :-1])
            R[:, -1] = _NEVER
            R[lines, best], M[lines, best] = self._pairs(S[lines, best], S[lines, best + 1])
            inner = np.flatnonzero(best > 0)
            at = best[inner] - 1
            R[inner, at], M[inner, at] = self._pairs(S[inner, at], S[inner, at + 1])
        flat = symbols[:, :-1][column[None, :] < left[:, None]].tobytes()
        ends = (np.cumsum(left) * 4).tolist()
        starts = [0, *ends[:-1]]
        return [None if s else flat[i:j] for s, i, j in zip(strange.tolist(), starts, ends)]

    def _table(self) -> None:
        """Hash table from (left id, right id) to the pair's rank and piece; ids of single characters."""
        pieces, rank_of = self.id_of, self.rank_of
        pairs = [
            (pieces[p[:k]], pieces[p[k:]], rank_of[p], i)
            for p, i in pieces.items()
            for k in range(1, len(p))
            if p[:k] in pieces and p[k:] in pieces
        ]
        chars = {ord(p): i for p, i in pieces.items() if len(p) == 1}
        self.char_id = np.full(max(chars, default=0) + 2, -1, np.int32)
        self.char_id[list(chars)] = list(chars.values())
        # a character that is only part of pieces has no id: units with one go through `merge`
        self.slots = 1 << max(12, (len(pairs) * 8).bit_length())
        self.keys = np.full(self.slots, -1, np.int64)
        self.values = np.zeros((self.slots, 2), np.int32)
        a = np.array(pairs, np.int64).reshape(-1, 4)
        keys, todo, self.probes = a[:, 0] << 32 | a[:, 1], np.arange(len(a)), 0
        while len(todo):
            slot = self._slot(keys[todo], self.probes)
            free = self.keys[slot] == -1
            first = np.zeros(len(todo), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.keys[slot[put]], self.values[slot[put]] = keys[todo[put]], a[todo[put], 2:]
            todo = todo[~put]
            self.probes += 1

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        spread = (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return ((spread + np.uint64(probe)) & np.uint64(self.slots - 1)).astype(np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair; _NEVER where it is no piece."""
        keys = left.astype(np.int64) << 32 | right
        keys[(left < 0) | (right < 0)] = -2
        rank, piece = np.full(len(keys), _NEVER, np.int32), np.zeros(len(keys), np.int32)
        todo = np.flatnonzero(keys >= 0)
        for probe in range(self.probes):
            slot = self._slot(keys[todo], probe)
            there = self.keys[slot]
            hit = there == keys[todo]
            rank[todo[hit]], piece[todo[hit]] = self.values[slot[hit], 0], self.values[slot[hit], 1]
            todo = todo[~hit & (there != -1)]
            if not len(todo):
                break
        return rank, piece

    def encode(self, texts: Sequence[str], check: bool = True) -> list[bytes]:
        """Ids of each text as int32 bytes."""
        cut = [self.unit.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        young, old = self.young, self.old
        missing = set(chain.from_iterable(cut)).difference(young)
        known = {u: old[u] for u in missing.intersection(old)}
        new = list(missing.difference(old))
        here = dict(zip(new, self.ids_of(new)))
        if check and new:
            self.compare(new, here)
        long = {u for u in new if len(u) > LONGEST}
        for part in (known, here):
            young.update(part)
            self.held += ENTRY * len(part) + sum(map(len, part.values()))
        out = [b"".join(map(young.__getitem__, units)) for units in cut]
        for u in long:
            self.held -= ENTRY + len(young.pop(u))
        if self.held > REMEMBERED:
            self.old, self.young, self.held = young, {}, 0
        return out

    def compare(self, units: list[str], ours: dict[str, bytes]) -> None:
        """Raise if the library encodes one of the units in another way.

        The library puts a mark before each text. Units without one follow a break
        here, so they are compared behind that break.
        """
        marked = [u for u in units if u[0] == MARK and u != MARK]
        rest = [u for u in units if u[0] != MARK] if self.breaks else []
        lead = self.breaks[:1]
        skip = len(self.library.encode(lead)) if rest else 0
        theirs = self.library.encode([u[1:] for u in marked], num_threads=1)
        theirs += [ids[skip:] for ids in self.library.encode([lead + u for u in rest], num_threads=1)]
        both = marked + rest
        own = [ours[u] for u in both]
        flat = np.fromiter(chain.from_iterable(theirs), np.int32)
        sizes = np.fromiter(map(len, own), np.int64) != 4 * np.fromiter(map(len, theirs), np.int64)
        if sizes.any() or b"".join(own) != flat.tobytes():
            u, ids = next((u, t) for u, t in zip(both, theirs) if ours[u] != np.array(t, np.int32).tobytes())
            raise ValueError(f"unit {u[:80]!r}: {np.frombuffer(ours[u], np.int32).tolist()} is not {ids}")

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of one sequence of ids, in UTF-8.

        The first piece gives up one leading mark. Runs of byte pieces are read as
        UTF-8; a byte that is none becomes U+FFFD.
        """
        out, run = [], bytearray()
        for i in ids.tolist():
            if i in self.byte_of:
                run.append(self.byte_of[i])
            else:
                out.append(_valid(bytes(run)))
                out.append(self.surface[i])
                run.clear()
        text = b"".join([*out, _valid(bytes(run))])
        return text[1:] if len(told := ids[~self.is_control[ids]]) and self.is_marked[told[0]] else text

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """`decode` of the sequences `ids[ends[i]:ends[i + 1]]`.

        All bytes are gathered at once. Pieces are whole characters, so the bytes
        are valid UTF-8 only if each run of byte pieces is.
        """
        sizes = self.sizes[ids]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        # from one byte to the next by one, from one piece to the next by a jump; control pieces have no bytes
        shown = np.flatnonzero(sizes)
        jump = self.places[:-1][ids[shown]]
        jump[1:] -= jump[:-1] + sizes[shown[:-1]] - 1
        step = np.ones(int(upto[-1]), np.int32)
        step[upto[:-1][shown]] = jump
        at = np.cumsum(step, dtype=np.int32)
        some = np.flatnonzero(ends[1:] > ends[:-1])
        marked = some[self.is_marked[ids[ends[some]]]]
        drop = np.zeros(len(ends) - 1, np.int64)
        drop[marked] = 1
        data = np.delete(self.bytes[at], upto[ends[marked]]).tobytes()
        try:
            if self.is_control[ids[ends[some]]].any():
                raise ValueError
            data.decode()
        except ValueError:
            return pa.array([self.decode(ids[i:j]).decode() for i, j in zip(ends[:-1], ends[1:])], pa.string())
        offsets = upto[ends] - np.concatenate([[0], np.cumsum(drop)])
        return pa.Array.from_buffers(pa.string(), len(drop), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def _valid(run: bytes) -> bytes:
    """`run` with each byte that is not part of a UTF-8 character replaced."""
    out, at = [], 0
    while at < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(run[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out).encode()


_loaded: dict[int, Pieces] = {}


def _pieces(model: bytes) -> Pieces:
    """The vocabulary of this task's process."""
    key = hash(model)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Pieces(model)
    return _loaded[key]


def encode(docs: DataFrame, model_file: str, check: bool = True) -> DataFrame:
    """(doc_id, ids array<int>, decoded string), one row per document.

    `model_file` is read once on the driver and broadcast (the size of a
    vocabulary, well under a megabyte here). `decoded` is made from the ids.
    """
    with open(model_file, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model.value)
        for batch in batches:
            _, offsets = texts_of(batch.column(1))
            for a, b in slices(offsets):
                texts = [t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]
                coded = pieces.encode(texts, check)
                ids = np.frombuffer(b"".join(coded), np.int32)
                ends = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])])
                yield pa.record_batch(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                        pieces.decode_all(ids, ends),
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
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
