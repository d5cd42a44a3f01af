"""SentencePiece BPE with byte fallback: vectorised merge rounds over flat arrays.

A text is escaped (a leading mark, spaces as marks) and falls into words that begin with marks;
words also part wherever two neighbouring characters occur together in no piece, as nothing can
be merged there. The words a batch has not met before are laid out as one flat numpy array of
symbols. A round looks up the rank of every pair of neighbours, takes the smallest per word by a
segmented minimum, merges all its leftmost non-overlapping places at once, and compacts the array;
words without a pair left drop out. Merging at once equals merging one by one unless a merge makes
a pair that goes before the next place (pieces of equal score, such as runs of spaces, do that);
the rest of such a word is merged pair by pair from a heap.

Null text counts as empty: no ids but the end id. Repeated rows and null keys give a row each, and
of other columns none is read. Memory follows the batch and the longest stretch that nothing
parts. Models with normalisation rules, user-defined or unused pieces are refused.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from .common import map_batches, record, slices

MARK = "▁"
_NONE = np.iinfo(np.int32).max
#: Symbols that one round of merges holds at most, unless one word alone is longer.
_FLAT = 1 << 20
_KEPT_WORDS, _LONG_WORD = 300_000, 40
_models: dict = {}


class Lookup:
    """Places of 64-bit keys, many at a time: open addressing in flat arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys, self.at = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        left, cell = np.arange(len(keys)), self._cells(keys)
        while len(left):
            free = self.keys[cell] < 0
            taken = np.flatnonzero(free)
            self.keys[cell[taken]] = keys[left[taken]]  # of several in one cell one stays
            placed = self.keys[cell] == keys[left]
            self.at[cell[placed]] = left[placed]
            left, cell = left[~placed], (cell[~placed] + 1) & ((1 << self.bits) - 1)

    def _cells(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where it is missing."""
        cell = self._cells(wanted)
        seen = self.keys[cell]
        out = np.where(seen == wanted, self.at[cell], -1)
        rest = np.flatnonzero((seen != wanted) & (seen >= 0))
        while len(rest):
            cell[rest] = (cell[rest] + 1) & ((1 << self.bits) - 1)
            seen = self.keys[cell[rest]]
            hit = seen == wanted[rest]
            out[rest[hit]] = self.at[cell[rest[hit]]]
            rest = rest[~hit & (seen >= 0)]
        return out


class Pieces:
    """A model's pieces as lookup arrays, with the words encoded so far."""

    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = library.get_piece_size()
        probe = " ﬁ①  Á\t x "
        if library.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("models that normalise text are not supported")
        self.end = library.eos_id()
        self.control = {i for i in range(size) if library.is_control(i)}
        self.unknown = library.unk_id()
        pieces = [library.id_to_piece(i) for i in range(size)]
        byte = {i: int(pieces[i][3:5], 16) for i in range(size) if library.is_byte(i)}
        if len(byte) != 256:
            raise ValueError("models without byte fallback are not supported")
        if any(library.is_unused(i) for i in range(size)):
            raise ValueError("models with unused pieces are not supported")
        self.byte = byte
        plain = {
            p: i for i, p in enumerate(pieces) if i not in self.control and i not in byte and i != self.unknown
        }
        score = np.array([library.get_score(i) for i in range(size)])
        self.text = [
            "" if i in self.control or i in byte else p.replace(MARK, " ") for i, p in enumerate(pieces)
        ]
        self.raw = [bytes([byte[i]]) if i in byte else t.encode() for i, t in enumerate(self.text)]

        def symbol(p: str) -> int | None:
            return plain.get(p, size + ord(p) if len(p) == 1 else None)

        # A pair's rank is that of the piece it makes, however that piece is put together.
        rank = dict(enumerate(np.unique(-score, return_inverse=True)[1].tolist()))
        self.pairs = pairs = {}
        beside = set()
        for p, i in plain.items():
            beside.update(zip(map(symbol, p), map(symbol, p[1:])))
            for cut in range(1, len(p)):
                left, right = symbol(p[:cut]), symbol(p[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = (rank[i], i)
        self.pair_at = Lookup(np.array(list(pairs), np.int64))
        made = pairs.values()
        self.pair_rank = np.array([r for r, _ in made], np.int32)
        self.pair_makes = np.array([i for _, i in made], np.int64)
        self.beside_at = Lookup(np.array([a << 32 | b for a, b in beside], np.int64))
        self.of_char = np.arange(0x110000, dtype=np.int64) + size
        for p, i in plain.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        marks_lead = not any(MARK in p.lstrip(MARK) for p in plain)
        self.words = re.compile(f"{MARK}+[^{MARK}]*" if marks_lead else "(?s).+").findall
        self.size = size
        self.of_byte = np.array(sorted(byte, key=byte.__getitem__))
        self.known: dict[str, bytes] = {}

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.pair_at(left << 32 | right)
        return np.where(at >= 0, self.pair_rank[at], _NONE), np.where(at >= 0, self.pair_makes[at], -1)

    def merge(self, text: str, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per word) of words of the given lengths that stand in one string."""
        symbol = self.of_char[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        begins = np.zeros(len(symbol), bool)
        begins[np.concatenate(([0], np.cumsum(lengths)[:-1]))] = True
        word = np.cumsum(begins) - 1
        begins[1:] |= self.beside_at(symbol[:-1] << 32 | symbol[1:]) < 0
        first = np.flatnonzero(begins)
        live = np.ones(len(symbol), bool)
        at = 0
        while at < len(first):
            upto = max(at + 1, int(np.searchsorted(first, first[at] + _FLAT, side="right")) - 1)
            end = int(first[upto]) if upto < len(first) else len(symbol)
            self._rounds(symbol, live, begins, int(first[at]), end)
            at = upto
        symbol, word = symbol[live], word[live]
        return self._with_bytes(symbol, word, len(lengths))

    def _rounds(self, out: np.ndarray, live: np.ndarray, begins: np.ndarray, lo: int, hi: int) -> None:
        """Merges out[lo:hi] in place; `live` marks the places that keep a symbol."""
        place = np.arange(lo, hi)
        symbol, part = out[lo:hi].copy(), np.cumsum(begins[lo:hi])
        rank, makes = np.full(hi - lo, _NONE, np.int32), np.full(hi - lo, -1)
        inner = np.flatnonzero(part[1:] == part[:-1])
        rank[inner], makes[inner] = self._look(symbol[inner], symbol[inner + 1])
        while len(symbol):
            first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            sizes = np.diff(np.append(first, len(symbol)))
            least = np.minimum.reduceat(rank, first)
            busy = np.repeat(least < _NONE, sizes)
            if not busy.all():  # words without a pair are done
                out[place[~busy]] = symbol[~busy]
                least, sizes = least[least < _NONE], sizes[least < _NONE]
                place, symbol, part, rank, makes = place[busy], symbol[busy], part[busy], rank[busy], makes[busy]
                if not len(symbol):
                    return
            lowest = np.repeat(least, sizes)
            hit = np.flatnonzero(rank == lowest)
            # Of places that overlap in a row, every second one from the left.
            head = np.flatnonzero(np.append(True, np.diff(hit) > 1))
            nth = np.arange(len(hit)) - np.repeat(head, np.diff(np.append(head, len(hit))))
            take = hit[nth % 2 == 0]
            early = self._early(symbol, part, lowest, makes, take)
            if len(early):
                for p in np.unique(early):
                    a, b = np.searchsorted(part, (p, p + 1))
                    stays, merged = self._one_by_one(symbol[a:b].tolist())
                    live[place[a:b]] = False
                    live[place[a:b][stays]] = True
                    out[place[a:b][stays]] = merged
                rest = ~np.isin(part, early)
                place, symbol, part, rank, makes = place[rest], symbol[rest], part[rest], rank[rest], makes[rest]
                continue
            live[place[take + 1]] = False
            symbol[take] = makes[take]
            keep = np.ones(len(symbol), bool)
            keep[take + 1] = False
            changed = np.zeros(len(symbol), bool)
            changed[take] = True
            place, symbol, part, rank, makes, changed = (
                v[keep] for v in (place, symbol, part, rank, makes, changed)
            )
            changed[:-1] |= changed[1:]
            changed = np.flatnonzero(changed)
            rank[changed], makes[changed] = _NONE, -1
            changed = changed[changed < len(symbol) - 1]
            changed = changed[part[changed] == part[changed + 1]]
            rank[changed], makes[changed] = self._look(symbol[changed], symbol[changed + 1])

    def _early(self, symbol, part, lowest, makes, take) -> np.ndarray:
        """Words in which merging one place makes a pair that goes before the word's next place."""
        again = np.flatnonzero(part[take[1:]] == part[take[:-1]])  # followed by a further place
        if not len(again):
            return again
        at = take[again]
        made = makes[at]
        right, _ = self._look(made, symbol[at + 2])
        before = np.maximum(at - 1, 0)
        taken = np.zeros(len(symbol), bool)
        taken[take] = True
        joined = (at > 1) & taken[at - 2]  # its left neighbour is a merged pair by then
        left, _ = self._look(np.where(joined, makes[np.maximum(at - 2, 0)], symbol[before]), made)
        left = np.where((at > 0) & (part[before] == part[at]), left, _NONE)
        return part[at[np.minimum(left, right) <= lowest[at]]]

    def _one_by_one(self, symbol: list[int]) -> tuple[list[int], list[int]]:
        """(places that stay, their symbols): the smallest rank first, then the leftmost, from a heap.

        Runs of spaces need this: their pieces share one score, so the leftmost grows on and on.
        """
        n = len(symbol)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []

        def offer(i: int, j: int) -> None:
            found = self.pairs.get(symbol[i] << 32 | symbol[j])
            if found:
                heapq.heappush(heap, (found[0], i, j, symbol[i], symbol[j], found[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, left, right, made = heapq.heappop(heap)
            if after[i] != j or symbol[i] != left or symbol[j] != right:
                continue
            symbol[i], symbol[j], after[i] = made, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
                offer(i, after[j])
            if before[i] >= 0:
                offer(before[i], i)
        stays = [i for i, s in enumerate(symbol) if s >= 0]
        return stays, [symbol[i] for i in stays]

    def _with_bytes(self, symbol: np.ndarray, word: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece become their bytes."""
        other = np.flatnonzero(symbol >= self.size)
        if len(other):
            chars = [chr(c).encode() for c in (symbol[other] - self.size).tolist()]
            times = np.ones(len(symbol), np.int64)
            times[other] = [len(c) for c in chars]
            first = np.cumsum(times) - times
            spread = np.repeat(symbol, times)
            word = np.repeat(word, times)
            own = np.repeat(first[other], times[other])
            own += np.arange(len(own)) - np.repeat(np.cumsum(times[other]) - times[other], times[other])
            spread[own] = self.of_byte[np.frombuffer(b"".join(chars), np.uint8)]
            symbol = spread
        return symbol.astype(np.int32), np.bincount(word, minlength=n_words)

    def encode(self, texts: list[str], end: bool) -> list[bytes]:
        """Per text its ids as little-endian 32-bit integers."""
        known = self.known
        split = [self.words(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = list(set().union(*split).difference(known))
        if new:
            ids, n = self.merge("".join(new), np.array(list(map(len, new))))
            packed, at = ids.tobytes(), 0
            for w, count in zip(new, n.tolist()):
                known[w] = packed[4 * at : 4 * (at + count)]
                at += count
        tail = self.end.to_bytes(4, "little") if end else b""
        out = [b"".join(map(known.__getitem__, ws)) + tail for ws in split]
        for w in new:
            if len(w) > _LONG_WORD:
                del known[w]
        if len(known) > _KEPT_WORDS:
            known.clear()
        return out

    def decode(self, ids: list[int]) -> str:
        """As the library decodes: one leading space of the first piece goes, broken bytes become U+FFFD."""
        lead = next((i for i in ids if i not in self.control), None)
        if lead is None:
            return ""
        strip = lead not in self.byte and lead != self.unknown and self.text[lead].startswith(" ")
        if self.unknown in ids or not self.control.isdisjoint(ids[:-1]):
            return self._piecewise(ids, strip)
        try:
            text = b"".join(map(self.raw.__getitem__, ids)).decode()
        except UnicodeDecodeError:
            return self._piecewise(ids, strip)
        return text[1:] if strip else text

    def _piecewise(self, ids: list[int], strip: bool) -> str:
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte:
                run.append(self.byte[i])
                continue
            out.append(_characters(bytes(run)))
            run.clear()
            out.append(" ⁇ " if i == self.unknown else self.text[i])
        out.append(_characters(bytes(run)))
        text = "".join(out)
        return text[1:] if strip else text


def _characters(raw: bytes) -> str:
    """Bytes as text; each byte that begins no whole character becomes U+FFFD by itself."""
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            n = 1
        at += n
    return "".join(out)


def pieces_of(model: bytes) -> Pieces:
    key = hash(model)
    if key not in _models:
        _models[key] = Pieces(model)
    return _models[key]


def lists(packed: list[bytes]) -> pa.ListArray:
    flat = np.frombuffer(b"".join(packed), np.int32)
    bounds = np.concatenate(([0], np.cumsum([len(p) // 4 for p in packed]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat, pa.int32()))


def encode(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", end: bool = False) -> DataFrame:
    """(key, ids array<int>) per row. `model_path` names a file on the driver (below 1 MB); tasks get its content."""
    with open(model_path, "rb") as f:
        model = f.read()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = pa.schema([("key", to_arrow_type(rows.schema["key"].dataType)), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces_of(model)
        for batch in batches:
            for part in slices(batch, "text"):
                yield record(schema, part.column(0), lists(coder.encode(part.column("text").to_pylist(), end)))

    kind = rows.schema["key"].dataType.simpleString()
    return map_batches(rows, run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(encoded: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """Adds `decoded`, the text of the ids (a column of that name is replaced). Null ids give ''."""
    with open(model_path, "rb") as f:
        model = f.read()
    encoded = encoded.drop("decoded")
    arrow = pa.schema([*to_arrow_schema(encoded.schema), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces_of(model)
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                texts = [coder.decode(row or []) for row in part.column(at).to_pylist()]
                yield record(arrow, *part.columns, texts)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return map_batches(encoded, run, f"{schema}, decoded string")
