"""Words of whole Arrow batches as 64-bit hashes, without a Python step per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Words of more bytes are hashed one by one.
_LONG = 128


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_PLACES = _mix(np.arange(1, 257, dtype=np.uint64) * _ODD + np.uint64(23))
#: Bytes between words: space and the five controls 9 to 13.
_GAPS = np.zeros(256, bool)
_GAPS[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: For comparing passages, all ASCII but letters and digits also stands between words.
_MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


class Words:
    """Words of a text column: `hash` and `row` per word; `first` and `count` per row.

    `letters_only` splits at every ASCII character but letters and digits, otherwise at white
    space only. A-Z count as a-z. Null and empty texts have no words.
    """

    def __init__(self, column: pa.Array, letters_only: bool = False):
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1]
        lo, hi = (int(offsets[0]), int(offsets[-1])) if len(column) else (0, 0)
        raw = column.buffers()[2]
        data = _LOWER[np.frombuffer(raw, np.uint8)[lo:hi]] if hi > lo else np.empty(0, np.uint8)
        starts_of_rows = offsets.astype(np.int64) - lo
        inside = ~(_MARKS if letters_only else _GAPS)[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        edges = starts_of_rows[:-1]
        edges = edges[edges < len(data)]
        begins[edges] |= inside[edges]
        before = edges[edges > 0] - 1
        ends[before] |= inside[before]
        begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.begin, self.end = begin, end
        self.hash = self._hash(data, begin, end)
        self.row = np.searchsorted(starts_of_rows, begin, side="right") - 1
        self.count = np.bincount(self.row, minlength=len(column)).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.count)[:-1])) if len(column) else self.count

    @staticmethod
    def _hash(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Eight bytes at a time are mixed into all words at once; nothing about it is linear."""
        size = end - begin
        out = _mix(size.astype(np.uint64) + _ODD)
        padded = np.concatenate((data, np.zeros(8, np.uint8)))
        eight = np.ndarray(len(data) + 1, "<u8", padded, 0, (1,))
        left = np.flatnonzero(size <= _LONG)
        at = 0
        while len(left):
            rest = np.minimum(size[left] - at, 8).astype(np.uint64)
            part = eight[begin[left] + at] & (~np.uint64(0) >> (np.uint64(64) - rest * np.uint64(8)))
            out[left] = _mix((out[left] ^ part) * _ODD + np.uint64(at + 1))
            at += 8
            left = left[size[left] > at]
        for i in np.flatnonzero(size > _LONG):
            out[i] = xxhash.xxh3_64_intdigest(data[begin[i] : end[i]])
        return out

    def runs(self, length: int) -> np.ndarray:
        """Hash of the run at each word; runs that cross rows are to be left out by the caller.

        A row with exactly fewer words than a shingle has the hash of its run of that length, so
        short sequences can be looked up inside longer rows.
        """
        full = max(0, len(self.hash) - length + 1)
        acc = np.full(full, length, np.uint64)
        for j in range(length):
            acc += self.hash[j : j + full] * _PLACES[j]
        return _mix(acc)

    def shingles(self, n: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of each run of n words; rows with fewer give their whole sequence once."""
        rows, hashes = [], []
        full = max(0, len(self.hash) - n + 1)
        same = self.row[:full] == self.row[n - 1 : n - 1 + full]
        rows.append(self.row[:full][same])
        hashes.append(self.runs(n)[same])
        for k in range(1, n if short else 1):
            few = np.flatnonzero(self.count == k)
            rows.append(few)
            hashes.append(self.runs(k)[self.first[few]])
        return np.concatenate(rows), np.concatenate(hashes)


def distinct(rows: np.ndarray, hashes: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash), by row and hash, as (bounds per row, hashes)."""
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    rows, hashes = rows[new], hashes[new]
    bounds = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=n_rows))))
    return bounds, hashes
