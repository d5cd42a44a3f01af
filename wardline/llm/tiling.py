"""Benchmark decontamination by greedy string tiling.

Words (lower case, split at all ASCII but letters and digits) become 64-bit tokens. Runs of
`SEED` tokens that a document shares with a benchmark item are seeds; where the seeds of an item
cover enough of it, the pair is tiled: the longest common runs that overlap no earlier tile are
marked again and again, found by running Karp-Rabin hashes over unmarked stretches, down to
`SEED` tokens. Tiles may lie in any order, so reordered passages count. An item is leaked where
its tiles cover at least `COVERAGE` of its tokens, and a document with a leaked item is bad.

The item seeds' bitmap has a fixed size (512 KB) and only thins out what a document sends on; seeds
then meet in a join. Every tile lies within seeds, so seed coverage bounds tile coverage from
above and no leak is lost. Items with fewer tokens than a seed must occur as a whole. Null and
empty texts leak nothing, on either side. Repeated documents give a row each, repeated items
count once; items with a null id count and are listed as null. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CELLS, bitmap, map_batches, record, slices, stored
from .words import Words

SEED = 4
COVERAGE = 0.8
_MOD, _RADIX = (1 << 61) - 1, 1_000_003


class _Side:
    """One token sequence with the running hash of its prefixes and its marks."""

    def __init__(self, tokens: list[int]):
        self.tokens, self.marks = tokens, bytearray(len(tokens))
        self.hash, self.power = [0], [1]
        for x in tokens:
            self.hash.append((self.hash[-1] * _RADIX + x) % _MOD)
            self.power.append(self.power[-1] * _RADIX % _MOD)

    def run(self, at: int, size: int) -> int:
        return (self.hash[at + size] - self.hash[at] * self.power[size]) % _MOD

    def free(self, at: int) -> int:
        """The first unmarked place from `at` on."""
        found = self.marks.find(0, at)
        return len(self.marks) if found < 0 else found

    def marked(self, at: int) -> int:
        found = self.marks.find(1, at)
        return len(self.marks) if found < 0 else found

    def windows(self, size: int) -> Iterator[tuple[int, int | None]]:
        """(start, token before it if that is unmarked) of every unmarked run of `size`."""
        at = self.free(0)
        while at < len(self.tokens):
            end = self.marked(at)
            for i in range(at, end - size + 1):
                yield i, self.tokens[i - 1] if i > at else None
            at = self.free(end)


def _extent(a: _Side, b: _Side, p: int, t: int) -> int:
    """How far the unmarked runs from p and t agree: doubling steps, then halving ones."""
    most, k, step, growing = min(a.marked(p) - p, b.marked(t) - t), 0, 1, True
    while step and k < most:
        n = min(step, most - k)
        if a.run(p + k, n) == b.run(t + k, n):
            k, step = k + n, step * 2 if growing else step // 2
        else:
            growing, step = False, (1 << (n - 1).bit_length()) // 2 if n > 1 else 0
    return k


def _matches(a: _Side, b: _Side, size: int) -> Iterator[tuple[int, int, int]]:
    """Common unmarked runs of `size` or more that cannot grow to the left, as (-length, p, t).

    Places of a window are kept by the token before them, so runs that could grow are not listed:
    two texts that repeat one word have as many matches as tokens, not as pairs of tokens.
    """
    table: dict[int, dict] = {}
    for t, before in b.windows(size):
        table.setdefault(b.run(t, size), {}).setdefault(before, []).append(t)
    for p, before in a.windows(size):
        for other, places in table.get(a.run(p, size), {}).items():
            if before is None or other != before:
                for t in places:
                    k = _extent(a, b, p, t)
                    if k >= size:
                        yield -k, p, t


def tiles(pattern: list[int], text: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (length, p, t): the longest first, then the earliest in pattern and text.

    Matches wait in a queue by length. One that meets marks by its turn goes back as the runs that
    are left of it, so nothing is scanned again for each tile.
    """
    a, b, out = _Side(pattern), _Side(text), []
    size = max(least, 16)
    while True:
        queue = list(_matches(a, b, size))
        heapq.heapify(queue)
        while queue and a.free(0) < len(pattern):
            k, p, t = heapq.heappop(queue)
            k, i = -k, 0
            if a.marked(p) >= p + k and b.marked(t) >= t + k:
                a.marks[p : p + k] = b.marks[t : t + k] = b"\1" * k
                out.append((k, p, t))
                continue
            while i < k:
                begin = max(a.free(p + i) - p, b.free(t + i) - t)
                if begin > i:
                    i = begin
                    continue
                end = min(k, a.marked(p + i) - p, b.marked(t + i) - t)
                if end - i >= size:
                    heapq.heappush(queue, (i - end, p + i, t + i))
                i = end
        if size == least:
            return out
        size = max(least, size // 2)


def coverage(item: list[int], text: list[int]) -> float:
    """Share of the item's tokens that tiles cover; 0 in `text` parts stretches that do not touch."""
    if not item:
        return 0.0
    return sum(k for k, _, _ in tiles(item, text, min(SEED, len(item)))) / len(item)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _item_seeds(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"), letters_only=True)
                rows, seeds = words.shingles(SEED)
                order = np.argsort(rows, kind="stable")
                bounds = np.searchsorted(rows[order], np.arange(part.num_rows + 1))
                sorted_seeds, tokens = _signed(seeds[order]), _signed(words.hash)
                yield record(
                    schema,
                    *part.columns[:-1],
                    [tokens[f : f + n] for f, n in zip(words.first, words.count)],
                    [sorted_seeds[a:b] for a, b in zip(bounds, bounds[1:])],
                )

    return run


def _runs_of(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of exactly `length` tokens, as items of that length have them."""
    row, hashes = words.row, words.hash
    full = max(0, len(hashes) - length + 1)
    same = row[:full] == row[length - 1 : length - 1 + full]
    return np.flatnonzero(same), words.runs(length)[same]


def _document_hits(cells, lengths: list[int], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(cells.value, np.uint8), bitorder="little").view(bool)
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"), letters_only=True)
                covered = np.zeros(len(words.hash) + 1, np.int64)
                hits, at_row = [], []
                for length in lengths:
                    at, hashes = _runs_of(words, length)
                    yes = bits[(hashes % np.uint64(CELLS)).astype(np.int64)]
                    at, hashes = at[yes], hashes[yes]
                    np.add.at(covered, at, 1)
                    np.add.at(covered, at + length, -1)
                    hits.append(hashes)
                    at_row.append(words.row[at])
                inside = np.cumsum(covered)[:-1] > 0
                kept = np.flatnonzero(inside)
                # 0 parts covered stretches, so that no tile reaches across a gap.
                gap = np.ones(len(kept), bool)
                gap[1:] = (np.diff(kept) > 1) | (words.row[kept[1:]] != words.row[kept[:-1]])
                tokens = np.insert(_signed(words.hash[kept]), np.flatnonzero(gap), 0)
                token_row = np.insert(words.row[kept], np.flatnonzero(gap), words.row[kept][gap])
                seeds, seed_row = np.concatenate(hits), np.concatenate(at_row)
                order = np.argsort(seed_row, kind="stable")
                seeds, seed_row = _signed(seeds[order]), seed_row[order]
                rows = np.arange(part.num_rows + 1)
                a, b = np.searchsorted(token_row, rows), np.searchsorted(seed_row, rows)
                yield record(
                    schema,
                    *part.columns[:-1],
                    [tokens[i:j] for i, j in zip(a, a[1:])],
                    [np.unique(seeds[i:j]) for i, j in zip(b, b[1:])],
                )

    return run


def _tile(least: float):
    schema = pa.schema([("row", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256).to_pydict()
                got = [coverage(i, t) for i, t in zip(rows["item_tokens"], rows["tokens"])]
                keep = [k for k, c in enumerate(got) if c >= least - 1e-9]
                yield record(
                    schema, [rows["row"][k] for k in keep], [rows["item_id"][k] for k in keep], [got[k] for k in keep]
                )

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = COVERAGE) -> DataFrame:
    """One row per document: doc_id, text_hash, contaminated, n_items, items, coverage (the best).

    `docs` holds doc_id and text, `benchmark` item_id and text.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower("text").alias("text"))
    items = items.filter(F.length("text") > 0).distinct()
    schema = pa.schema([("item_id", pa.int64()), ("tokens", pa.list_(pa.int64())), ("seeds", pa.list_(pa.int64()))])
    known = map_batches(items, _item_seeds(schema), "item_id long, tokens array<long>, seeds array<long>")
    known = stored(
        known.filter(F.size("tokens") > 0).withColumn("item", F.xxhash64("item_id", "tokens")), "tiling-items"
    )
    lengths = sorted(
        r["n"] for r in known.select(F.least(F.size("tokens"), F.lit(SEED)).alias("n")).distinct().collect()
    )
    seeds = known.select("item", F.size("tokens").alias("n"), F.posexplode("seeds").alias("at", "seed"))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"), F.lower("text").alias("text"),
    )
    hit_schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()),
         ("tokens", pa.list_(pa.int64())), ("seeds", pa.list_(pa.int64()))]
    )
    shared = spark.sparkContext.broadcast(bitmap(seeds, "seed"))
    hits = stored(
        map_batches(
            rows, _document_hits(shared, lengths or [SEED], hit_schema),
            "row long, doc_id long, text_hash long, tokens array<long>, seeds array<long>",
        ),
        "tiling-documents",
    )
    pairs = (
        hits.select("row", F.explode("seeds").alias("seed"))
        .join(seeds, "seed")
        .groupBy("row", "item", "n")
        .agg(F.collect_set("at").alias("at"))  # no more than the item has seeds
    )
    # Tokens under the shared seeds: SEED for the first, then what each next one adds.
    covered = F.expr(
        f"aggregate(array_sort(at), named_struct('end', 0, 'n', 0), (s, a) -> named_struct("
        f"'end', a + {SEED}, 'n', s.n + a + {SEED} - greatest(s.end, a)), s -> s.n)"
    )
    likely = pairs.filter((F.col("n") <= SEED) | (covered >= F.lit(least) * F.col("n") - 1e-9)).select("row", "item")
    tokens = known.select("item", "item_id", F.col("tokens").alias("item_tokens"))
    both = likely.join(tokens, "item").join(hits.select("row", "tokens"), "row")
    tiled = map_batches(
        both.select("row", "item_id", "item_tokens", "tokens"), _tile(least), "row long, item_id long, coverage double"
    )
    found = tiled.groupBy("row").agg(
        F.count("*").alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("items"), F.max("coverage").alias("coverage")
    )
    return (
        hits.select("row", "doc_id", "text_hash")
        .join(found, "row", "left")
        .select(
            "doc_id", "text_hash", F.col("n_items").isNotNull().alias("contaminated"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items", F.array().cast("array<long>")).alias("items"),
            F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        )
    )
