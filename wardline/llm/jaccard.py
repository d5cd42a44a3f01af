"""N-gram Jaccard join by token-combination prefixes.

A document's tokens are the 64-bit hashes of its distinct word shingles. All documents order their
tokens alike: by how many documents hold them, as a table of counts over the whole corpus tells,
then by hash. The order decides how much work there is, never what is found. Two sets that reach
the threshold share their first common token within a prefix of each; and if k of their tokens
agree, the k-th within a prefix extended by k - 1. So rare prefix tokens are keys by themselves.
For frequent ones, of which many documents share the first, combinations of two are keys, from
the prefix extended by one. Sets with more than `SMALL` tokens, whose combinations would be too
many, keep single keys for frequent tokens; sizes near that bound have both, as partners may lie
on its other side.

Sets that share a key meet in blocks (see `components.block_pairs`). First only parities meet: a
few bits per token, each the parity of the tokens that hash to it. Two parities differ in no more
bits than the sets differ in tokens, so a pair that differs in too many is no link. Whole sets are
sent for what remains, intersected, and the threshold is tested in whole numbers. Equal sets are
one class from the start.

Null and empty texts have no tokens, size 0 and link with nothing. A null doc_id takes no part and
has a null component. Rows that repeat a doc_id are one node; each keeps its own row and size.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CELLS, bitmap, map_batches, map_groups, record, slices, stored
from .components import Forest, block_pairs, components, meet
from .words import Words, _mix, distinct

SMALL = 200
#: Tokens of a block of sets; a task holds two blocks.
BLOCK = 40_000
#: The table of counts has a cell for about so many characters of text, between these bounds (as
#: powers of two). A cell is one byte where it is broadcast, so that is 64 MB at most; beyond, the
#: order tells apart only tokens of ever more documents, and the join finds the same links.
CHARS_PER_CELL, LEAST_BITS, MOST_BITS = 48, 16, 26
#: The table is added up in so many slices.
SLICES = 64
_FLUSH = 1 << 20


def _sets(part: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    words = Words(part.column("text"))
    return distinct(*words.shingles(n), part.num_rows)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return (total[bounds[1:]] - total[bounds[:-1]]).view(np.int64)


def _signatures(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that equal sets have in common."""
    return _sums(_mix(hashes), bounds), _sums(_mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), bounds)


_SIZES = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("slice", pa.int32()), ("counts", pa.binary())]
)
_SIZES_DDL = "doc_id long, n long, s1 long, s2 long, slice int, counts binary"


def _cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _measure(n: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, waiting, held = np.zeros(1 << bits, np.uint16), [], 0

        def flush() -> None:
            cells, found = np.unique(np.concatenate(waiting), return_counts=True)
            counts[cells] = np.minimum(counts[cells] + found, 65_535)

        for batch in batches:
            for part in slices(batch, "text"):
                bounds, hashes = _sets(part, n)
                waiting.append(_cells(hashes, bits).astype(np.int32))
                held += len(hashes)
                if held > _FLUSH:
                    flush()
                    waiting, held = [], 0
                none = [None] * part.num_rows
                yield record(_SIZES, part.column(0), np.diff(bounds), *_signatures(hashes, bounds), none, none)
        if held:
            flush()
        for i, own in enumerate(counts.reshape(SLICES, -1)):
            if own.any():
                yield record(_SIZES, [None], [None], [None], [None], [i], [zlib.compress(own.tobytes(), 1)])

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums slices one after the other: a task holds its slices' totals, not their parts."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, packed in zip(batch.column("slice").to_pylist(), batch.column("counts")):
            part = np.frombuffer(zlib.decompress(packed.as_buffer()), np.uint16)
            total[i] = total.get(i, 0) + part.astype(np.int64)
    schema = pa.schema([("slice", pa.int32()), ("n", pa.int64()), ("levels", pa.binary())])
    for i, own in total.items():
        levels = np.floor(2 * np.log2(1 + own)).astype(np.uint8)
        yield record(schema, [i], [int(own.sum())], [levels.tobytes()])


def _table_bits(rows: DataFrame) -> int:
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    return int(min(MOST_BITS, max(LEAST_BITS, round(math.log2(1 + chars / CHARS_PER_CELL)))))


def _levels(sizes: DataFrame, bits: int) -> tuple[np.ndarray, int]:
    """Twice the binary logarithm of each cell's count, and the level from which one is frequent."""
    parts = sizes.filter("slice is not null").select("slice", "counts").repartition(SLICES, "slice")
    rows = map_batches(parts, _add_up, "slice int, n long, levels binary").collect()  # one per slice
    levels = np.zeros((SLICES, (1 << bits) // SLICES), np.uint8)
    for r in rows:
        levels[r["slice"]] = np.frombuffer(r["levels"], np.uint8)
    mean = sum(r["n"] for r in rows) / levels.size
    return levels.ravel(), int(2 * np.log2(1 + 2 * mean + 32))


def prefix_keys(bounds: np.ndarray, hashes: np.ndarray, levels: np.ndarray, frequent: int, percent: int):
    """(row, key) of a batch of sets: rare prefix tokens, and pairs that begin with a frequent one."""
    size = np.diff(bounds)
    row = np.repeat(np.arange(len(size)), size)
    level = levels[_cells(hashes, len(levels).bit_length() - 1)]
    order = np.lexsort((hashes, level, row))
    token, often = hashes[order], level[order] >= frequent
    rank = np.arange(len(token)) - bounds[:-1][row]
    prefix = size - (percent * size + 99) // 100 + 1
    inside = (rank < prefix[row]) & (size[row] > 1)
    low, high = SMALL * percent // 100, SMALL * 100 // percent + 1
    single = inside & (~often | (size[row] > low))
    rows, keys = [row[single]], [token[single]]
    first = inside & often & (size[row] <= high)
    for r in np.unique(row[first]):
        begin, end = bounds[r], bounds[r] + min(prefix[r] + 1, size[r])
        own = token[begin:end]
        i, j = np.triu_indices(len(own), 1)
        keep = often[begin:end][i] & (i < prefix[r])
        i, j = i[keep], j[keep]
        rows.append(np.full(len(i), r))
        keys.append(_mix(own[i] * np.uint64(3) + _mix(own[j] + np.uint64(1))))
    return np.concatenate(rows), np.concatenate(keys)


def parity(tokens: np.ndarray) -> bytes:
    """2 to 4 bits per token, at least 64: each the parity of the number of tokens in its cell."""
    bits = 1 << max(6, int(2 * len(tokens) - 1).bit_length())
    cells = np.bincount((tokens >> np.uint64(7)).astype(np.int64) & (bits - 1), minlength=bits)
    return np.packbits((cells & 1).astype(np.uint8), bitorder="little").tobytes()


def _keys(n: int, levels, frequent: int, percent: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
         ("keys", pa.list_(pa.int64())), ("parity", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(levels.value, np.uint8)
        for batch in batches:
            for part in slices(batch, "text"):
                bounds, hashes = _sets(part, n)
                rows, keys = prefix_keys(bounds, hashes, table, frequent, percent)
                order = np.argsort(rows, kind="stable")
                at = np.searchsorted(rows[order], np.arange(part.num_rows + 1))
                flat = pa.array(keys[order].view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), flat)
                bits = [parity(hashes[a:b]) for a, b in zip(bounds, bounds[1:])]
                yield record(schema, part.column(0), np.diff(bounds), *_signatures(hashes, bounds), lists, bits)

    return run


def _folded(packed: list[bytes], size: int) -> np.ndarray:
    """Parities as 0/1 rows of `size` cells; longer ones are folded onto themselves."""
    out = np.zeros((len(packed), size), np.float32)
    for k, p in enumerate(packed):
        bits = np.unpackbits(np.frombuffer(p, np.uint8), bitorder="little")
        out[k] = np.bitwise_xor.reduce(bits.reshape(-1, size), axis=0)
    return out


def may_link(size: np.ndarray, packed: list[bytes], left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """For each of `left` and `right` together, whether any partner on the other side may be linked."""
    alive = np.zeros(len(size), bool)
    width = np.array([8 * len(p) for p in packed])
    for w1 in np.unique(width[left]):
        for w2 in np.unique(width[right]):
            if not w1 // 2 <= w2 <= w1 * 2:
                continue  # such sizes differ by more than any threshold from 50 % allows
            i, j = left[width[left] == w1], right[width[right] == w2]
            cells = int(min(w1, w2))
            x, y = _folded([packed[k] for k in i], cells), _folded([packed[k] for k in j], cells)
            apart = x.sum(1)[:, None] + y.sum(1)[None, :] - 2 * (x @ y.T)
            both = size[i][:, None] + size[j][None, :]
            # An intersection of c means both - 2c tokens apart; c >= percent / (100 + percent) * both.
            near = apart * (100 + percent) <= both * (100 - percent) + 1e-3
            small = np.minimum(size[i][:, None], size[j][None, :])
            near &= 100 * small >= percent * (both - small)
            near &= i[:, None] != j[None, :]
            alive[i[near.any(1)]] = True
            alive[j[near.any(0)]] = True
    return alive


def _thin(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("id", pa.int64()), ("second", pa.bool_())])

    def run(group: pa.Table) -> pa.Table:
        second = group.column("second").to_numpy(zero_copy_only=False)
        size, packed = group.column("n").to_numpy(), group.column("parity").to_pylist()
        left = np.flatnonzero(~second)
        right = np.flatnonzero(second) if second.any() else left
        alive = pa.array(may_link(size, packed, left, right, percent))
        return group.select(["a", "b", "id", "second"]).filter(alive).cast(schema)

    return run


def _payload(n: int, wanted):
    schema = pa.schema([("doc_id", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("tokens", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(wanted.value, np.uint8), bitorder="little").view(bool)
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            batch = batch.filter(pa.array(bits[cells]))
            for part in slices(batch, "text"):
                bounds, hashes = _sets(part, n)
                packed = [hashes[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
                yield record(schema, part.column("doc_id"), *_signatures(hashes, bounds), packed)

    return run


def overlaps(sets: list[np.ndarray], first: int) -> np.ndarray:
    """Sizes of intersections: rows are the first `first` sets (or all), columns the others (or all).

    Only tokens that at least two sets hold matter. They are multiplied a few thousand at a time.
    """
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    every = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    column = np.cumsum(new) - 1
    shared = np.bincount(column, minlength=1)[column] > 1
    owner, column = owner[shared], column[shared]
    new = np.ones(len(column), bool)
    new[1:] = column[1:] != column[:-1]
    column = np.cumsum(new) - 1
    left, right = (slice(0, first), slice(first, None)) if first < len(sets) else (slice(None), slice(None))
    out = np.zeros((len(sets[left]), len(sets[right])), np.float32)
    width = max(256, 4_000_000 // max(1, len(sets)))
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (begin, begin + width))
        held = np.zeros((len(sets), width), np.float32)
        held[owner[a:b], column[a:b] - begin] = 1
        out += held[left] @ held[right].T
    return out.astype(np.int64)


def _verify(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("second", "ascending"), ("id", "ascending")])
        ids = group.column("id").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("tokens")]
        second = group.column("second").to_numpy(zero_copy_only=False)
        once = np.append(True, (ids[1:] != ids[:-1]) | (second[1:] != second[:-1]))  # rows may repeat
        ids, second = ids[once], second[once]
        sets = [s for s, k in zip(sets, once) if k]
        first = int((~second).sum())
        size = np.array([len(s) for s in sets])
        both = overlaps(sets, first)
        whole = first == len(sets)
        rows, columns = size[:first], size if whole else size[first:]
        if not first:
            return schema.empty_table()
        linked = 100 * both >= percent * (rows[:, None] + columns[None, :] - both)
        forest = Forest(len(ids))
        for i, j in zip(*np.nonzero(linked)):
            j = j if whole else first + j
            if i != j:
                forest.join(int(i), int(j))
        return pa.Table.from_batches([record(schema, *forest.stars(ids))])

    return run


def join_classes(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    bits = _table_bits(rows)
    measured = stored(map_batches(rows, _measure(n, bits), _SIZES_DDL), "jaccard-sizes")
    sizes = measured.filter("slice is null").select("doc_id", "n", "s1", "s2")
    levels, frequent = _levels(measured, bits)

    classes = sizes.filter("n > 0 and doc_id is not null").groupBy("s1", "s2").agg(F.min("doc_id").alias("id"))
    classes = stored(classes, "jaccard-classes")
    shared = spark.sparkContext.broadcast(levels.tobytes())
    named = rows.filter("doc_id is not null")
    found = map_batches(
        named, _keys(n, shared, frequent, percent),
        "doc_id long, n long, s1 long, s2 long, keys array<long>, parity binary",
    )
    own = found.join(classes, ["s1", "s2"]).filter("doc_id = id").select("id", "n", "s1", "s2", "keys", "parity")
    own = stored(own, "jaccard-prefixes")
    shared.destroy()  # what follows reads the stored prefixes
    keys = own.select(F.explode("keys").alias("key"), "id")
    weights = own.groupBy("id").agg(F.max("n").alias("weight"))
    home, pairs = block_pairs(keys, weights, BLOCK)
    facts = own.select("id", "n", "parity").dropDuplicates(["id"])
    thinned = map_groups(
        meet(home, pairs, facts).select("a", "b", "id", "second", "n", "parity"), ["a", "b"], _thin(percent),
        "a long, b long, id long, second boolean",
    )
    thinned = stored(thinned, "jaccard-thinned")

    candidates = thinned.select("id").distinct().join(own.select("id", "s1", "s2").distinct(), "id")
    candidates = stored(candidates, "jaccard-candidates")
    wanted = spark.sparkContext.broadcast(bitmap(candidates.select(F.xxhash64("id").alias("h")), "h"))
    cells = named.withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.lit(CELLS)))
    tokens = map_batches(cells, _payload(n, wanted), "doc_id long, s1 long, s2 long, tokens binary")
    dealt = thinned.join(candidates, "id").join(tokens.withColumnRenamed("doc_id", "id"), ["id", "s1", "s2"])
    links = map_groups(
        dealt.select("a", "b", "id", "second", "tokens"), ["a", "b"], _verify(percent), "a long, b long"
    )
    # Rows of equal sets, and rows that repeat a doc_id, are linked to their class as well.
    copies = sizes.filter("doc_id is not null").join(classes, ["s1", "s2"]).filter("doc_id <> id")
    edges = links.union(copies.select(F.col("doc_id").alias("a"), F.col("id").alias("b")))
    grouped = components(edges)
    wanted.destroy()  # components are stored
    return (
        sizes.join(grouped, sizes["doc_id"] == grouped["id"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    )
