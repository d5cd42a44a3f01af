"""Alignment of two tokenizers' tokens by diagonal run skipping, with corpus-wide link counts.

Both token sequences of a text become arrays of byte offsets at which tokens end. As long as the
arrays agree at the current index shift, tokens are one to one: exponential probing doubles the
stretch compared at once, then halves back to the first difference, and the whole stretch is
jumped. An irregular group is walked token by token until both sides end together, which gives
its links and the new shift.

Links are counted in shards: tasks gather documents until they hold about `SHARD` bytes of text,
and hand on each shard's distinct id pairs once, with the number of its documents that hold them.
So counting and looking up counts shuffle pairs of shards, not pairs of documents; documents keep
places in their shard's list. Shards and documents meet again by shard, whose size is bounded by
`SHARD` or by one document.

A text that is null or empty, or whose joined tokens on either side are not its bytes after one
space (such as one that holds the mark U+2581), has no tokens: zeros and ''. Repeated rows and
null ids count as further documents. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, pieces
from .common import map_batches, record, ship, slices, stored

SHARD = 4 << 20
#: Tokens that are written as text at a time.
_PARTS = 1 << 16
#: Code points up to which the byte-level library splits and encodes a text by itself.
_DIRECT = 100_000
_SCHEMA = pa.schema(
    [("shard", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
     ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
     ("at", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())),
     ("pair", pa.list_(pa.int64())), ("held", pa.list_(pa.int32()))]
)
_FACTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_DDL = f"shard long, {_FACTS}, at array<int>, times array<int>, pair array<long>, held array<int>"


def byte_of_char() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 stands for itself, other bytes for code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def ranks_of(path: str) -> bytes:
    """The ranks of a byte-level BPE in a tokenizer's JSON file, a line per token; special tokens left out."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, of = file["model"], byte_of_char()
    special = {t["content"] for t in file.get("added_tokens", ())}
    merged = [m.replace(" ", "", 1) if isinstance(m, str) else "".join(m) for m in model["merges"]]
    ids = [model["vocab"][m] for m in merged]
    if ids != sorted(ids):
        raise ValueError("the ids of the vocabulary do not follow its merges")
    tokens = ((bytes(of[c] for c in t), i) for t, i in model["vocab"].items() if t not in special)
    return b"\n".join(b"%s %d" % (base64.b64encode(t), i) for t, i in tokens)


def matching(a: bytes, b: bytes, i: int, j: int, most: int) -> int:
    """How many of `most` packed entries from i in `a` and j in `b` on agree, the first one given.

    Steps double until a stretch differs, and then halve down to the difference.
    """
    run, step = 1, 2
    while run < most:
        x, y = 8 * (i + run), 8 * (j + run)
        if a[x : x + 8 * step] != b[y : y + 8 * step]:
            break
        run += step
        step *= 2
    else:
        return most
    while step > 1:
        step //= 2
        x, y = 8 * (i + run), 8 * (j + run)
        if a[x : x + 8 * step] == b[y : y + 8 * step]:
            run += step
    return min(run, most)


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, list[int], list[int]]:
    """Runs of two ascending arrays of ends with the same last one, and the links of irregular groups.

    A run (i, j, n, m) is one group of n by m tokens from a[i] and b[j] on, or with n = 0 a stretch
    of m one-to-one groups. The links of a stretch are its tokens side by side.
    """
    a, b = ends_a.tolist(), ends_b.tolist()
    packed_a, packed_b = ends_a.tobytes(), ends_b.tobytes()
    runs, left, right, i, j, n_a, n_b = [], [], [], 0, 0, len(a), len(b)
    while i < n_a:
        x, y = a[i], b[j]
        if x == y:
            m = matching(packed_a, packed_b, i, j, min(n_a - i, n_b - j))
            runs += (i, j, 0, m)
            i += m
            j += m
            continue
        first, other = i, j
        while True:
            left.append(i)
            right.append(j)
            if x < y:
                i += 1
                x = a[i]
            elif y < x:
                j += 1
                y = b[j]
            else:
                i += 1
                j += 1
                break
        runs += (first, other, i - first, j - other)
    return np.array(runs, np.int64).reshape(-1, 4), left, right


def linked(runs: np.ndarray, left: list[int], right: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all linked tokens, stretches included."""
    i, j, n, m = runs[runs[:, 2] == 0].T
    within = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
    one, other = np.repeat(i, m) + within, np.repeat(j, m) + within
    return np.concatenate((one, np.array(left, np.int64))), np.concatenate((other, np.array(right, np.int64)))


def groups(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and of B in each group, in order."""
    _, _, n, m = runs.T
    one = n == 0
    times = np.where(one, m, 1)
    return np.repeat(np.where(one, 1, n), times), np.repeat(np.where(one, 1, m), times)


class Decimals:
    """Ids as decimal text, with room for a separator."""

    def __init__(self, size: int):
        names = [str(i) for i in range(size)]
        self.width = len(names[-1]) + 1
        self.size = np.array(list(map(len, names)))
        self.text = np.frombuffer("".join(n.ljust(self.width) for n in names).encode(), np.uint8).reshape(size, -1)


def written(ids_a: np.ndarray, ids_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, decimals: Decimals) -> bytes:
    """`a1,a2|b1;a3|b2,b3`: tokens of n_a and n_b per group, A's before B's."""
    before_a, before_b = np.cumsum(n_a), np.cumsum(n_b)
    place_a = np.arange(len(ids_a)) + np.repeat(before_b - n_b, n_a)
    place_b = np.arange(len(ids_b)) + np.repeat(before_a, n_b)
    ids = np.empty(len(ids_a) + len(ids_b), np.int64)
    ids[place_a], ids[place_b] = ids_a, ids_b
    marks = np.full(len(ids), ord(","), np.uint8)
    marks[place_a[before_a - 1]], marks[place_b[before_b - 1]] = ord("|"), ord(";")
    out = []
    for at in range(0, len(ids), _PARTS):
        some = ids[at : at + _PARTS]
        text, size = decimals.text[some], decimals.size[some]
        text[np.arange(len(some)), size] = marks[at : at + _PARTS]
        out.append(text[np.arange(decimals.width) <= size[:, None]].tobytes())
    return b"".join(out)[:-1]


class Aligner:
    """Both tokenizers with the byte length and the decimal text of each id."""

    def __init__(self, ranks: bytes, pattern: str, model: bytes):
        self.a, self.b = bpe._coder(ranks, pattern), pieces.pieces_of(model)
        self.raw_a, self.raw_b = self.a.bytes_of, self.b.raw
        self.size_a = np.zeros(max(self.raw_a) + 1, np.int64)
        for i, raw in self.raw_a.items():
            self.size_a[i] = len(raw)
        self.size_b = np.array([len(r) for r in self.raw_b])
        self.decimals = Decimals(max(len(self.size_a), len(self.size_b)))

    def ids_a(self, text: str) -> list[int] | np.ndarray:
        if len(text) < _DIRECT:
            return self.a.encoding.encode_ordinary(text)
        # The library's own splitting may not survive very long runs of white space.
        return np.frombuffer(self.a.encode(self.a.split.findall(text)), "<i4")

    def documents(self, texts: list[str]) -> Iterator[tuple]:
        """Per text (n_a, n_b, n_groups, n_links, digest, distinct pairs, links of each)."""
        none = np.empty(0, np.int64)
        for text, packed in zip(texts, self.b.encode(texts, False)):
            size = len(text.encode()) + 1
            ids_b = np.frombuffer(packed, "<i4")
            ends_b = np.cumsum(self.size_b[ids_b])
            # Both lose nothing but marks, which come back as one byte: bytes differ where sizes do.
            if not text or ends_b[-1] != size:
                yield 0, 0, 0, 0, "", none, none
                continue
            ids_a = np.asarray(self.ids_a(" " + text), np.int64)
            runs, left, right = align(np.cumsum(self.size_a[ids_a]), ends_b)
            n_a, n_b = groups(runs)
            digest = hashlib.sha256(written(ids_a, ids_b, n_a, n_b, self.decimals)).hexdigest()
            one, other = linked(runs, left, right)
            pairs = ids_a[one] << 32 | ids_b[other]
            yield len(ids_a), len(ids_b), len(n_a), len(one), digest, *np.unique(pairs, return_counts=True)


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(parts), kind))


def _shard(facts: list[tuple]) -> Iterator[pa.RecordBatch]:
    """The documents' rows of a shard, then the row of its pairs."""
    n, name = len(facts), uuid.uuid4().int >> 65
    doc_id, n_a, n_b, groups, links, digest, pairs, times = zip(*facts)
    every, place, held = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
    at = np.split(place.astype(np.int32), np.cumsum([len(p) for p in pairs])[:-1])
    nulls = pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int32()))
    yield record(
        _SCHEMA, [name] * n, doc_id, n_a, n_b, groups, links, digest, _lists(at, pa.int32()), _lists(times, pa.int32()), *nulls
    )
    if len(every):
        none = [[None]] * 8
        yield record(_SCHEMA, [name], *none, [every], [held])


def _align(ranks: bytes, pattern: str, model: bytes, shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, facts, size = Aligner(ranks, pattern, model), [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                for doc_id, text, found in zip(part.column("doc_id").to_pylist(), texts, aligner.documents(texts)):
                    facts.append((doc_id, *found))
                    size += len(text)
                    if size >= shard:
                        yield from _shard(facts)
                        facts, size = [], 0
        if facts:
            yield from _shard(facts)

    return run


_OUT = pa.schema([*list(_SCHEMA)[1:7], ("n_best", pa.int64()), ("count_sum", pa.int64())])


def _sums(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """Sums of the shard's documents over their links' counts."""
    order = pairs.column("pos").to_numpy()
    count, best = np.zeros(len(order), np.int64), np.zeros(len(order), bool)
    count[order] = pairs.column("n").to_numpy()
    best[order] = pairs.column("best").to_numpy(zero_copy_only=False)
    at = docs.column("at").combine_chunks()
    times = docs.column("times").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    place = at.flatten().to_numpy(zero_copy_only=False)
    sizes = at.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    sums = [np.zeros(len(sizes), np.int64) for _ in range(2)]
    np.add.at(sums[0], row, times * best[place])
    np.add.at(sums[1], row, times * count[place])
    return pa.Table.from_arrays(
        [*(docs.column(f.name).combine_chunks() for f in list(_OUT)[:6]), *map(pa.array, sums)], schema=_OUT
    )


def aligned(docs: DataFrame, json_path: str, pattern: str, model_path: str, shard: int = SHARD) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum per row of `docs` (doc_id, text).

    The paths name files on the driver; their content (a few MB) goes to the tasks.
    """
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        model = f.read()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    base = stored(map_batches(rows, _align(ranks_of(json_path), pattern, model, shard), _DDL), "alignment")
    found = base.filter("pair is null").drop("pair", "held")
    entries = base.filter("pair is not null").select(
        "shard", F.posexplode(F.arrays_zip("pair", "held")).alias("pos", "e")
    )
    entries = entries.select("shard", "pos", F.col("e.pair").alias("pair"), F.col("e.held").alias("held"))
    counts = entries.groupBy("pair").agg(F.sum("held").alias("n")).withColumn("a", F.shiftright("pair", 32))
    # No more rows than tokenizer A has ids.
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    graded = counts.join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    graded = entries.drop("held").join(stored(graded, "alignment-counts"), "pair")
    graded = graded.select(F.col("shard").alias("of_shard"), "pos", "n", "best")
    ship(spark)
    summed = (
        found.filter("n_links > 0").groupBy("shard").cogroup(graded.groupBy("of_shard"))
        .applyInArrow(_sums, f"{_FACTS}, n_best long, count_sum long")
    )
    zero = F.lit(0).cast("long")
    rest = found.filter("n_links = 0").drop("shard", "at", "times").withColumns({"n_best": zero, "count_sum": zero})
    return summed.union(rest)
