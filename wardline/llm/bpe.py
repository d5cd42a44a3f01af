"""Byte-level BPE: overlapping chunks, stitched where their pre-token boundaries agree.

A long text is cut into chunks that overlap. Each chunk is pre-tokenised on its own, from a
start that may lie inside a pre-token. What follows a boundary does not depend on what came
before it, so from the first boundary that a chunk shares with the one before, both agree. Each
piece between two such places is encoded by itself; pieces are then put back in order.

Null text counts as empty and gives no ids. Repeated rows and null ids give a row each. A text
whose overlap holds no common boundary (one endless pre-token) is encoded in order from there on.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, map_groups, record, slices

#: Code points of a chunk, and of what it shares with the next.
CHUNK, OVERLAP = 32_768, 512
#: A boundary holds whatever follows once this many more code points were seen.
SEEN = 2
_KEPT_PIECES = 100_000
_coders: dict = {}


class _Coder(dict):
    """Pre-token -> its ids as little-endian bytes; forgets when it has grown large."""

    def __init__(self, ranks: bytes, pattern: str):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.bytes_of = {i: b for b, i in table.items()}
        self.split = regex.compile(pattern)
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        )

    def __missing__(self, piece: str) -> bytes:
        ids = self.encoding.encode_ordinary(piece)
        out = b"".join(i.to_bytes(4, "little") for i in ids)
        if len(piece) < 40:
            self[piece] = out
        return out

    def encode(self, pieces: list[str]) -> bytes:
        if len(self) > _KEPT_PIECES:
            self.clear()
        return b"".join(map(self.__getitem__, pieces))


def _coder(ranks: bytes, pattern: str) -> _Coder:
    key = (hash(ranks), pattern)
    if key not in _coders:
        _coders[key] = _Coder(ranks, pattern)
    return _coders[key]


def cut(text: str, chunk: int, overlap: int) -> list[str]:
    """Chunks of `chunk` code points, each with `overlap` more of what follows."""
    return [text[i : i + chunk + overlap] for i in range(0, max(1, len(text)), chunk)]


def boundaries(split, piece: str, last: bool) -> list[int]:
    """Ends of pre-tokens that hold whatever follows the piece."""
    ends = [m.end() for m in split.finditer(piece)]
    return ends if last else [e for e in ends if e + SEEN <= len(piece)]


def _short(ranks: bytes, pattern: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(ranks, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = [coder.encode(coder.split.findall(t)) for t in part.column("text").to_pylist()]
                yield record(schema, part.column(0), ids)

    return run


def _cut(chunk: int, overlap: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1):
                row, key, text = (part.column(i)[0].as_py() for i in range(3))
                pieces = cut(text, chunk, overlap)
                for i in range(0, len(pieces), 16):
                    some = pieces[i : i + 16]
                    n = len(some)
                    last = [i + j == len(pieces) - 1 for j in range(n)]
                    yield record(schema, [row] * n, [key] * n, range(i, i + n), last, some)

    return run


def _pretokenise(pattern: str, chunk: int, overlap: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                heads, tails = [], []
                numbers = part.column("chunk").to_pylist()
                lasts = part.column("last").to_pylist()
                for number, last, text in zip(numbers, lasts, part.column("text").to_pylist()):
                    at = number * chunk
                    ends = boundaries(split, text, last)
                    heads.append([0] if number == 0 else [at + e for e in ends if e <= overlap])
                    tails.append([at + e for e in ends if e >= chunk])
                yield record(schema, *part.columns, heads, tails)

    return run


def _encode_run(ranks: bytes, pattern: str, chunk: int, schema: pa.Schema):
    """One stitched run: its chunks joined, from its first true boundary to the next run's."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("chunk").to_pydict()
        coder = _coder(ranks, pattern)
        first = group["chunk"][0] * chunk
        texts = [t[:chunk] for t in group["text"][:-1]] + [group["text"][-1]]
        text = "".join(texts)
        begin, end = group["begin"][0] - first, group["until"][0]
        end = len(text) if end is None else end - first
        pieces, at = [], begin
        # The whole remainder is matched, so look-ahead sees what truly follows the run.
        for m in coder.split.finditer(text, begin):
            if at >= end:
                break
            pieces.append(m.group())
            at = m.end()
        ids = coder.encode(pieces)
        return pa.Table.from_batches(
            [record(schema, [group["row"][0]], [group["key"][0]], [group["run"][0]], [ids])]
        )

    return run


def _join_runs(schema: pa.Schema):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("run").to_pydict()
        return pa.Table.from_batches([record(schema, [group["key"][0]], [b"".join(group["ids"])])])

    return run


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text",
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """(key, ids) per row; ids are little-endian unsigned 32-bit integers in one binary.

    `ranks_path` names a rank file on the driver; its content (below 1 MB) goes to the tasks.
    """
    if not 0 < overlap < chunk:
        raise ValueError("the overlap must be shorter than the chunk")
    with open(ranks_path, "rb") as f:
        ranks = f.read()
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    long = F.coalesce(F.length("text"), F.lit(0)) > chunk
    arrow = _arrow(docs, key)
    out = pa.schema([("key", arrow), ("ids", pa.binary())])
    short = map_batches(
        rows.filter(~long), _short(ranks, pattern, out), f"key {kind}, ids binary"
    )

    numbered = rows.withColumn("row", F.monotonically_increasing_id()).filter(long)
    pieces = pa.schema(
        [("row", pa.int64()), ("key", arrow), ("chunk", pa.int64()), ("last", pa.bool_()), ("text", pa.string())]
    )
    ddl = f"row long, key {kind}, chunk long, last boolean, text string"
    cuts = map_batches(numbered.select("row", "key", "text"), _cut(chunk, overlap, pieces), ddl)
    marked_schema = pa.schema([*pieces, ("head", pa.list_(pa.int64())), ("tail", pa.list_(pa.int64()))])
    marked = map_batches(
        cuts.repartition("row", "chunk"), _pretokenise(pattern, chunk, overlap, marked_schema), ddl + ", head array<long>, tail array<long>"
    )
    order = Window.partitionBy("row").orderBy("chunk")
    common = F.array_min(F.array_intersect(F.lag("tail").over(order), F.col("head")))
    found = marked.withColumn("begin", F.when(F.col("chunk") == 0, F.lit(0).cast("long")).otherwise(common))
    # After a chunk without a common boundary nothing later is proven: it joins the run before.
    broken = F.max(F.col("begin").isNull()).over(order)
    found = found.withColumn("broken", broken).withColumn("begin", F.when(~F.col("broken"), F.col("begin")))
    stitched = (
        found.withColumn("run", F.count("begin").over(order))
        .withColumn("until", F.lead("begin").over(order))
        .select("row", "key", "chunk", "text", "run", "begin", "until")
    )
    run_schema = pa.schema([("row", pa.int64()), ("key", arrow), ("run", pa.int64()), ("ids", pa.binary())])
    runs = map_groups(
        stitched, ["row", "run"], _encode_run(ranks, pattern, chunk, run_schema), f"row long, key {kind}, run long, ids binary"
    )
    joined = map_groups(runs, ["row"], _join_runs(out), f"key {kind}, ids binary")
    return short.unionByName(joined).withColumnRenamed("key", key)


def _arrow(df: DataFrame, key: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[key].dataType)


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """Adds `decoded`, the raw bytes of all ids in order (a column of that name is replaced)."""
    with open(ranks_path, "rb") as f:
        ranks = f.read()
    from pyspark.sql.pandas.types import to_arrow_schema

    encoded = encoded.drop("decoded")
    arrow = pa.schema([*to_arrow_schema(encoded.schema), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {int(b): base64.b64decode(a) for a, b in map(bytes.split, ranks.splitlines())}
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                packed = part.column(at).to_pylist()
                decoded = [b"".join(map(table.__getitem__, memoryview(p or b"").cast("I"))) for p in packed]
                yield record(arrow, *part.columns, decoded)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return map_batches(encoded, run, f"{schema}, decoded binary")
