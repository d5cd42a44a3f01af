"""Line deduplication by a segment-partition edit join.

Lines are compared in lower case with single spaces. Two lines are linked when their edit distance
is at most 2, or less for short lines: a tenth of the shorter one's code points, rounded down.
Lines linked directly or through others form a class, of which the first occurrence (by doc_id,
text hash and line number) stays.

If the shorter line is cut into distance-plus-one segments, one of them occurs unchanged in the
other line, at a place that its number and the lengths narrow down. So every line is indexed by
(length, number, segment) and probes with the few substrings of itself that could be a segment of
a line of its own length or up to 2 shorter. Lines that share a key meet in blocks; there the same
index works in memory, and a banded bit-parallel edit distance decides.

Equal lines are one from the start (by a 64-bit hash). Blank lines always stay and are in no class.
Null and empty texts have one blank line. Rows that repeat doc_id and text are one document. Null
ids are compared like others and come first.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import CELLS, bitmap, map_batches, map_groups, record, slices, stored
from .components import Forest, block_pairs, components, meet

MOST_EDITS, CHARS_PER_EDIT = 2, 10
#: Code points of a block of lines; a task holds two blocks.
BLOCK = 100_000


def normal(line: str) -> str:
    return " ".join(line.lower().split())


def _normal_lines(text: str) -> list[str]:
    """`normal` of each line; no letter's lower case depends on what is beyond a line break."""
    return [" ".join(line.split()) for line in text.lower().split("\n")]


def edits(length: int) -> int:
    """The distance allowed where the shorter line has this length."""
    return min(MOST_EDITS, length // CHARS_PER_EDIT)


def segments(length: int, most: int) -> list[tuple[int, int]]:
    """(start, size) of most + 1 segments, as even as can be, the longer ones last."""
    n = most + 1
    short, longer = divmod(length, n)
    sizes = [short + (i >= n - longer) for i in range(n)]
    return [(sum(sizes[:i]), size) for i, size in enumerate(sizes)]


def places(n: int, length: int, most: int) -> Iterator[tuple[int, int, int]]:
    """(number, start, size) of the substrings of a line of length n that may be such segments."""
    longer = n - length
    for i, (start, size) in enumerate(segments(length, most)):
        low = max(0, start - i, start + longer - (most - i))
        high = min(n - size, start + i, start + longer + (most - i))
        for at in range(low, high + 1):
            yield i, at, size


_own: dict[int, list] = {}
_probes: dict[int, list] = {}
_seeds: dict[int, list] = {}


def _own_places(n: int) -> list[tuple[int, int, int]]:
    if n not in _own:
        _own[n] = [(i, s, s + z) for i, (s, z) in enumerate(segments(n, edits(n)))] if edits(n) else []
    return _own[n]


def _probe_places(n: int) -> list[tuple[int, int, int, int]]:
    if n not in _probes:
        _probes[n] = [
            (length, i, at, at + size)
            for length in range(max(1, n - MOST_EDITS), n + 1)
            if n - length <= edits(length) > 0
            for i, at, size in places(n, length, edits(length))
        ]
    return _probes[n]


def _probe_seeds(n: int) -> list[tuple[int, int, int]]:
    if n not in _seeds:
        _seeds[n] = [(a, b, m * 8 + i) for m, i, a, b in _probe_places(n)]
    return _seeds[n]


def line_keys(line: str) -> list[int]:
    """64-bit keys (unsigned) of a line's own segments and of its probes, each once. Its own segments
    are probes too, those for lines of the same length."""
    hashed, n, raw = xxhash.xxh3_64_intdigest, len(line), line.encode()
    if len(raw) == n:
        return list({hashed(raw[a:b], seed) for a, b, seed in _probe_seeds(n)})
    return list({hashed(line[a:b].encode(), seed) for a, b, seed in _probe_seeds(n)})


def distance(a: str, b: str, most: int) -> int:
    """Edit distance, or most + 1 if it is larger: bit vectors over the band of 2 * most + 1 diagonals."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return most + 1
    if a == b:
        return 0
    low, high = 0, len(b)
    while low < high:  # common prefix by halving
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    a, b = a[low:], b[low:]
    low, high = 0, len(b)
    while low < high:  # common suffix
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[len(a) - mid : len(a) - low] == b[len(b) - mid : len(b) - low] else (low, mid - 1)
    a, b = a[: len(a) - low], b[: len(b) - low]
    m, n = len(a), len(b)
    if not n or m <= most:
        return min(most + 1, m) if not n else min(most + 1, _small(a, b))
    width = 2 * most + 2
    full, top = (1 << width) - 1, 1 << (width - 1)
    rise, fall, score, last = (full << (width - most - 1)) & full, 0, most, top >> 1
    limit = 2 * most + n - m
    for j, c in enumerate(b):
        first = j + most + 1 - width  # the row of the band's lowest bit
        equal = 0
        for i in range(max(0, first), min(m, j + most + 1)):
            if a[i] == c:
                equal |= 1 << (i - first)
        diagonal = ((((equal & rise) + rise) ^ rise) | equal | fall) & full
        right, left = (fall | ~(diagonal | rise)) & full, diagonal & rise
        if j < m - most:  # down the band's last diagonal, then along the last row
            score += not diagonal & top
        else:
            score += bool(right & last) - bool(left & last)
            last >>= 1
        if score > limit:
            return most + 1
        rise, fall = (left | ~((diagonal >> 1) | right)) & full, (diagonal >> 1) & right
    return min(score, most + 1)


def _small(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def edit_links(lines: list[str], side: list[int] | None = None) -> Iterator[tuple[int, int]]:
    """Pairs of distinct lines within reach of each other, only of different sides if given."""
    index = defaultdict(list)
    for k in sorted(range(len(lines)), key=lambda i: (len(lines[i]), i)):
        line, n, seen = lines[k], len(lines[k]), set()
        for length, i, a, b in _probe_places(n):
            for r in index.get((length, i, line[a:b]), ()):
                if r not in seen and (side is None or side[r] != side[k]):
                    seen.add(r)
                    most = edits(length)
                    if distance(line, lines[r], most) <= most:
                        yield r, k
        for i, a, b in _own_places(n):
            index[n, i, line[a:b]].append(k)


def _signed(hashes: list[int]) -> np.ndarray:
    return np.array(hashes, np.uint64).view(np.int64)


def _id(line: str) -> int:
    """Unsigned, as `_signed` takes it."""
    return xxhash.xxh3_64_intdigest(line.encode())


def _occurrences(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [_normal_lines(text) for text in part.column("text").to_pylist()]
                counts = np.array([len(f) for f in found])
                every = [line for f in found for line in f]
                at = pa.array(np.repeat(np.arange(len(found)), counts))
                no = np.arange(len(every)) - np.repeat(np.cumsum(counts) - counts, counts)
                chars = np.array([len(line) for line in every], np.int32)
                ids = pa.array(_signed([_id(line) for line in every]), mask=chars == 0)
                yield record(
                    schema, part.column(0).take(at), part.column(1).take(at), no.astype(np.int32), ids, chars
                )

    return run


def _lines_of(batches: Iterator[pa.RecordBatch], seen: set) -> Iterator[tuple[int, str]]:
    """Distinct non-blank lines of a task with their ids, up to what its memory of them holds."""
    for batch in batches:
        for part in slices(batch, "text"):
            for text in part.column("text").to_pylist():
                for line in _normal_lines(text):
                    if line and (k := _id(line)) not in seen:
                        if len(seen) > 200_000:
                            seen.clear()
                        seen.add(k)
                        yield k, line


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64())])
    keys, ids, sizes = [], [], []

    def packed() -> pa.RecordBatch:
        return record(schema, _signed(keys), np.repeat(_signed(ids), sizes))

    for k, line in _lines_of(batches, set()):
        own = line_keys(line)
        keys += own
        ids.append(k)
        sizes.append(len(own))
        if len(keys) > 50_000:
            yield packed()
            keys, ids, sizes = [], [], []
    if keys:
        yield packed()


def _texts(wanted):
    schema = pa.schema([("id", pa.int64()), ("line", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        ids, lines, size = [], [], 0
        for k, line in _lines_of(batches, set()):
            cell = k % CELLS
            if bits[cell >> 3] >> (cell & 7) & 1:
                ids.append(k)
                lines.append(line)
                size += len(line)
                if size > 1 << 20:
                    yield record(schema, _signed(ids), lines)
                    ids, lines, size = [], [], 0
        if ids:
            yield record(schema, _signed(ids), lines)

    return run


def _verify(group: pa.Table) -> pa.Table:
    schema = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
    group = group.sort_by("id")
    ids, lines = group.column("id").to_numpy(), group.column("line").to_pylist()
    side = group.column("second").to_pylist()
    forest, links = Forest(len(ids)), np.zeros(len(ids), np.int64)
    for i, j in edit_links(lines, side if any(side) else None):
        links[[i, j]] += 1
        forest.join(i, j)
    some = np.flatnonzero(links)
    return pa.Table.from_batches(
        [record(schema, ids[some], links[some], [int(ids[forest.root(int(k))]) for k in some])]
    )


def _shared(keys: DataFrame) -> DataFrame:
    """The (key, id) whose key another id has too. Most keys are one line's alone, so all of them move
    and are sorted once, and nothing is stored of those."""
    same = Window.partitionBy("key")
    ends = keys.withColumns({"low": F.min("id").over(same), "high": F.max("id").over(same)})
    return ends.filter("low < high").select("key", "id")


def line_classes(docs: DataFrame) -> DataFrame:
    """One row per line of `docs` (doc_id, text), repeated rows once.

    doc_id, text_hash, line_no, n_links (other distinct lines linked directly), class_doc_id and
    class_line_no (the class's first occurrence; null for blank lines), kept.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("line_no", pa.int32()), ("id", pa.int64()), ("chars", pa.int32())]
    )
    found = map_batches(rows, _occurrences(schema), "doc_id long, text_hash long, line_no int, id long, chars int")
    occurrences = stored(found, "line-occurrences")
    keys = map_batches(rows.select("text"), _keys, "key long, id long")
    sizes = occurrences.filter("id is not null").groupBy("id").agg(F.max("chars").alias("weight"))
    home, pairs = block_pairs(stored(_shared(keys), "line-keys"), sizes, BLOCK)
    members = pairs.select(F.col("a").alias("block")).union(pairs.select("b")).distinct()
    candidates = stored(home.join(members, "block", "left_semi").select("id"), "line-candidates")
    wanted = spark.sparkContext.broadcast(bitmap(candidates, "id"))
    texts = map_batches(rows.select("text"), _texts(wanted), "id long, line string")
    texts = texts.join(candidates, "id", "left_semi").dropDuplicates(["id"])
    dealt = meet(home, pairs, texts).select("a", "b", "id", "second", "line")
    links = stored(map_groups(dealt, ["a", "b"], _verify, "id long, links long, root long"), "line-links")
    wanted.destroy()  # links are stored
    grouped = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("id").agg(F.sum("links").alias("n_links")).join(grouped, "id")
    placed = occurrences.join(counted, "id", "left").withColumn("class", F.coalesce("component", "id"))
    # Only occurrences of a class with several are looked up; a hot class is combined before it moves.
    first = (
        placed.filter("class is not null")
        .groupBy("class")
        .agg(F.min(F.struct("doc_id", "text_hash", "line_no")).alias("f"))
    )
    where = F.struct("doc_id", "text_hash", "line_no")
    return placed.distinct().join(first, "class", "left").select(
        "doc_id",
        "text_hash",
        "line_no",
        F.when(F.col("id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        F.col("f.doc_id").alias("class_doc_id"),
        F.col("f.line_no").alias("class_line_no"),
        (F.col("f").isNull() | where.eqNullSafe(F.col("f"))).alias("kept"),
    )


def _rewrite(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                at = part.schema.get_field_index("text")
                texts, lost, left = part.column(at).to_pylist(), part.column("lost").to_pylist(), []
                for k, (text, gone) in enumerate(zip(texts, lost)):
                    if gone:
                        gone = set(gone)
                        lines = [x for i, x in enumerate(text.split("\n")) if i not in gone]
                        texts[k] = "\n".join(lines)
                    left.append(not gone or any(map(str.strip, texts[k].split("\n"))))
                out = part.set_column(at, "text", pa.array(texts, pa.string())).drop_columns(["lost"])
                yield record(schema, *out.filter(pa.array(left)).columns)

    return run


def dedup_lines(docs: DataFrame) -> DataFrame:
    """`docs` without the lines that repeat earlier ones; documents left without any line go.

    Columns stay as they are, but for the text and n_chars where there is one. Null text that
    loses nothing becomes empty.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    gone = line_classes(docs).filter("not kept").groupBy("doc_id", "text_hash")
    gone = gone.agg(F.collect_list("line_no").alias("lost"))  # no more than the document has lines
    gone = gone.withColumnsRenamed({"doc_id": "_doc_id", "text_hash": "_text_hash"})
    known = F.col("doc_id").cast("long").eqNullSafe(F.col("_doc_id")) & (F.xxhash64("text") == F.col("_text_hash"))
    marked = docs.join(gone, known, "left").select(*docs.columns, "lost")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = map_batches(marked, _rewrite(to_arrow_schema(docs.schema)), schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
