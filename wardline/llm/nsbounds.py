"""Centroid clustering with ns-bounds, in whole numbers.

Every vector keeps an upper bound of the distance to its own centroid and a lower bound to each
other one, all as they were when last evaluated, with the round of that evaluation. The history of
the centroids is kept too. In a later round a bound is loosened by the norm of the centroid's
total displacement since then, which is never more than the sum of its moves round by round.
Where a loosened lower bound still lies above the upper bound nothing is computed; where that
fails, the upper bound is evaluated anew, and what fails again is rescanned exactly, in integers.

Vectors travel in blocks of `BLOCK`, packed with their bounds in one row. A round reads the blocks
of the one before, writes its own and removes what no later round needs, so two rounds are on disk
at a time. A task adds up its own vectors; only sums per centroid and component are shuffled, and
no more than centroids x components numbers reach the driver, whatever the input.

Vectors that are null, have another number of components, or hold a null or non-finite component
take no part and have no row. A null vec_id is kept but never a first centroid; repeated rows
count as further vectors, and rows with one vec_id are told apart by their components. With fewer
vectors than centroids there are as many centroids as vectors; an empty table gives no rows.
Components beyond 2^27 after scaling are refused: squared distances would not fit a long.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, map_batches, record, stored

BLOCK = 256
#: Largest scaled component: 64 squared differences of twice that size stay below 2^63.
LARGEST = 1 << 27
_BLOCKS = pa.schema(
    [("ids", pa.list_(pa.int64())), ("x", pa.binary()), ("bounds", pa.binary()),
     ("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]
)
_BLOCKS_DDL = "ids array<long>, x binary, bounds binary, cluster int, n long, sums array<long>"


def bounds_type(k: int) -> np.dtype:
    """Own centroid, upper bound and its round; a lower bound per centroid and its round."""
    return np.dtype(
        [("own", "<i4"), ("upper", "<f8"), ("upper_at", "<i2"), ("lower", "<f8", (k,)), ("lower_at", "<i2", (k,))]
    )


def distances(x: np.ndarray, centroids: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Exact squared distances of vectors `rows` to centroids `columns`, pair by pair."""
    out = np.empty(len(rows), np.int64)
    for at in range(0, len(rows), 4096):
        part = slice(at, at + 4096)
        apart = x[rows[part]].astype(np.int64) - centroids[columns[part]]
        out[part] = np.einsum("ij,ij->i", apart, apart)
    return out


def _apart(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Whether the lower bounds are above the upper ones by more than rounding could be wrong."""
    return lower > upper * (1 + 1e-9) + 1e-6


def first_bounds(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    n, k = len(x), len(centroids)
    rows, columns = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    squares = distances(x, centroids, rows, columns).reshape(n, k)
    out = np.zeros(n, bounds_type(k))
    out["own"] = squares.argmin(1)  # the first of equals
    out["lower"] = np.sqrt(squares)
    out["upper"] = out["lower"][np.arange(n), out["own"]]
    return out


def next_bounds(x: np.ndarray, bounds: np.ndarray, history: np.ndarray) -> int:
    """Moves the bounds to the last centroids of `history`; returns how many distances that took."""
    now, k = len(history) - 1, history.shape[1]
    moved = np.sqrt(((history[-1] - history) ** 2).sum(2).astype(float))  # round x centroid
    every = np.arange(len(x))
    upper = bounds["upper"] + moved[bounds["upper_at"], bounds["own"]]
    lower = bounds["lower"] - moved[bounds["lower_at"], np.arange(k)]
    lower[every, bounds["own"]] = np.inf
    rows = np.flatnonzero(~_apart(lower, upper[:, None]).all(1))
    took = len(rows)
    if not took:
        return 0
    own = bounds["own"][rows]
    best = distances(x, history[-1], rows, own)
    bounds["upper"][rows], bounds["upper_at"][rows] = np.sqrt(best), now
    at, column = np.nonzero(~_apart(lower[rows], bounds["upper"][rows][:, None]))
    took += len(at)
    if not len(at):
        return took
    squares = distances(x, history[-1], rows[at], column)
    bounds["lower"][rows[at], column] = np.sqrt(squares)
    bounds["lower_at"][rows[at], column] = now
    # The old centroid's distance is a bound like the others from here on.
    bounds["lower"][rows, own], bounds["lower_at"][rows, own] = np.sqrt(best), now
    scanned = np.full((len(rows), k), np.iinfo(np.int64).max)
    scanned[at, column] = squares
    scanned[np.arange(len(rows)), own] = best
    nearest = scanned.argmin(1)
    bounds["own"][rows] = nearest
    bounds["upper"][rows] = np.sqrt(scanned[np.arange(len(rows)), nearest])
    return took


def _pack(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                ids = part.column("vec_id").to_pylist()
                yield record(_BLOCKS, [ids], [x.astype("<i4").tobytes()], [None], [None], [None], [None])

    return run


def _vectors(batch: pa.RecordBatch, i: int, dims: int, k: int) -> tuple[np.ndarray, np.ndarray | None]:
    x = np.frombuffer(batch.column("x")[i].as_buffer(), "<i4").reshape(-1, dims)
    packed = batch.column("bounds")[i].as_buffer()
    return x, None if packed is None else np.frombuffer(packed, bounds_type(k)).copy()


def _moved(batch: pa.RecordBatch, i: int, history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, k, dims = history.shape
    x, bounds = _vectors(batch, i, dims, k)
    if bounds is None:
        bounds = first_bounds(x, history[0])
    else:
        next_bounds(x, bounds, history)
    return x, bounds


def _round(history):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = history.value
        _, k, dims = known.shape
        sums, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                x, bounds = _moved(batch, i, known)
                n += np.bincount(bounds["own"], minlength=k)
                order = np.argsort(bounds["own"], kind="stable")
                held, first = np.unique(bounds["own"][order], return_index=True)
                sums[held] += np.add.reduceat(x[order].astype(np.int64), first)
                row = [[batch.column("ids")[i].as_py()], [batch.column("x")[i].as_py()], [bounds.tobytes()]]
                yield record(_BLOCKS, *row, [None], [None], [None])
        for c in np.flatnonzero(n):
            yield record(_BLOCKS, [None], [None], [None], [int(c)], [int(n[c])], [sums[c]])

    return run


_ASSIGNED = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])


def _assign(history):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = history.value
        for batch in batches:
            for i in range(batch.num_rows):
                x, bounds = _moved(batch, i, known)
                squares = distances(x, known[-1], np.arange(len(x)), bounds["own"])
                yield record(_ASSIGNED, batch.column("ids")[i].as_py(), bounds["own"], squares)

    return run


def kept(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """(vec_id, x) of the vectors that take part, x in whole numbers."""
    v = F.col("v")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.filter((F.size(v) == dims) & ~bad)

    def scaled(c):
        whole = F.floor(c * scale)
        fits = F.abs(c * scale) <= LARGEST
        return F.when(fits, whole).otherwise(F.raise_error(F.lit("a component is too large for exact distances")).cast("long"))

    return rows.select("vec_id", F.transform(v, scaled).alias("x"))


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3"
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 per vector that takes part.

    The first centroids are the k vectors with the smallest sha256 of `seed:vec_id`.
    """
    spark = vectors.sparkSession
    rows = kept(vectors, dims, scale)
    named = rows.filter("vec_id is not null").withColumn(
        "h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    )
    first = [r["x"] for r in named.orderBy("h", "x").limit(k).collect()]
    columns = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], columns)
    history = np.array([first], np.int64)
    now = stored(map_batches(rows, _pack(dims), _BLOCKS_DDL), "ns-blocks")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(history)
        before, now = now, stored(map_batches(now.filter("cluster is null"), _round(shared), _BLOCKS_DDL), "ns-round")
        shared.destroy()
        discard(before)
        parts = now.filter("cluster is not null").select("cluster", "n", F.posexplode("sums").alias("at", "part"))
        wide = "decimal(38,0)"
        sums = parts.groupBy("cluster", "at").agg(F.sum(F.col("part").cast(wide)).alias("s"), F.sum("n").alias("n"))
        centroids = history[-1].copy()
        for r in sums.collect():  # at most k x dims rows
            centroids[r["cluster"], r["at"]] = int(r["s"]) // r["n"]
        history = np.concatenate((history, centroids[None]))
    shared = spark.sparkContext.broadcast(history)
    assigned = stored(
        map_batches(now.filter("cluster is null"), _assign(shared), "vec_id long, cluster int, distance long"), "ns-assigned"
    )
    shared.destroy()
    discard(now)
    total = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in history[-1].tolist()]
    facts = [(c, total[c], sum(total.values()), digest[c]) for c in sorted(total)]
    table = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row per centroid: at most k.
    return assigned.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
