"""Near-duplicate vectors by a pivot-permutation index.

Reference points are taken from the vectors. Each vector is described by its `PREFIX` nearest
points in order. It is posted in the inverted list of each of them, per label; vectors whose
descriptions share at least `SHARED` points are candidates, and a cosine in double precision
decides. A pair is looked at in the list of its first common point alone. Lists longer than
`BLOCK` are cut into blocks that meet pairwise, so no task holds more than two blocks.

Equal vectors of a label are one class from the start, with a weight. A vector that is null, zero,
or holds a null or non-finite component, and one with a null label, links with nothing; so does a
row with a null vec_id, whose component is null. Vectors of different length are not compared.
Repeated rows count as further vectors, and so do different rows with one vec_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, map_groups, record, stored
from .components import Forest, components

PREFIX, SHARED = 8, 2
BLOCK = 512
#: Reference points: this many times the root of the number of classes, within bounds. They are
#: the classes with the smallest id hashes, at most MOST_POINTS vectors.
POINTS, LEAST_POINTS, MOST_POINTS = 2, 32, 4096
_POSTED = "id long, weight long, label string, point int, description array<int>, vector array<double>"


def _describe(points, prefix: int):
    schema = pa.schema(
        [("id", pa.int64()), ("weight", pa.int64()), ("label", pa.string()), ("point", pa.int32()),
         ("description", pa.list_(pa.int32())), ("vector", pa.list_(pa.float64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = points.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512).to_pydict()
                for size in sorted(set(map(len, part["vector"]))):
                    rows = [i for i, v in enumerate(part["vector"]) if len(v) == size]
                    x = np.array([part["vector"][i] for i in rows], float)
                    x /= np.abs(x).max(1, keepdims=True)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    own = known[size]
                    order = np.argsort(-(x @ own.T), axis=1, kind="stable")[:, :prefix]
                    out = [
                        (part["id"][i], part["weight"][i], part["label"][i], int(p), d, v)
                        for i, d, v in zip(rows, order.tolist(), x.tolist())
                        for p in d
                    ]
                    yield record(schema, *zip(*out))

    return run


def _verify(threshold: float, shared: int):
    schema = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        ids = group.column("id").to_numpy()
        weight = group.column("weight").to_numpy()
        part = group.column("part").to_numpy()
        point, low, high = (group.column(c)[0].as_py() for c in ("point", "low", "high"))
        # Vectors of one list have one length.
        x = np.array(group.column("vector").combine_chunks().flatten()).reshape(len(ids), -1)
        described = np.array(group.column("description").combine_chunks().flatten()).reshape(len(ids), -1)
        left = np.flatnonzero(part == low)
        right = left if low == high else np.flatnonzero(part == high)
        names, cell = np.unique(described, return_inverse=True)
        held = np.zeros((len(ids), len(names)), np.float32)
        held[np.repeat(np.arange(len(ids)), described.shape[1]), cell.ravel()] = 1
        common = held[left] @ held[right].T
        earlier = held[:, names < point]
        first = (earlier[left] @ earlier[right].T) == 0
        i, j = np.nonzero((common >= shared) & first)
        i, j = left[i], right[j]
        near = np.empty(len(i), bool)
        for at in range(0, len(i), 8192):  # one way to add up, whatever the list
            near[at : at + 8192] = np.einsum("ij,ij->i", x[i[at : at + 8192]], x[j[at : at + 8192]]) >= threshold
        i, j = i[near], j[near]
        if low == high:
            i, j = i[i < j], j[i < j]
        links = np.bincount(i, weight[j], len(ids)) + np.bincount(j, weight[i], len(ids))
        forest = Forest(len(ids))
        for a, b in zip(i.tolist(), j.tolist()):
            forest.join(a, b)
        some = np.flatnonzero(links)
        root = [int(ids[forest.root(int(k))]) for k in some]  # ids ascend, so a root is the least id
        return pa.Table.from_batches([record(schema, ids[some], links[some].astype(np.int64), root)])

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """One row per row of `vectors` (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), x.alias("vector"))
    bad = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~bad & F.exists("vector", lambda v: v != 0)
    rows = rows.select(
        "vec_id", "label", F.coalesce(good, F.lit(False)).alias("good"), "vector",
        F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2"),
    )
    classes = stored(
        rows.filter("good").groupBy("label", "h1", "h2").agg(
            F.min("vec_id").alias("least"), F.count("*").alias("weight"), F.first("vector").alias("vector")
        ).withColumn("id", F.monotonically_increasing_id()),
        "pivot-classes",
    )
    sized = classes.groupBy(F.size("vector").alias("size")).count().collect()  # one row per vector length
    points = {}
    for s in sized:
        wanted = min(MOST_POINTS, max(LEAST_POINTS, int(POINTS * s["count"] ** 0.5)))
        sample = classes.filter(F.size("vector") == s["size"]).orderBy(F.xxhash64("least"), "label", "h1").limit(wanted)
        p = np.array([r["vector"] for r in sample.select("vector").collect()], float)
        p /= np.abs(p).max(1, keepdims=True)
        points[s["size"]] = p / np.linalg.norm(p, axis=1, keepdims=True)
    shared = spark.sparkContext.broadcast(points)
    posted = map_batches(classes.select("id", "weight", "label", "vector"), _describe(shared, PREFIX), _POSTED)
    posted = stored(posted.withColumn("size", F.size("vector")), "pivot-postings")
    lists = posted.groupBy("label", "size", "point").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = posted.join(lists, ["label", "size", "point"])
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("id"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))
    found = stored(
        map_groups(
            dealt.select("label", "size", "point", "low", "high", "part", "id", "weight", "description", "vector"),
            ["label", "size", "point", "low", "high"], _verify(threshold, SHARED), "id long, links long, root long",
        ),
        "pivot-links",
    )
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    grouped = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    # Classes have numbers of their own, as rows of one vec_id may lie in several; a component is
    # named by the smallest vec_id in it.
    members = classes.select("id", "label", "h1", "h2", "least", "weight").join(grouped, "id", "left")
    members = members.withColumn("component", F.coalesce("component", "id"))
    names = members.groupBy("component").agg(F.min("least").alias("component_id"))
    known = (
        members.join(names, "component")
        .join(links, "id", "left")
        .select("label", "h1", "h2", F.col("weight") - 1 + F.coalesce("links", F.lit(0)), "component_id")
        .toDF("label", "h1", "h2", "n_links", "component_id")
    )
    own = rows.filter("good").select("vec_id", "label", "h1", "h2").join(known, ["label", "h1", "h2"])
    rest = rows.filter("not good").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    both = own.select("vec_id", "n_links", "component_id").union(rest)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
