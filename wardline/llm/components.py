"""Connected components by alternating stars, and join work dealt out by blocks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a")
    return (
        moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(moved.select("a", F.col("m").alias("b")))
        .filter("a <> b")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of an edge list (a, b): the smallest id reachable.

    Each round is written out, which cuts lineage; two rounds that agree end it. Rounds grow with
    the logarithm of the longest chain, and no node keeps more edges than it has neighbours.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    now = stored(edges.filter("a <> b").select(a.alias("a"), b.alias("b")).distinct(), "edges")
    seen = None
    while True:
        now = stored(_small_star(_large_star(now)), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def block_pairs(keys: DataFrame, weights: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Deal rows that share a key into blocks, and say which blocks have to meet.

    `keys` has (key, id), repeats allowed, and `weights` (id, weight). An id lives in one block:
    that of its most shared key, which is cut into blocks of about `most` weight. Two blocks meet
    if any key has ids in both, once for all keys they share. So every two ids with a common key
    meet in exactly one pair of blocks, each id is sent once per pair and not once per key, and
    no task gets more than two blocks.
    Returns (home: id, block; pairs: a, b with a <= b).
    """
    shared = keys.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    live = keys.join(shared.filter("low < high").select("key"), "key").distinct()
    live = stored(live.join(weights, "id").select("key", "id", "weight"), "block-keys")
    size = live.groupBy("key").agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
    home = live.join(size, "key").groupBy("id").agg(F.max(F.struct("n", "key", "w")).alias("h"))
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("h.w") / most))
    home = stored(home.select("id", F.xxhash64("h.key", part).alias("block")), "block-home")
    sizes = home.groupBy("block").count()
    at = stored(live.join(home, "id").select("key", "block").distinct(), "block-at")
    a = at.select("key", F.col("block").alias("a"))
    b = at.select("key", F.col("block").alias("b"))
    across = a.join(b, "key").filter("a < b").select("a", "b").distinct()
    within = sizes.filter("count > 1").select(F.col("block").alias("a"), F.col("block").alias("b"))
    return home, stored(across.union(within), "block-pairs")


def meet(home: DataFrame, pairs: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """`rows` (id, ...) once per pair of blocks, with a, b and second (true for rows of b alone)."""
    sides = pairs.select("a", "b", F.col("a").alias("block")).union(
        pairs.filter("a <> b").select("a", "b", F.col("b").alias("block"))
    )
    dealt = sides.join(home, "block").withColumn("second", F.col("block") != F.col("a")).drop("block")
    return dealt.join(rows, "id") if rows is not None else dealt


class Forest:
    """Union-find over 0..n-1 within one task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)

    def stars(self, ids: np.ndarray) -> tuple[list[int], list[int]]:
        """Each node that has a link, with the smallest id of its tree."""
        trees: dict[int, list[int]] = {}
        for i in range(len(self.up)):
            trees.setdefault(self.root(i), []).append(int(ids[i]))
        a, b = [], []
        for members in trees.values():
            least = min(members)
            for m in members:
                if m != least:
                    a.append(m)
                    b.append(least)
        return a, b
