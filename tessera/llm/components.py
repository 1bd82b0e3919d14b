"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_small, release, saved


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) for every id that an edge names; component_id is the smallest id it can reach.

    Each step is a grouped minimum and a join, so no node's neighbours are ever collected; a hub only makes a
    skewed join side, which adaptive execution splits. Nulls and self-links are dropped; repeated edges count once. Steps are written to the shared
    folder, and the loop ends when a round leaves the edges unchanged (about log of the longest chain).
    """
    now = saved(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u <> v").distinct(),
        "links",
    )
    before = None
    while not now.isEmpty():
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        old, now = now, saved(small.where("u <> v").distinct(), "links")
        release(old)
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component_id"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(roots)


def hooked_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) for every id that an edge names and that can reach a smaller one; component_id is the smallest.

    For links that come in portions: what a portion joins is found from its own links, between components so far.
    In a round every id hooks on to the smallest id it is linked with, if that is smaller; pointers jump until they
    are at roots; only links between different roots go on. An id that stays a root for two rounds has taken in all its
    neighbours, so rounds grow with the log of the ids. A round shuffles a grouped minimum, and joins whose other
    side is too large to be broadcast. Nulls and self-links are dropped.
    """
    now = saved(_different(edges.select(a, b), a, b), "links")
    rounds = []
    while not now.isEmpty():
        roots = _at_roots(saved(now.groupBy("u").agg(F.min("v").alias("v")), "hooks"))
        rounds.append(roots)
        met = join_small(now, roots.withColumnRenamed("v", "a"), "u")
        met = join_small(met, roots.select(F.col("u").alias("v"), F.col("v").alias("b")), "v", "left")
        old, now = now, saved(_different(met.select("a", F.coalesce("b", "v").alias("b")), "a", "b"), "links")
        release(old)
    if not rounds:
        return now.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    out = rounds.pop()
    while rounds:
        below, above = rounds.pop(), out.select(F.col("u").alias("v"), F.col("v").alias("w"))
        out = saved(below.join(above, "v", "left").select("u", F.coalesce("w", "v").alias("v")).unionByName(out), "roots")
    return out.select(F.col("u").alias("id"), F.col("v").alias("component_id"))


def _different(edges: DataFrame, a: str, b: str) -> DataFrame:
    # the greatest of an id and null is that id, and so is the least
    return edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")


def _at_roots(hooks: DataFrame) -> DataFrame:
    """(u, root) of a saved forest (u, v), v < u: each step doubles the length of the way that a pointer has gone."""
    while True:
        above = hooks.select(F.col("u").alias("v"), F.col("v").alias("w"))
        step = join_small(hooks.select("u", "v"), above, "v", "left").select("u", F.coalesce("w", "v").alias("v"), F.col("w").isNotNull().alias("moved"))
        old, hooks = hooks, saved(step, "hooks")
        release(old)
        if hooks.where("moved").isEmpty():
            return hooks.select("u", "v")


def joined_blocks(close: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """(ids, smallest of them) of the components of a bipartite graph; every row and column is expanded once."""
    out = []
    todo_a, todo_b = close.any(axis=1), close.any(axis=0)
    for start in np.flatnonzero(todo_a):
        if not todo_a[start]:
            continue
        todo_a[start] = False
        rows, found = np.array([start]), [ids_a[[start]]]
        while len(rows):
            columns = np.flatnonzero(close[rows].any(axis=0) & todo_b)
            todo_b[columns] = False
            rows = np.flatnonzero(close[:, columns].any(axis=1) & todo_a) if len(columns) else columns
            todo_a[rows] = False
            found += [ids_b[columns], ids_a[rows]]
        found = np.concatenate(found)
        out.append((found, int(found.min())))
    return out


#: Links that a forest holds before it keeps their components alone.
FOREST_LINKS = 1 << 20


class Forest:
    """Components of links that come in portions, in memory that grows with the ids, not with the links."""

    def __init__(self) -> None:
        self._parts: list[np.ndarray] = []
        self._size = self._kept = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self._parts.append(np.stack([a, b]).astype(np.int64))
            self._size += len(a)
            if self._size > 2 * self._kept + FOREST_LINKS:
                self._parts = [self.roots()]
                self._size = self._kept = self._parts[0].shape[1]

    def add_close(self, close: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> None:
        """The links of a matrix, as its components where it has many."""
        if np.count_nonzero(close) <= 4 * sum(close.shape):
            i, j = np.nonzero(close)
            self.add(ids_a[i], ids_b[j])
        else:
            for found, least in joined_blocks(close, ids_a, ids_b):
                self.add(found, np.full(len(found), least))

    def roots(self) -> np.ndarray:
        """[2, n]: ids that reach a smaller one, and the smallest that they reach."""
        ids, at = np.unique(np.concatenate([np.zeros((2, 0), np.int64), *self._parts], axis=1), return_inverse=True)
        a, b = at.reshape(2, -1)
        root = least_reached(len(ids), a, b)
        moved = np.flatnonzero(root != np.arange(len(ids)))
        return np.stack([ids[moved], ids[root[moved]]])


def least_reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """By place, the smallest place that edges (a, b) reach."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            return root
