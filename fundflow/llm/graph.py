"""Connected components of an edge table, distributed."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundflow.operators.stage import stage


class UnionFind:
    """Union-find over any ids; the smallest id of a set is its root."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        p = self.parent
        root = x
        while p.setdefault(root, root) != root:
            root = p[root]
        while p[x] != root:
            p[x], x = root, p[x]
        return root

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over each batch of edges: a star per set, no more rows than came."""
    for pdf in batches:
        uf = UnionFind()
        for a, b in zip(pdf["u"].tolist(), pdf["v"].tolist()):
            uf.union(a, b)
        nodes = [x for x in uf.parent if uf.find(x) != x]
        yield pd.DataFrame({"u": [uf.find(x) for x in nodes], "v": nodes}, dtype="int64")


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)`` (long ids): root is
    the smallest id reachable.  Self-loops, repeated and reversed edges are
    fine; an empty table gives no rows.

    Each round contracts the edges inside every Arrow batch by union-find, then
    does a large-star and a small-star step: every node links its larger, then
    its smaller neighbours to the smallest one.  Rounds go on until the edges
    are stars; on star-like duplicates two or three do.  Each round is written
    to the shared folder, so lineage stays short.  Minima are aggregated before
    the shuffle and written before they are joined: so the join has a hub's
    edges as a plain side, not one that the aggregation has already dealt,
    and adaptive execution splits it.
    """
    def star(e: DataFrame, larger: bool) -> DataFrame:
        """Link the larger (or the smaller) neighbours of each node to its
        smallest neighbour or itself."""
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), f"{name}-low")
        linked = both.filter("v > u" if larger else "v < u").join(low, "u")
        out = linked.select(F.col("m").alias("u"), "v").filter("u <> v")
        if not larger:
            out = out.union(low.filter("m < u").select(F.col("m").alias("u"), F.col("u").alias("v")))
        return out.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()

    def mark(e: DataFrame) -> tuple:
        """Equal before and after a round only when nothing moved."""
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return int(r[0]), r[1]

    e = edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    e = stage(e.mapInPandas(_contract, "u long, v long").distinct(), name)
    seen = mark(e)
    while seen[0]:
        large = stage(star(e, True), f"{name}-large")
        e = stage(star(large.mapInPandas(_contract, "u long, v long"), False), name)
        now = mark(e)
        if now == seen:
            break
        seen = now
    # Stars: u is the smallest id, v every other.
    return e.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
        e.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
