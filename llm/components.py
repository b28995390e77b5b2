"""Connected components of a graph that no machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``links`` (columns a, b; any order).

    Distributed union-find by alternating large and small stars: every step hangs nodes below the smallest node known
    in their neighbourhood, and the number of steps grows with the logarithm of the longest path. A step is an
    aggregation, combined before its shuffle, and a join whose skewed side the adaptive plan splits; it is written to
    the shared folder, so a lost executor repeats one step only. Links of a node to itself and links with a null end
    say nothing and are left out; without links there are no rows.
    """

    def ordered(df: DataFrame) -> DataFrame:
        return df.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())

    edges = written(ordered(links), "links")
    now = state(edges)
    while now[0]:
        ends = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ends.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), F.least("m", "a").alias("m"))
        large = edges.join(least, "b").select("a", F.col("m").alias("b")).distinct()
        parent = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(parent, "a")
        small = met.select("a", F.col("m").alias("b")).unionAll(met.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        edges, before = written(small.distinct(), "links"), now
        now = state(edges)
        if now == before:
            break
    return (
        edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        .unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
    )


def extended_components(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``connected_components`` of the links that made ``parts`` (node, component) and of more ``links`` (a, b): only what
    the new links join is worked out anew, on components instead of nodes."""
    of = lambda end, name: parts.select(F.col("node").alias(end), F.col("component").alias(name))
    ends = links.join(of("a", "pa"), "a", "left").join(of("b", "pb"), "b", "left")
    ends = ends.select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b"))
    more = written(connected_components(ends), "components")
    moved = more.select(F.col("node").alias("component"), F.col("component").alias("to"))
    known = parts.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return known.unionAll(more.join(parts.select("node"), "node", "left_anti").select("node", "component"))


class Forest:
    """Union-find over 0..n-1 inside one bounded task."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True
