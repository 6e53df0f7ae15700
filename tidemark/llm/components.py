"""Connected components of a graph given as a table of links, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import ship
from tidemark.session import materialize

#: Nodes that a task keeps while it thins its links.
NODES = 1 << 20


class Forest:
    """Joins nodes; remembers only links that joined something new."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, node: int) -> int:
        parent = self.parent
        while (up := parent.get(node, node)) != node:
            parent[node] = node = parent.get(up, up)
        return node

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        low, high = (a, b) if a < b else (b, a)
        self.parent[high] = low
        self.parent.setdefault(low, low)
        return True


def thin(links: DataFrame) -> DataFrame:
    """Links with the same components, at most one for each node of a task. Columns ``a`` and ``b``."""
    ship(links.sparkSession)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            pairs = zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True)
            yield _links([(a, b) for a, b in pairs if forest.join(a, b)])
            if len(forest.parent) > NODES:
                forest = Forest()

    return links.select("a", "b").mapInArrow(keep, "a long, b long")


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node of its component, for every node that has a link to a smaller one.

    Links are columns ``a`` and ``b``, never NULL; loops and repeated links are fine. Every round hangs the larger
    neighbours of each node, then the node and its smaller neighbours, on its smallest neighbour, until nothing
    changes. Rounds grow with the logarithm of the longest path, and each is written to the shared folder.
    """
    a, b = F.col("a"), F.col("b")
    edges = thin(links.where(a != b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    edges = materialize(edges, "components")
    before = None
    while (now := _checksum(edges)) != before:
        before = now
        both = edges.union(edges.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(b > a).select(b.alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
        edges = materialize(small.union(least.select("a", "m")).distinct(), "components")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _checksum(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())
