"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import materialize


def connected_components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """(node, component): the smallest node that links (a, b) lead to, for every node that has one.

    Alternates two steps until nothing changes. Large star: each node points its larger neighbours to
    its smallest one. Small star: each node points its smaller neighbours, and itself, to the smallest
    of them. Both shrink paths fast, and a hub's neighbours stay rows of a table. Every round is
    written, so lineage stays short and the joins are between stored tables, which adaptive execution
    can split at hubs. Null ends and loops are left out; an empty table gives no rows.

    ``most``, where it is known, is about how many links there are at most. No round has more links than
    the one before, so the tables are as few files as their rows ask for.
    """
    known = edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    pairs = known.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    stars = materialize(pairs.distinct(), "stars", rows=most)
    mark = _mark(stars)
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(materialize(low, "star_low", rows=2 * mark[0]), "u").filter(F.col("v") > F.col("u"))
        large = materialize(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "star_large", rows=mark[0])
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "star_low", rows=mark[0])
        small = large.join(low, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v")))
        stars = materialize(small.distinct(), "stars", rows=mark[0])
        now = _mark(stars)
        if now == mark:
            break
        mark = now
    roots = stars.select(F.col("v").alias("node")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _mark(stars: DataFrame) -> tuple:
    """Number of rows and an order-free digest of them."""
    return tuple(stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


class Forest:
    """Union-find over the rows of one task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y
