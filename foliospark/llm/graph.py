"""Connected components by rounds of large and small stars, for graphs of any size and shape."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.sources.tables import cut

#: Neighbours of a node from which on its rows are spread over SALTS tasks.
HUB, SALTS = 10_000, 16
#: Edges that one task joins.
FEW = 200_000


def _with_least(both: DataFrame) -> DataFrame:
    """Adds to each edge (u, v) the least of u and its neighbours. The edges of hubs are dealt out by the other end, and only the minima of
    hubs are copied; which nodes are hubs is known from the count that gives the minima."""
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
    hubs = least.where(F.col("n") > HUB).select("u", F.lit(True).alias("hub"))
    salt = F.when(F.col("hub"), F.pmod(F.xxhash64("v"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    dealt = both.join(hubs, "u", "left").withColumn("s", salt)
    salted = least.withColumn("s", F.explode(F.when(F.col("n") > HUB, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    return dealt.join(salted, ["u", "s"]).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    marked = _with_least(down)
    return marked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(marked.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Components of a few edges, by union of sets that are named by their least node."""
    above: dict = {}

    def least(x):
        root = x
        while above.get(root, root) != root:
            root = above[root]
        while above.get(x, x) != root:
            above[x], x = root, above[x]
        return root

    for pdf in batches:
        for u, v in zip(pdf["u"].tolist(), pdf["v"].tolist()):
            a, b = least(u), least(v)
            above.setdefault(a, a)
            above.setdefault(b, b)
            above.setdefault(u, a)
            above.setdefault(v, b)
            above[max(a, b)] = min(a, b)
    nodes = list(above)
    if nodes:
        yield pd.DataFrame({"node": nodes, "component": [least(x) for x in nodes]})


def components(edges: DataFrame, max_rounds: int = 50, few: int = FEW) -> DataFrame:
    """``(node, component)`` for each node of the edges ``(u, v)``; component is the least node.

    Nodes are of any orderable type. Edges to oneself, repeated edges and edges with a null end are
    allowed and ignored; a node that has no other edge isn't in the result. Each round is
    checkpointed; only a count and a checksum reach the driver. The number of rounds grows with
    the logarithm of the longest path. As soon as ``few`` edges or fewer are there, one task joins them.
    """
    now = cut(edges.select("u", "v").where("u != v").distinct())
    kind = now.schema["u"].dataType.simpleString()
    n, seen = now.count(), None
    for _ in range(max_rounds):
        if n <= few:
            return now.coalesce(1).mapInPandas(_joined, f"node {kind}, component {kind}")
        now = cut(_small_star(_large_star(now)))
        mark = tuple(now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(pmod(xxhash64(v, u), 1000003))")).first())
        if mark == seen:
            break
        n, seen = mark[0], mark
    else:
        raise RuntimeError(f"components are still changing after {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
