"""Connected components of links by alternating star steps.

The links are dealt out over tasks by their number, and each task unites what it
holds (union-find): a star per local component, so that repeated links go. One
task's worth of links is then done. More links go through rounds of two steps
that turn any graph into stars around each component's smallest node:

* small star: a node hands the smallest of its smaller neighbours to the others;
* large star: a link to a node that knows a smaller one moves there.

Both are a partial aggregation and an equi-join that Spark can split, so a node
with very many links is no hot key. A round at least halves the length of a
chain; the number of rounds is O(log² n). Each step is stored in the shared
folder and dropped once the next one is.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batch, drop, stored

LINKS_PER_TASK = 1 << 18

_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _unite(batches):
    """Union-find over one task's links: each node with its smallest one."""
    parent: dict[int, int] = {}

    def root(x):
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(p, p)
        return x

    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = list(parent)
    for lo in range(0, len(nodes), 1 << 16):
        part = [(x, r) for x in nodes[lo:lo + (1 << 16)] if (r := root(x)) != x]
        if part:
            yield batch(_LINKS, *zip(*part))


def _once(links: DataFrame) -> DataFrame:
    return links.groupBy("a", "b").agg(F.max("moved").alias("moved"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links (a, b), a > b: all smaller neighbours b of a, and a, to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    others = links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"), F.lit(1).alias("moved"))
    return _once(least.select("a", F.col("m").alias("b"), F.lit(0).alias("moved")).union(others))


def _large_star(links: DataFrame) -> DataFrame:
    """Links (a, b), a > b: a to the smallest neighbour of b instead, if that is smaller."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "b")
    moved = F.when(F.col("m").isNotNull(), 1).otherwise(F.col("moved"))
    return _once(links.join(least, "b", "left").select("a", F.coalesce("m", "b").alias("b"), moved.alias("moved")))


def stars(links: DataFrame) -> tuple[DataFrame, int]:
    """Stored links (a, b), a > b, as one star per component, and the rounds it took."""
    rounds = 0
    while True:
        rounds += 1
        small = stored(_small_star(links), "small")
        large = stored(_large_star(small), "large")
        drop(small)
        if rounds > 1:
            drop(links)
        links = large
        if links.where("moved = 1").isEmpty():
            return links, rounds


def components(links: DataFrame) -> DataFrame:
    """node and comp, the smallest node it is linked with over any number of
    links (a, b); the smallest nodes themselves are left out, as are nodes
    without links. An empty table gives an empty result. ``links`` is read
    twice: pass a stored table."""
    links = links.select("a", "b")
    tasks = max(1, -(-links.count() // LINKS_PER_TASK))
    local = stored(links.repartition(tasks).mapInArrow(_unite, "a long, b long"), "united")
    if tasks > 1:
        first, (local, _) = local, stars(local.withColumn("moved", F.lit(0)))
        drop(first)
    return local.select(F.col("a").alias("node"), F.col("b").alias("comp"))
