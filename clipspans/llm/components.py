"""Connected components of an edge list by alternating large-star and small-star steps.

Every step is a grouped minimum and an equi-join on the node; the edge list is written to the shared folder after each
round, so no lineage builds up, and nothing but its size and checksum reaches the driver."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipspans.llm.common import small, stored

#: Edges of a part, which one task reduces in its memory.
PART_EDGES = 200_000


def _with_least(edges: DataFrame, n: int) -> DataFrame:
    """(u, v, m): both directions' edges, m the least of u and its neighbours. While ``n``, which bounds the rows of the minima, is small,
    they are broadcast, so that a hub's edges stay where they are."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(small(least, n), "u").withColumn("m", F.least("u", "m"))


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (node, least node of its group) of the groups that a part's edges make."""
    parent: dict[str, str] = {}

    def top(x: str) -> str:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            low, high = sorted((top(u), top(v)))
            parent[high] = low
    found = [(x, top(x)) for x in list(parent) if top(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([r for _, r in found], pa.string())], ["u", "v"])


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).cast("string")).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the least node of its component."""
    edges = stored(edges.where("u <> v").select("u", "v"))
    # parts of a bounded size first keep only what connects them: dense groups have many more edges than nodes
    parts = -(-edges.count() // PART_EDGES)
    if parts:
        edges = stored(edges.repartition(parts).mapInArrow(_forest, "u string, v string").distinct())
    before = _state(edges)
    while before[0]:
        large = _with_least(_both(edges), 2 * before[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        star = _with_least(large, 2 * before[0])
        star = star.select("u", F.col("m").alias("v")).unionByName(star.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = stored(star.where("u <> v").distinct())
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
