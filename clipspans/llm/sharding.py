"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At each level a row draws one number per child from the hash of (key, child path) and descends to the child with the
least ``-ln(u) / weight``: a child is chosen in proportion to its weight, and when a weight changes, rows move only into
or out of that child's subtree. A shard that is added beyond the base layout opens a region of its own, so that it takes
rows only into itself and moves none between the others. The tree is a literal of the plan: its size depends on the
number of shards, not on the data.

Slots number each shard's rows from 0 without gaps. Rows are ordered by (a hash bucket of the key, key, text checksum); the
bucket counts, ``shards * SLOT_BUCKETS`` numbers at most, give each bucket's first slot, so that no task holds a shard.

Defined results: a null key is a key like any other; equal keys share a shard; a null text has size 8 and checksum 0;
rows that are equal in key and text get their slots in any order. Other columns pass through ``assign``; an empty table
gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from clipspans.llm.common import column, free_name, table

LAYOUT = (2, 3, 4)
SHARDS = 24
SLOT_BUCKETS = 256

#: A tree is a list of (name, weight, children), a leaf has its shard number in place of the children.
Tree = list


def tree(shards: int, layout: tuple[int, int, int] = LAYOUT) -> Tree:
    """The base layout holds the first shards; each further one is a region of its own. All shards weigh 1."""
    regions, racks, per = layout
    out, n = [], 0
    for r in range(regions):
        rack_list = []
        for k in range(racks):
            leaves = [(f"{r}.{k}.{s}", 1.0, n + s) for s in range(per) if n + s < shards]
            n += per
            if leaves:
                rack_list.append((f"{r}.{k}", float(len(leaves)), leaves))
        if rack_list:
            out.append((f"{r}", sum(x[1] for x in rack_list), rack_list))
    for s in range(n, shards):
        out.append((f"own{s}", 1.0, [(f"own{s}.0", 1.0, [(f"own{s}.0.0", 1.0, s)])]))
    return out


def _draw(key: Column, name: str, weight: float) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(name), key), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(u) / F.lit(weight)


def shard_of(key: Column, nodes: Tree) -> Column:
    """The shard number for ``key``: one weighted draw per level on the way down."""
    if not isinstance(nodes, list):
        return F.lit(nodes).cast("int")
    if len(nodes) == 1:
        return shard_of(key, nodes[0][2])
    draws = [_draw(key, name, weight) for name, weight, _ in nodes]
    least = F.least(*draws)
    pick = [(draws[i] == least, shard_of(key, nodes[i][2])) for i in range(len(nodes))]
    return reduce(lambda rest, p: F.when(p[0], p[1]).otherwise(rest), reversed(pick[:-1]), pick[-1][1])


def text_checksum(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def assign(docs: DataFrame, key: str = "doc_id", tie: Column | None = None, nodes: Tree | None = None) -> DataFrame:
    """``docs`` with shard and slot (names get underscores in front where taken).

    tie orders the rows of one key, and spreads them over the slot buckets; the checksum of ``text`` by default."""
    shard, slot = free_name(docs, "shard"), free_name(docs, "slot")
    crc = text_checksum(F.col("text")) if tie is None else tie
    names = [*docs.columns, shard, slot]
    k, b, place = (free_name(docs.select(*[column(c) for c in docs.columns], F.lit(0).alias(shard), F.lit(0).alias(slot)), n) for n in ("k", "b", "place"))
    rows = docs.withColumn(k, F.xxhash64(F.lit("slot"), column(key), crc)).withColumn(shard, shard_of(column(key), nodes or tree(SHARDS)))
    rows = rows.withColumn(b, F.pmod(column(k), F.lit(SLOT_BUCKETS)).cast("int"))
    counts = rows.groupBy(F.col(shard).alias("s"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
    first = counts.select("s", "b", F.coalesce(before, F.lit(0).cast("bigint")).alias("first"))
    # the bucket counts under one struct, whose name is free too
    bucket = free_name(rows, "bucket")
    first = first.select(F.struct("s", "b", "first").alias(bucket))  # SHARDS * SLOT_BUCKETS rows
    rows = rows.withColumn(place, F.row_number().over(Window.partitionBy(shard, b).orderBy(k, column(key), crc)) - 1)
    rows = rows.join(F.broadcast(first), (F.col(shard) == F.col(bucket)["s"]) & (F.col(b) == F.col(bucket)["b"]))
    return rows.withColumn(slot, F.col(bucket)["first"] + F.col(place)).select(*[column(c) for c in names])


def op6_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"), text_checksum(F.col("text")).alias("text_crc32"))
    found = assign(docs, tie=F.col("text_crc32"))
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", shard_of(F.col("doc_id"), tree(SHARDS + 1)).alias("grown_shard"))
