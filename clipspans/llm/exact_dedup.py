"""Exact deduplication with keyed streaming state.

Each row's text (null counts as empty) is normalised, hashed, and sent as a small arrival record (digest, id, content
locator) through a Structured Streaming aggregation keyed by digest. Its state lives in RocksDB, has no watermark and
never expires; it retains, per digest, how many rows came and which row stays, with that row's content locator (Parquet
file and row number). Partial aggregation before the state shuffle turns a hot digest into one record per task and batch.
After the stream, the full bytes of every row with a hit are compared with the bytes of the row that its digest retains.
Where bytes differ (a digest collision) the digest's rows are grouped anew by their full text, so no two different texts
are ever taken as equal.

Defined results: null texts equal empty ones; a null id is smaller than all others; among rows with equal text and id
the one with the greatest locator stays; repeated rows all count. An empty table gives an empty result. Other columns,
whatever their names, pass through ``deduplicate`` unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipspans.llm.common import MAX_NARROW, ascii_lower, column, located, locator, shared_dir, stored, table, within, without

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Set while a state stream runs. Without the second, each state partition reserves 4 MB for its log files in advance.
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}
#: Rows of a digest from which its rows aren't gathered.
HOT = 10_000
ARRIVAL = "digest string, id bigint, file string, row bigint"


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _keyed(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """``docs`` with norm and digest in place of text."""
    norm = ascii_lower(F.coalesce("text", F.lit("")))
    return docs.withColumn("norm", norm).drop("text").withColumn("digest", digest(F.col("norm")))


def update_state(arrivals: DataFrame, sink: str, checkpoint: str) -> None:
    """Runs all waiting arrivals (a streaming DataFrame of ARRIVAL) through the keyed state; changed entries go to ``sink``.

    A later call with the same checkpoint and a longer stream goes on from the retained state. A batch that is run again
    after a failure overwrites its own folder."""
    spark = arrivals.sparkSession
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    state = arrivals.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "file", "row")).alias("keep"))

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{sink}/batch={batch}")

    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        query = state.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def retained(spark: SparkSession, sink: str) -> DataFrame:
    """The newest entry of each digest: digest, n, keep."""
    changed = spark.read.schema("digest string, n bigint, keep struct<id: bigint, file: string, row: bigint>, batch bigint").parquet(sink)
    return changed.groupBy("digest").agg(F.max("n").alias("n"), F.max("keep").alias("keep"))


def classes(docs: DataFrame, text: str = "text", id: str = "doc_id", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of ``docs``: file, row (its locator), id, digest, keep_id, group_size, kept."""
    docs = located(docs)
    spark = docs.sparkSession
    rows = _keyed(docs.select(column(id).cast("bigint").alias("id"), column(text).alias("text"), *locator(docs)), digest)
    base = shared_dir(spark)
    rows.select("digest", "id", "file", "row").write.parquet(f"{base}/arrivals")
    arrivals = spark.read.schema(ARRIVAL).parquet(f"{base}/arrivals")
    update_state(spark.readStream.schema(ARRIVAL).parquet(f"{base}/arrivals"), f"{base}/state", f"{base}/stream")
    state = stored(retained(spark, f"{base}/state"))

    def out(found: DataFrame) -> DataFrame:
        here = F.struct("id", "file", "row")
        return found.select("file", "row", "id", "digest", F.col("keep.id").alias("keep_id"), F.col("n").alias("group_size"), here.eqNullSafe(F.col("keep")).alias("kept"))

    plain = stored(out(_with_state(arrivals, state)))

    # Full bytes of every hit and of the row that stays: a digest's texts are equal where the least is the greatest. Only texts
    # whose digest came more than once are read for it, and each task reduces a hot digest to two texts before the shuffle.
    texts = _keyed(within(docs.select(column(text).alias("text")), plain.where("group_size > 1").select("file", "row")), digest)
    unequal = stored(texts.groupBy("digest").agg(F.min("norm").alias("low"), F.max("norm").alias("high")).where("low <> high").select("digest"))
    if unequal.isEmpty():
        return plain
    again = rows.join(unequal, "digest")
    groups = again.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "file", "row")).alias("keep"))
    return plain.join(unequal, "digest", "left_anti").unionByName(out(again.join(groups, ["digest", "norm"])))


def _with_state(arrivals: DataFrame, state: DataFrame) -> DataFrame:
    """Arrivals with their digest's state. Digests of over ``HOT`` rows are few, and are broadcast; no other task gets more than that of one."""
    hot = stored(state.where(F.col("n") > HOT))
    if hot.count() > MAX_NARROW:  # of over 2,000,000,000 rows; their tasks are split as Spark sees them
        return arrivals.join(state, "digest")
    rest = arrivals.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
    return arrivals.join(F.broadcast(hot), "digest").unionByName(rest.join(state.where(F.col("n") <= HOT), "digest"))


def deduplicate(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    docs = located(docs)
    return without(docs, classes(docs, text, id).where("not kept"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


SQL = """
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size, doc_id = max(doc_id) over g as kept, sha256(norm) as text_sha256
from (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm from documents)
window g as (partition by norm)
"""
