"""The result log as a stream: arriving JSON-lines files become keyed state, and the state is the compacted table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from clipspans.operators.results import line_rank

#: Set while the stream runs: state on disk, of which a batch writes only what it changed.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: So that a line is the same after it was written as JSON.
_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


@contextmanager
def _state_conf(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def update_state(spark: SparkSession, log_dir: str, schema: StructType | str, state_dir: str, checkpoint: str, files_per_batch: int | None = None) -> list[StreamingQuery]:
    """Takes in all waiting log files. A key's state is its best line so far, by the rules of ``compact_results``, and its first line
    number; lines of one key meet in their tasks before they meet in the state. Lines without a key are appended below ``state_dir``.

    Returns the two ended streams, by key and without. What a batch costs depends on its own lines; one that fails is run again
    from the state before it."""
    reader = spark.readStream.schema(schema)
    reader = reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.json(log_dir)
    best = F.max(F.struct(line_rank(lines.columns).alias("rank"), F.to_json(F.struct(*lines.columns), _JSON).alias("line")))
    keyed = lines.where("row_key is not null").groupBy("row_key").agg(best.alias("best"), F.min("line_no").alias("position"))
    others = lines.where("row_key is null").writeStream.format("parquet").option("path", f"{state_dir}/unkeyed").outputMode("append")
    started = []
    with _state_conf(spark):
        for stream, name in ((keyed.writeStream.format("noop").outputMode("update"), "keyed"), (others, "unkeyed")):
            started.append(stream.option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start())
        for query in started:
            query.awaitTermination()
    return started


def compacted(spark: SparkSession, schema: StructType | str, state_dir: str, checkpoint: str) -> DataFrame:
    """The table that the state holds: a row per key, with its position, and the lines without a key. Reads the state itself, so it
    costs as much as there are keys, however many batches and retries there were."""
    columns = spark.createDataFrame([], schema).schema
    try:
        state = spark.read.format("statestore").load(f"{checkpoint}/keyed")
    except Exception as problem:  # nothing has come yet
        if "STDS_" not in str(problem) and "does not exist" not in str(problem):
            raise
        return spark.createDataFrame([], StructType([*columns.fields]).add("position", "long"))
    # the state of two aggregates, in their order
    best, position = (F.col("value")[f.name] for f in state.schema["value"].dataType.fields)
    keyed = state.select(F.from_json(best["line"], columns, _JSON).alias("r"), position.alias("position")).select("r.*", "position")
    try:
        unkeyed = spark.read.schema(columns).parquet(f"{state_dir}/unkeyed")
    except AnalysisException:
        return keyed
    return keyed.unionByName(unkeyed.withColumn("position", F.col("line_no")))


def compact_stream(spark: SparkSession, log_dir: str, schema: StructType | str, state_dir: str, checkpoint: str) -> DataFrame:
    """Takes in all waiting log files; returns the compacted rows of all files so far, also when nothing waits."""
    update_state(spark, log_dir, schema, state_dir, checkpoint)
    return compacted(spark, schema, state_dir, checkpoint).drop("position")
