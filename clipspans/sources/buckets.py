"""Tables that lie in buckets by clip, so that joins and groupings by clip need no exchange.

A bucket is one file, sorted by its keys; two tables with as many buckets are joined bucket by bucket. The number of buckets is
chosen when a table is written, for the size that it will have: a bucket should fit a task. Joins by clip and time use
buckets by both, or buckets by clip where the session has spark.sql.requireAllClusterKeysForCoPartition = false."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

KEYS = ("clip_id",)


def write_bucketed(df: DataFrame, path: str, keys: tuple[str, ...] = KEYS, buckets: int | None = None, sort: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as a table in buckets at ``path``, read back. One exchange, after which each task writes one bucket."""
    spark = df.sparkSession
    n = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"bucketed_{uuid.uuid4().hex}"
    df.repartition(n, *keys).write.format("parquet").option("path", path).bucketBy(n, *keys).sortBy(*keys, *sort).saveAsTable(name)
    return spark.table(name)


def open_bucketed(spark: SparkSession, path: str, schema: str, buckets: int, keys: tuple[str, ...] = KEYS, sort: tuple[str, ...] = ()) -> DataFrame:
    """A table that ``write_bucketed`` wrote, also in another session; schema, keys and number of buckets must be those it has."""
    name = f"bucketed_{uuid.uuid4().hex}"
    place = path.replace("'", "\\'")
    spark.sql(f"create table {name} ({schema}) using parquet clustered by ({', '.join(keys)}) sorted by ({', '.join([*keys, *sort])}) into {buckets} buckets location '{place}'")
    return spark.table(name)
