"""Tables in buckets by clip."""

import os
import re

from pyspark.sql import functions as F

from clipspans.operators import joins
from clipspans.sources.buckets import open_bucketed, write_bucketed


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"(?<!Broadcast)Exchange \w+", plan)


def test_joins_without_an_exchange(spark, tmp_path):
    ticks = spark.range(20_000).selectExpr("cast(id % 100 as string) as clip_id", "cast(id div 100 as int) as frame", "id as speed")
    events = spark.range(500).selectExpr("cast(id % 120 as string) as clip_id", "cast(id % 200 as int) as frame", "id")
    t, e = write_bucketed(ticks, f"{tmp_path}/t", buckets=6, sort=("frame",)), write_bucketed(events, f"{tmp_path}/e", buckets=6)
    assert len([n for n in os.listdir(f"{tmp_path}/t") if n.endswith(".parquet")]) == 6
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = joins.assemble(e, t, keys=("clip_id", "frame"))
        assert exchanges(got) == []
        assert exchanges(joins.allowed_clips(t, e.select("clip_id"))) == [] and exchanges(t.groupBy("clip_id").agg(F.max("speed"))) == []
        want = events.join(ticks, ["clip_id", "frame"], "left")
        assert sorted(map(str, got.select("id", "speed").collect())) == sorted(map(str, want.select("id", "speed").collect()))
        again = open_bucketed(spark, f"{tmp_path}/t", "clip_id string, frame int, speed bigint", 6, sort=("frame",))
        assert exchanges(joins.assemble(e, again, keys=("clip_id", "frame"))) == [] and again.count() == 20_000
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
        keys = ("clip_id", "frame")
        both = joins.assemble(write_bucketed(events, f"{tmp_path}/e2", keys, 5), write_bucketed(ticks, f"{tmp_path}/t2", keys, 5), keys=keys)
        assert exchanges(both) == [] and sorted(map(str, both.select("id", "speed").collect())) == sorted(map(str, want.select("id", "speed").collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
