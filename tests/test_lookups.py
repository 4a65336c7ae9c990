"""Lookups for wide rows: no task gets the rows that have no key, and texts stay out of windows."""

import re

from pyspark.sql import functions as F

from clipspans.operators import joins


def test_rows_without_key_are_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        rows = spark.range(4000).select(F.col("id").alias("row_index"), F.lit(None).cast("string").alias("clip_id"), F.when(F.col("id") % 10 == 0, F.concat(F.lit("/h/"), "id")).alias("video_path_hint"), F.lit("x").alias("label"))
        files = rows.where("row_index % 20 = 0").select(F.col("video_path_hint").alias("path"))
        for out in (joins.find_videos(rows, files, "/v"), joins.resolve_video(rows, files.withColumns({"clip_id": F.lit("c"), "priority": F.lit(1), "source": F.lit("s")}))):
            got = out.withColumn("task", F.spark_partition_id()).collect()
            assert len(got) == 4000 and all((r.video_source == "hint") == (r.row_index % 20 == 0) for r in got)
            sizes = [sum(r.task == k for r in got) for k in range(4)]
            assert max(sizes) < 1300  # 3,600 and more of them before
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_texts_stay_out_of_the_window(spark):
    ts = spark.createDataFrame([("a", i, i * 10) for i in range(11)] + [("c", None, None)], "video_path string, frame_index int, ts_us bigint")
    rows = [(0, "a", 95, "t"), (1, "a", 95, "u"), (2, "a", None, "v"), (3, "c", None, "w"), (4, None, None, "x"), (5, None, 95, "y"), (6, "b", 95, "z")]
    out = joins.sidecar_seconds(spark.createDataFrame(rows, "i int, video_path string, event_timestamp bigint, text string"), ts, fps=2.0)
    assert {r.i: (r.seconds, r.sidecar_problem, r.text) for r in out.collect()} == {
        0: (4.5, None, "t"), 1: (4.5, None, "u"), 2: (None, None, "v"), 3: (None, "empty_timestamp_mapping", "w"), 4: (None, None, "x"), 5: (None, None, "y"), 6: (None, None, "z")}
    windows = re.findall(r"Window \[.*", out._jdf.queryExecution().optimizedPlan().toString())
    assert windows
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i, line in enumerate(plan):
        if "Window [" in line:
            below = [x for x in plan[i + 1 :]]
            own = below[: next((k for k, x in enumerate(below) if depth(x) <= depth(line)), len(below))]
            assert not any("text#" in x for x in own if "Project" in x)
