"""Frames and map pieces: rows that are unfolded from narrow ones are never broadcast, and only those needed are made."""

import random

from pyspark.sql import functions as F

from clipspans.operators import intervals, joins, keyframes, lanes, prompts

SPANS = "clip_id string, tag string, start int, end int, line_no int"
LANES = "map_id string, lane_id string, center array<struct<x: double, y: double>>, next array<string>, left array<string>, right array<string>"


def drawn(seed):
    r = random.Random(seed)
    tags = ["Stop", "MaintainSpeed", "SteerLeft", "LaneKeep", "TurnLeft", None]
    return [(r.choice("abc"), r.choice(tags), (s := r.randint(-20, 210)), s + r.randint(-3, 40), i) for i in range(70)]


def plain_label(rows, clip, track, frame):
    of = {"Stop": "longitudinal", "MaintainSpeed": "longitudinal", "LaneKeep": "lane", "TurnLeft": "lane"}
    own = [(n, tag) for c, tag, s, e, n in rows if c == clip and of.get(tag, "lateral") == track and s <= frame < e]
    return (max(own)[1] if own else None) or "Not Available"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_frames_and_windows_from_spans(spark):
    rows, tracks = drawn(1), ("longitudinal", "lateral", "lane")
    spans, clips = spark.createDataFrame(rows, SPANS), spark.createDataFrame([("a",), ("b",), ("empty",), ("a",)], "clip_id string")
    frames = intervals.expand_to_frames(spans, clips, tracks=tracks)
    want = {(c, f): tuple(plain_label(rows, c, t, f) for t in tracks) for c in ("a", "b", "empty") for f in range(200)}
    got = frames.collect()
    assert len(got) == len(want) and {(x.clip_id, x.frame): tuple(x[2:]) for x in got} == want
    events = spark.createDataFrame([("a", 10, "x"), ("b", 190, "y"), ("empty", None, "z"), ("gone", 5, "z"), ("a", 300, "x")], "clip_id string, event_start_frame int, extra string")
    old, new = prompts.action_window(events, frames), prompts.span_action_window(events, spans, clips, tracks)
    assert sorted(old.columns) == sorted(new.columns)
    assert sorted(map(str, old.select(*new.columns).collect())) == sorted(map(str, new.collect()))
    for track in tracks:
        old, new = intervals.change_points(frames, track).select("clip_id", "frame", track), intervals.span_change_points(spans, clips, track)
        assert sorted(map(tuple, old.collect())) == sorted(map(tuple, new.collect()))


def test_no_unfolded_rows_are_broadcast(spark):
    """The inputs are so small that Spark's estimate allows a broadcast."""
    spans = spark.createDataFrame(drawn(2), SPANS)
    maps = spark.createDataFrame([("m", f"l{i}", [(0.0, float(i)), (5.0, float(i))], [f"l{i + 1}"], [], []) for i in range(5)], LANES)
    poses = spark.createDataFrame([("c", "ego", t, "m", 2.0, 1.0, 0.0) for t in range(5)], "clip_id string, agent_id string, tick int, map_id string, x double, y double, heading double")
    frames = intervals.expand_to_frames(spans, spans)
    events = spans.select("clip_id", F.col("start").alias("event_start_frame"))
    matched = lanes.match_lanes(poses, maps)
    assert matched.count() == 5
    for df in (
        frames, keyframes.agreement(frames, frames.alias("t"), ("lane",)), prompts.action_window(events, frames), prompts.span_action_window(events, spans, spans),
        matched, lanes.next_lanes(maps), lanes.lane_neighbours(maps), lanes.lane_decisions(lanes.temporal_vote(lanes.lane_relations(matched, maps))),
    ):
        assert "Broadcast" not in plan(df)


def test_frames_of_clips_go_into_as_many_parts_as_told(spark):
    frames = spark.createDataFrame([(c, i, i * 100) for c in "abc" for i in range(9)], "clip_id string, frame_index int, ts_us bigint")
    events = spark.createDataFrame([("a", 140), ("b", 160), ("none", 1)], "clip_id string, ts_us bigint")
    near = joins.nearest_frame(events, frames, parts=7)
    assert near.rdd.getNumPartitions() == 7
    assert sorted((x.clip_id, x.frame_index) for x in near.collect()) == [("a", 1), ("b", 2), ("none", None)]
    assert joins.frame_timestamp(events.select("clip_id", F.lit(2).alias("frame_index")), frames, parts=7).rdd.getNumPartitions() == 7
