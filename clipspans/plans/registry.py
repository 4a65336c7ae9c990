"""Registered queries of the trajectory part, with their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipspans.functions import text
from clipspans.operators import classify, features, intervals, joins, keyframes, lane_cleaning, lanes, prompts, results, segments
from clipspans.plans import inputs
from clipspans.plans import ticks as tick_plan
from clipspans.plans.catalog import ORACLES, QUERIES, query

def _round(df: DataFrame, *columns: str, keep: tuple[str, ...] = ("clip_id", "tick")) -> DataFrame:
    return df.select(*keep, *[F.round(c, 6).alias(c) for c in columns])


query("ticks", tick_plan.SQL)(inputs.ticks)


@query("k1_speed", "select clip_id, tick, round(speed, 6) as speed, round(speed_along, 6) as speed_along from motion", "motion")
def _speed(spark, d):
    return _round(features.add_speed(inputs.ticks(spark, d)), "speed", "speed_along")


@query("k2_world", "select clip_id, tick, round(-y + 10, 6) as x, round(x - 5, 6) as y, round(heading + pi() / 2, 6) as heading from ticks", "ticks")
def _world(spark, d):
    t = inputs.ticks(spark, d)
    tf = t.select("clip_id").distinct().withColumn("world_tf", F.array(*[F.lit(float(v)) for v in (0, -1, 10, 1, 0, -5, 0, 0, 1)]))
    return _round(features.to_world(t, tf), "x", "y", "heading")


@query("k3_acceleration", "select clip_id, tick, round(acceleration, 6) as acceleration from accel", "accel")
def _acceleration(spark, d):
    return _round(features.add_acceleration(features.add_speed(inputs.ticks(spark, d))), "acceleration")


@query("k4_rolling_mean", "select clip_id, tick, round(smooth, 6) as smooth from smooth", "smooth")
def _rolling(spark, d):
    t = features.add_acceleration(features.add_speed(inputs.ticks(spark, d)))
    return _round(features.rolling_mean(t, "acceleration", "smooth"), "smooth")


@query("k5_hysteresis", "select clip_id, tick, cast(state as int) as state from lon_state", "lon_state")
def _hysteresis(spark, d):
    return segments.longitudinal_states(inputs.ticks(spark, d)).select("clip_id", "tick", "state")


@query("k6_turn_rate", "select clip_id, tick, round(distance, 6) as distance, round(turn, 6) as turn, round(turn_rate, 6) as turn_rate from turning", "turning")
def _turn(spark, d):
    return _round(features.add_turn_rate(features.add_speed(inputs.ticks(spark, d))), "distance", "turn", "turn_rate")


@query("k8_lane_kinematics", """select clip_id, tick, round(coalesce(case when tick = 0 then lead(dh) over w else dh end, 0), 6) as heading_delta, round(dist, 6) as step_distance,
  round(case when dist is null then 0 else coalesce(-dx * sin(heading) + dy * cos(heading), 0) end, 6) as step_left from (select *, coalesce(sqrt(dx * dx + dy * dy), 0) as dist, (dh0 + pi()) - 2 * pi() * floor((dh0 + pi()) / (2 * pi())) - pi() as dh from
  (select *, lead(x) over w - x as dx, lead(y) over w - y as dy, heading - lag(heading) over w as dh0 from ticks window w as (partition by clip_id order by tick))) window w as (partition by clip_id order by tick)""", "ticks")
def _lane_kinematics(spark, d):
    return _round(features.add_lane_kinematics(inputs.ticks(spark, d)), "heading_delta", "step_distance", "step_left")


@query("k9_downsample", "select clip_id, tick from ticks where (tick < 10 and tick % 5 = 0) or (tick >= 10 and tick - 10 between 4 and 29 and (tick - 14) % 5 = 0)", "ticks")
def _downsample(spark, d):
    return features.downsample(inputs.ticks(spark, d), 5, 10, 30).select("clip_id", "tick")


@query("k10_rotate_axes", "select clip_id, tick, round(-y, 6) as x, round(x, 6) as y, round(-vy, 6) as vx, round(vx, 6) as vy, round((heading + pi() / 2) - 2 * pi() * floor((heading + pi() / 2) / (2 * pi())), 6) as heading from ticks", "ticks")
def _rotate(spark, d):
    return _round(features.rotate_axes(inputs.ticks(spark, d)), "x", "y", "vx", "vy", "heading")


@query("k11_angular_velocity", "select clip_id, tick, round(coalesce(a * 10, lag(a * 10) over (partition by clip_id order by tick), 0), 6) as angular_velocity from (select *, (q + pi()) - 2 * pi() * floor((q + pi()) / (2 * pi())) - pi() as a from (select *, lead(heading) over (partition by clip_id order by tick) - heading as q from ticks))", "ticks")
def _angular(spark, d):
    return _round(features.angular_velocity(inputs.ticks(spark, d)), "angular_velocity")


@query("k12_long_lat_speed", "select clip_id, tick, round(vx * cos(heading) + vy * sin(heading), 6) as lon_speed, round(-vx * sin(heading) + vy * cos(heading), 6) as lat_speed from ticks", "ticks")
def _lon_lat(spark, d):
    return _round(features.long_lat_speed(inputs.ticks(spark, d)), "lon_speed", "lat_speed")


@query("k14_resample", """select m.clip_id, cast(f as int) as frame, round(a.speed + coalesce(b.speed - a.speed, 0) * (f / 3.0e0 - a.tick), 6) as speed from (select clip_id, max(tick) as last from motion group by 1) m, lateral (select unnest(range(0, last * 3 + 1)) as f) g
  join motion a on a.clip_id = m.clip_id and a.tick = f // 3 left join motion b on b.clip_id = m.clip_id and b.tick = a.tick + 1""", "motion")
def _resample(spark, d):
    t = features.resample_linear(features.add_speed(inputs.ticks(spark, d)), ["speed"])
    return _round(t, "speed", keep=("clip_id", "frame"))


@query("g2_segment_longitudinal", "select clip_id, round(start_time, 6) as start_time, round(duration, 6) as duration, round(delta_velocity, 6) as delta_velocity, round(average_acceleration, 6) as average_acceleration, round(average_speed, 6) as average_speed, round(average_speed_along_heading, 6) as average_speed_along_heading, caption from lon_cap", "lon_cap")
def _longitudinal(spark, d):
    s = classify.classify_longitudinal(segments.segment_longitudinal(inputs.ticks(spark, d)))
    return _round(s, "start_time", "duration", "delta_velocity", "average_acceleration", "average_speed", "average_speed_along_heading", keep=("clip_id", "caption"))


@query("g3_segment_lateral", "select clip_id, round(start_time, 6) as start_time, round(duration, 6) as duration, round(total_heading_change, 6) as total_heading_change, round(average_turn_rate, 6) as average_turn_rate, round(total_distance, 6) as total_distance, round(average_speed_along_heading, 6) as average_speed_along_heading, caption from lat_cap", "lat_cap")
def _lateral(spark, d):
    s = classify.classify_lateral(segments.segment_lateral(inputs.ticks(spark, d)))
    return _round(s, "start_time", "duration", "total_heading_change", "average_turn_rate", "total_distance", "average_speed_along_heading", keep=("clip_id", "caption"))


@query("g9_label_clips", """select clip_id, agent_id, family, tag, s as start, e as "end" from clean_spans where family = 'longitudinal' union all
  select clip_id, agent_id, 'lateral', tag, min(t), max(t) + 1 from (select *, t - row_number() over (partition by clip_id, agent_id, tag, s order by t) as g from (select *, cast(unnest(range(s, e)) as int) as t from clean_spans where family = 'lateral') x
  where not exists (select 1 from clean_spans p where p.family = 'longitudinal' and p.tag = 'Stop' and p.clip_id = x.clip_id and p.agent_id = x.agent_id and x.t >= p.s and x.t < p.e)) group by clip_id, agent_id, tag, s, g""", "clean_spans")
def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned spans of both families, without stops in the lateral ones."""
    return intervals.remove_stops(intervals.to_tick_spans(segments.label_clips(inputs.ticks(spark, d))))


@query("i1_tick_spans", "select clip_id, agent_id, family, tag, s as start, e as \"end\" from spans", "spans")
def _tick_spans(spark, d):
    return inputs.spans(spark, d).select("clip_id", "agent_id", "family", "tag", "start", "end")


@query("i2_subtract_stops", """select clip_id, agent_id, tag, min(t) as start, max(t) + 1 as "end" from (select *, t - row_number() over (partition by clip_id, agent_id, tag, s order by t) as g from
  (select l.clip_id, l.agent_id, l.tag, l.s, cast(unnest(range(l.s, l.e)) as int) as t from spans l where family = 'lateral') x where not exists (select 1 from spans p where p.family = 'longitudinal' and p.tag = 'Stop' and p.clip_id = x.clip_id and p.agent_id = x.agent_id and x.t >= p.s and x.t < p.e)) group by clip_id, agent_id, tag, s, g""", "spans")
def _subtract(spark, d):
    return intervals.remove_stops(inputs.spans(spark, d)).where("family = 'lateral'").select("clip_id", "agent_id", "tag", "start", "end")


@query("i3_clip_to_window", "select clip_id, tag, greatest(s - 20, 0) as start, least(e - 20, 40) as \"end\" from spans where s <= 60 and e >= 20", "spans")
def _window(spark, d):
    return intervals.clip_to_window(inputs.spans(spark, d), 20, 40).select("clip_id", "tag", "start", "end")


@query("i4_clip_len", "select clip_id, max(e) + 1 as length from spans group by clip_id", "spans")
def _length(spark, d):
    return intervals.infer_clip_len(inputs.spans(spark, d))


@query("i5_format_spans", """select clip_id, cast(row_number() over (partition by clip_id order by fs, tag, s, e) - 1 as int) as line_no, '  ' || tag || ' - Agent:<' || agent_id || '>, Start:' || s || ', End:' || e as line
  from (select *, min(s) over (partition by clip_id, tag) as fs from spans)""", "spans")
def _format(spark, d):
    return intervals.format_spans(inputs.spans(spark, d))


@query("i6_frames", """select c.clip_id, cast(f as int) as frame, coalesce(arg_max(tag, s) filter (tag is not null), 'Not Available') as longitudinal from (select distinct clip_id from spans) c cross join (select unnest(range(0, 200)) as f) g
  left join (select * from spans where family = 'longitudinal') p on p.clip_id = c.clip_id and f >= s and f < e group by c.clip_id, f""", "spans")
def _frames(spark, d):
    spans = inputs.stored_spans(spark, d)
    return intervals.expand_to_frames(inputs.numbered(spans), spans).select("clip_id", "frame", "longitudinal")


@query("i7_change_points", """select clip_id, frame, longitudinal from (select *, lag(longitudinal) over (partition by clip_id order by frame) as b from (select c.clip_id, cast(f as int) as frame, coalesce(arg_max(tag, s) filter (tag is not null), 'Not Available') as longitudinal
  from (select distinct clip_id from spans) c cross join (select unnest(range(0, 200)) as f) g left join (select * from spans where family = 'longitudinal') p on p.clip_id = c.clip_id and f >= s and f < e group by c.clip_id, f)) where b <> longitudinal""", "spans")
def _changes(spark, d):
    spans = inputs.stored_spans(spark, d)
    return intervals.span_change_points(inputs.numbered(spans), spans, "longitudinal")


@query("i9_overlap", """select clip_id, cast(round_even(greatest(0, -shift) * 30 / 1e6, 0) as int) as video_start, cast(round_even(greatest(0, shift) * 30 / 1e6, 0) as int) as clip_start, cast(round_even((least(20000000, shift + long) - greatest(0, shift)) * 30 / 1e6, 0) as int) as n_frames
  from (select clip_id, (start_us // 1000000 % 41 - 20) * 300000 as shift, (start_us // 1000000 % 7 + 1) * 3000000 as long from timing) where least(20000000, shift + long) > greatest(0, shift)""", "timing")
def _overlap(spark, d):
    """Videos of 3 to 21 s that begin up to 6 s before or after their clip."""
    t = inputs.clip_timing(spark, d)
    second = F.expr("start_us div 1000000")
    shift, length = (second % 41 - 20) * 300000, (second % 7 + 1) * 3000000
    video = t.select("clip_id", (F.col("start_us") + shift).alias("start_us"), (F.col("start_us") + shift + length).alias("end_us"))
    return intervals.overlap_video_clip(video, t.select("clip_id", "start_us", (F.col("start_us") + 20000000).alias("end_us")))


@query("i10_frames_30fps", "select clip_id, tag, s * 3 as start, e * 3 as \"end\", case when family = 'longitudinal' then family else 'lateral' end as track from spans", "spans")
def _fps(spark, d):
    return intervals.frames_at_30fps(inputs.spans(spark, d)).select("clip_id", "tag", "start", "end", "track")


@query("p8_keyframes", "select * from keys", "keys")
def _keys(spark, d):
    return inputs.keyframe_rows(spark, d)


@query("p9_filter", "select * from keys where meta_action = 'stop' and clip_id not in (select clip_id from timing where clip_id like '%7')", "keys", "timing")
def _filter(spark, d):
    return keyframes.filter_segments(inputs.keyframe_rows(spark, d), ["stop"], exclude=inputs.clip_timing(spark, d).where("clip_id like '%7'"))


@query("p10_align", "select meta_action, clip_id, cast(5 * round_even(event_start_frame / 5.0, 0) as int) as event_start_frame, event_end_frame, duration + event_start_frame - cast(5 * round_even(event_start_frame / 5.0, 0) as int) as duration, event_start_frame as unrounded_start_frame from keys", "keys")
def _align(spark, d):
    return keyframes.align_event_start(inputs.keyframe_rows(spark, d), 5)


@query("a1_duration_stats", "select a as meta_action, count(meta_action) as n, round(avg(duration), 6) as mean, round(stddev_pop(duration), 6) as std, min(duration) as least, max(duration) as most from (select unnest(['stop', 'reverse', 'steer_left', 'keep_lane']) as a) left join keys on a = meta_action group by a", "keys")
def _stats(spark, d):
    s = keyframes.duration_stats(inputs.keyframe_rows(spark, d), ["stop", "reverse", "steer_left", "keep_lane"])
    return s.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query("a2_counts", "select meta_action, count(*) as segments, count(distinct clip_id) as clips from keys group by meta_action", "keys")
def _counts(spark, d):
    return keyframes.counts(inputs.keyframe_rows(spark, d))


@query("a3_dedupe_concat", "select clip_id, case when count(*) > 1 then string_agg(meta_action, ',' order by meta_action, event_end_frame) else min(meta_action) end as meta_action, event_start_frame from keys group by clip_id, event_start_frame", "keys")
def _dedupe(spark, d):
    k = inputs.keyframe_rows(spark, d).select("meta_action", "clip_id", "event_start_frame", F.struct("meta_action", "event_end_frame").alias("o"))
    return keyframes.dedupe_concat(k, "o", ["meta_action"]).drop("o")


@query("a5_compact", """select * exclude (r, c) from (select *, min(line_no) over (partition by row_key) as position, row_number() over (partition by row_key order by ok desc, line_no desc) as r, 1 as c from log where row_key is not null) where r = 1
  union all select *, line_no from log where row_key is null""", "log")
def _compact(spark, d):
    return results.compact_results(inputs.log(spark, d)).select("row_key", "line_no", "ok", "size", "position")


@query("a6_done_keys", "select distinct row_key from log where ok and row_key is not null", "log")
def _done(spark, d):
    return results.done_keys(inputs.log(spark, d))


@query("a7_clip_ids", "select distinct clip_id from keys where meta_action in ('stop', 'reverse')", "keys")
def _clip_ids(spark, d):
    return keyframes.load_clip_ids(inputs.keyframe_rows(spark, d), ["STOP", "Reverse"])


@query("a8_resolve_clips", "select distinct 'c_' || user_id as clip_id from events")
def _resolve(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    return keyframes.resolve_clips(e.select(F.concat(F.lit("c_"), F.col("user_id").cast("string"), F.lit("_"), F.col("event_id").cast("string")).alias("key")))


@query("a9_agreement", """select 'longitudinal' as track, count(*) as frames, count(*) filter (p = t) as equal from (select f.clip_id, f.f, arg_max(f.tag, f.s) filter (f.tag is not null) as p, arg_max(g.tag, g.s) filter (g.tag is not null) as t
  from (select s.*, unnest(range(s.s, s.e)) as f from spans s where family = 'longitudinal') f join (select s.*, unnest(range(s.s + 2, s.e + 2)) as f from spans s where family = 'longitudinal') g on f.clip_id = g.clip_id and f.f = g.f group by f.clip_id, f.f)""", "spans")
def _agreement(spark, d):
    s = inputs.numbered(inputs.stored_spans(spark, d).where("family = 'longitudinal'"))
    here = lambda by: intervals.expand_to_frames(s.withColumns({"start": F.col("start") + by, "end": F.col("end") + by}), s).where("longitudinal <> 'Not Available'")
    return keyframes.agreement(here(0), here(2), ("longitudinal",))


@query("a9_span_agreement", """select track, count(*) as frames, count(*) filter (p = t) as equal from (select f.clip_id, f.f, f.family as track, arg_max(f.tag, f.s) as p, arg_max(g.tag, g.s) as t
  from (select s.*, unnest(range(s.s, s.e)) as f from spans s) f join (select s.*, unnest(range(s.s + 2, s.e + 2)) as f from spans s) g on f.clip_id = g.clip_id and f.family = g.family and f.f = g.f where f.f < 200 group by f.clip_id, f.family, f.f) group by track""", "spans")
def _span_agreement(spark, d):
    """Both tracks against themselves, two ticks later, without rows for frames."""
    s = inputs.numbered(inputs.stored_spans(spark, d)).withColumn("track", F.col("family"))
    return intervals.span_agreement(s, s.withColumns({"start": F.col("start") + 2, "end": F.col("end") + 2}))


@query("m1_match_lanes", "select clip_id, tick, lane_id, round(lane_offset, 6) as lane_offset, cast(n as int) as n from lane_match", "lane_match")
def _match(spark, d):
    m = lanes.match_lanes(inputs.lane_ticks(spark, d), inputs.lanes(spark, d))
    return m.select("clip_id", "tick", "lane_id", F.round("lane_offset", 6).alias("lane_offset"), F.size("current_lanes").alias("n"))


@query("m3_next_lanes", "select clip_id as map_id, 'L' || j || '_' || i as lane_id, 'L' || j || '_' || (i + k) as next_id from timing, (select unnest(range(-2, 3)) as j), (select unnest(range(0, 20)) as i), (select unnest(range(1, 6)) as k) where i + k < 20", "timing")
def _next(spark, d):
    return lanes.next_lanes(inputs.lanes(spark, d), keep=inputs.stored)


def _matched(spark, d):
    """The maps, and the ticks with their current lanes, both stored once."""
    maps = inputs.stored(inputs.lanes(spark, d))
    return maps, inputs.stored(lanes.match_lanes(inputs.lane_ticks(spark, d), maps))


@query("m6_temporal_vote", """select clip_id, tick, lane_id, instant, cast(left_hits as int) as left_hits, cast(right_hits as int) as right_hits, case when left_hits > 0 and right_hits = 0 then 'left_lane_change' when right_hits > 0 and left_hits = 0 then 'right_lane_change'
  when left_hits > 0 then case when instant <> 'keep_lane' then instant when left_hits >= right_hits then 'left_lane_change' else 'right_lane_change' end else instant end as voted, n_current, n_next, n_left, n_right
  from (select clip_id, tick, any_value(lane_id) as lane_id, any_value(instant) as instant, count(*) filter (vote = 'left_lane_change') as left_hits, count(*) filter (vote = 'right_lane_change') as right_hits, cast(any_value(len(cur)) as int) as n_current, cast(any_value(len(nxt)) as int) as n_next, cast(any_value(len(lft)) as int) as n_left, cast(any_value(len(rgt)) as int) as n_right from lane_votes group by clip_id, tick)""", "lane_votes")
def _votes(spark, d):
    """Relations of the current lanes, the decision of the instant, and the vote of the ticks ahead."""
    maps, matched = _matched(spark, d)
    t = lanes.temporal_vote(lanes.lane_relations(lanes.look_ahead(matched), maps))
    sizes = {"n_current": "current_lanes", "n_next": "next_lanes", "n_left": "left_lanes", "n_right": "right_lanes"}
    return t.select("clip_id", "tick", "lane_id", "instant", "left_hits", "right_hits", "voted", *[F.size(c).alias(n) for n, c in sizes.items()])


def _lane_labels(spark, d):
    """Labelled lane ticks, without the sets of lanes."""
    maps, matched = _matched(spark, d)
    return lanes.label_lane_ticks(None, maps, matched=matched, sets=False)


@query("m_lane_decisions")
def _decisions(spark, d):
    t = _lane_labels(spark, d)
    return t.select("clip_id", "tick", "lane_id", "instant", "left_hits", "right_hits", "voted", "lane_decision", "reason", F.round("lane_confidence", 6).alias("lane_confidence"), "lane_confidence_label")


@query("g4_segment_lane")
def _lane_segments(spark, d):
    s = lanes.classify_lane(lanes.segment_lane(_lane_labels(spark, d)))
    return _round(s, "start_time", "duration", "max_abs_offset", "average_lateral_rate", "pulse_rise", "pulse_fall", keep=("clip_id", "caption", "lane_decision", "pulse_dir"))


@query("g8_clean_lane")
def _clean_lane(spark, d):
    s = lanes.classify_lane(lanes.segment_lane(_lane_labels(spark, d)))
    return _round(lane_cleaning.clean_lane(s), "start_time", "duration", "average_lateral_rate", "lane_confidence", keep=("clip_id", "caption", "lane_decision", "lane_confidence_label"))


@query("t1_balance", "select meta_action, clip_id, event_start_frame, event_end_frame, duration from (select *, row_number() over (partition by meta_action order by duration desc, clip_id, event_start_frame, event_end_frame) as r from keys) where r <= 20", "keys")
def _balance(spark, d):
    return keyframes.balance(inputs.keyframe_rows(spark, d), 20)


@query("t2_limit", "select row_index from labels_in where 'k' || row_index not in (select row_key from log where ok and row_key is not null) order by row_index limit 25", "labels_in", "log")
def _limit(spark, d):
    """Done rows are left out before the limit counts."""
    labels = inputs.labels(spark, d).withColumn("row_key", F.concat(F.lit("k"), F.col("row_index").cast("string")))
    return results.pending(labels, inputs.log(spark, d), 25).select("row_index")


@query("j1_asof_episode", """select k.clip_id, k.event_start_frame, coalesce(case when k.us - max(e.time_us) filter (e.time_us <= k.us) > 1000000 then min(e.time_us) else max(e.time_us) filter (e.time_us <= k.us) end, min(e.time_us)) as episode_us
  from (select row_number() over () as id, clip_id, event_start_frame, cast(start_us + event_start_frame * dt_us as bigint) as us from keys join timing using (clip_id)) k join episodes e using (clip_id) group by k.id, k.clip_id, k.event_start_frame, k.us""", "keys", "timing", "episodes")
def _asof(spark, d):
    k = joins.event_time(inputs.keyframe_rows(spark, d), inputs.clip_timing(spark, d))
    return joins.asof_episode(k, inputs.episodes(spark, d)).select("clip_id", "event_start_frame", "episode_us")


@query("j2_nearest_frame", """select clip_id, us as ts_us, case when us between min(f.ts_us) and max(f.ts_us) then arg_min(f.frame_index, (abs(f.ts_us - us), f.ts_us)) end as frame_index from
  (select distinct clip_id, cast(start_us + event_start_frame * dt_us as bigint) as us from keys join timing using (clip_id)) k join frame_ts f using (clip_id) group by clip_id, us""", "keys", "timing", "frame_ts")
def _nearest(spark, d):
    timing = inputs.stored(inputs.clip_timing(spark, d))
    k = joins.event_time(inputs.keyframe_rows(spark, d), timing).select("clip_id", F.col("event_start_us").alias("ts_us")).distinct()
    return joins.nearest_frame(k, inputs.frame_ts(spark, d, timing), parts=inputs.frame_parts(timing)).drop("frame_error")


@query("j3_frame_timestamp", "select k.clip_id, k.frame_index, f.ts_us from (select distinct clip_id, event_start_frame * 3 as frame_index from keys) k left join frame_ts f using (clip_id, frame_index)", "keys", "frame_ts")
def _frame_time(spark, d):
    k = inputs.keyframe_rows(spark, d).select("clip_id", (F.col("event_start_frame") * 3).alias("frame_index")).distinct()
    timing = inputs.stored(inputs.clip_timing(spark, d))
    return joins.frame_timestamp(k, inputs.frame_ts(spark, d, timing), inputs.frame_parts(timing))


@query("j4_event_time", "select clip_id, meta_action, event_start_frame, cast(start_us + event_start_frame * dt_us as bigint) as event_start_us from keys join timing using (clip_id)", "keys", "timing")
def _event_time(spark, d):
    return joins.event_time(inputs.keyframe_rows(spark, d), inputs.clip_timing(spark, d)).select("clip_id", "meta_action", "event_start_frame", "event_start_us")


@query("j6_cached_ticks", "select meta_action, clip_id, event_start_frame from keys where event_start_frame % 2 = 0 and event_start_frame < 60", "keys")
def _cached(spark, d):
    index = inputs.ticks(spark, d).where("tick % 2 = 0 and tick < 60").select("clip_id", F.col("tick").alias("event_start_frame"))
    return joins.with_cached_ticks(inputs.keyframe_rows(spark, d), index).select("meta_action", "clip_id", "event_start_frame")


@query("j8_members", "select 'z' || (page_id % 5) || '.zip' as zip_path, 'a/c' || (page_id % 40) || '/' || case when page_id % 2 = 0 then 'cam.mp4' else 'video.mp4' end as member_name, 'c' || (page_id % 40) as clip_id, case when page_id % 2 = 0 then 'c' || (page_id % 40) || '.cam.mp4' end as target_name from pages where page_id % 40 < 30 group by all")
def _members(spark, d):
    p = spark.read.parquet(f"{d}/pages.parquet")
    n = F.col("page_id") % 40
    members = p.select(F.concat(F.lit("z"), (F.col("page_id") % 5).cast("string"), F.lit(".zip")).alias("zip_path"), F.concat(F.lit("a/c"), n.cast("string"), F.when(F.col("page_id") % 2 == 0, "/cam.mp4").otherwise("/video.mp4")).alias("member_name"))
    return joins.match_members(members.distinct(), p.where("page_id % 40 < 30").select(F.concat(F.lit("c"), n.cast("string")).alias("clip_id")).distinct(), "cam")


@query("e1_action_window", """select k.clip_id, k.event_start_frame, cast(f as int) as frame, case when f < k.event_start_frame then 'history' else 'future' end as phase, cast(f - k.event_start_frame as int) as ts from (select distinct clip_id, event_start_frame from keys) k,
  lateral (select unnest(range(greatest(k.event_start_frame - 20, 0), k.event_start_frame, 5)) as f union all select unnest(range(k.event_start_frame, least(k.event_start_frame + 60, 200), 5))) g""", "keys")
def _action_window(spark, d):
    spans = inputs.stored_spans(spark, d)
    events = inputs.keyframe_rows(spark, d, spans).select("clip_id", "event_start_frame").distinct()
    return prompts.span_action_window(events, inputs.numbered(spans), spans).select("clip_id", "event_start_frame", "frame", "phase", "ts")


@query("e4_frame_plan", "select clip_id, event_start_frame, 3 as interval, event_start_frame % 3 as \"offset\", event_start_frame // 3 as sampled_event, len([x for x in range(event_start_frame // 3 - 20, event_start_frame // 3 + 61, 5) if x >= 0]) as n_frames from (select distinct clip_id, event_start_frame from keys)", "keys")
def _plan(spark, d):
    k = inputs.keyframe_rows(spark, d).select("clip_id", "event_start_frame").distinct()
    return prompts.frame_plan(k).withColumn("n_frames", F.size("frames").cast("bigint")).drop("frames")


@query("e9_lateral_prior", """select clip_id, event_start_frame, type as expected_type, case type when 'lane_change' then 'left' when 'nudge' then 'right' else '' end as expected_direction, case type when 'lane_change' then cl when 'nudge' then nr end as expected_onset, type <> '' as has_prior,
  printf('lane changes: %d, left from %s, right from none; nudges: %d, left from none, right from %s; near: within %d; expected: %s, direction %s, onset %s', changes, coalesce(cast(cl as varchar), 'none'), nudges, coalesce(cast(nr as varchar), 'none'), 4 * step,
    coalesce(nullif(type, ''), 'none'), case type when 'lane_change' then 'left' when 'nudge' then 'right' else 'none' end, coalesce(cast(case type when 'lane_change' then cl when 'nudge' then nr end as varchar), 'none')) as summary
  from (select *, case when cl is null and nr is null then '' when nr is null then 'lane_change' when cl is null then 'nudge' when abs(cl) <= 4 * step and abs(nr) > 4 * step then 'lane_change' when abs(nr) <= 4 * step and abs(cl) > 4 * step then 'nudge' when cl <= nr then 'lane_change' else 'nudge' end as type
  from (select clip_id, event_start_frame, any_value(step) as step, cast(min(ts) filter (token = 'change' and nt = token and gap <= 2 * step) as int) as cl, cast(min(ts) filter (token = 'nudge') as int) as nr, count(*) filter (token = 'change') as changes, count(*) filter (token = 'nudge') as nudges
  from (select *, coalesce(min(gap) over (partition by clip_id, event_start_frame), 1) as step from (select *, lead(token) over w as nt, lead(ts) over w - ts as gap
  from (select k.clip_id, k.event_start_frame, f - k.event_start_frame as ts, case (select arg_max(tag, s) from spans p where p.family = 'lateral' and p.clip_id = k.clip_id and f >= s and f < e) when 'SteerLeft' then 'change' when 'SteerRight' then 'nudge' end as token from (select distinct clip_id, event_start_frame from keys) k,
  lateral (select unnest(range(greatest(k.event_start_frame - 20, 0), k.event_start_frame, 5)) as f union all select unnest(range(k.event_start_frame, least(k.event_start_frame + 60, 200), 5))) g)
  window w as (partition by clip_id, event_start_frame order by ts))) group by clip_id, event_start_frame))""", "keys", "spans")
def _prior(spark, d):
    """Priors of timelines whose lane tokens come from the lateral track."""
    spans = inputs.stored_spans(spark, d)
    lane = F.when(F.col("lateral") == "SteerLeft", "Left Lane Change").when(F.col("lateral") == "SteerRight", "Slightly Shift Right").otherwise("Keep Lane")
    events = inputs.keyframe_rows(spark, d, spans).select("clip_id", "event_start_frame").distinct()
    window = prompts.span_action_window(events, inputs.numbered(spans), spans, ("longitudinal", "lateral"))
    return prompts.lateral_prior(window.withColumn("lane", lane))


@query("e10_claims", "select row_index, type, side as direction from claims_in", "claims_in")
def _claims(spark, d):
    return inputs.labels(spark, d).select("row_index", prompts.claim_from_text(F.col("coc_label")).alias("c")).select("row_index", "c.*")


@query("f9_normalize_record", "select row_index, reject_reason, us as event_timestamp, label as coc_label from rows_in", "rows_in")
def _records(spark, d):
    return text.normalize_record(inputs.labels(spark, d)).select("row_index", "reject_reason", "event_timestamp", "coc_label")


@query("f12_parse_answers", """select conv_id, turn, k not in (3, 4, 5, 6, 7) as ok, case k when 3 then 'json_parse_failed' when 5 then 'json_parse_failed' when 7 then 'empty_response' when 4 then 'validation_error:invalid_score:decision_supported_by_video' when 6 then 'validation_error:missing_score:scene_score' end as parse_error,
  case when k not in (3, 4, 5, 6, 7) then '0.' || (n % 10) end as scene_score, case when k not in (3, 4, 5, 6, 7) then text end as explanation from (select conv_id, turn, text, length(text) as n, (conv_id + turn) % 9 as k from conversations where role = 'assistant')""")
def _answers(spark, d):
    parsed = results.parse_responses(inputs.answers(spark, d), ["scene_score", "decision_supported_by_video", "explanation"])
    return parsed.select("conv_id", "turn", "ok", "parse_error", F.col("evaluation")["scene_score"].alias("scene_score"), F.col("evaluation")["explanation"].alias("explanation"))


@query("f14_row_key", "select row_index, case when reject_reason is not null then 'row_' || row_index else clip_id || '_' || coalesce(us::varchar, 'None') || '_' || row_index end as row_key from rows_in", "rows_in")
def _row_key(spark, d):
    """Rows that are rejected for any reason have no clip in their key, though they may have a clip."""
    rows = text.normalize_record(inputs.labels(spark, d))
    return rows.select("row_index", text.row_key(F.col("clip_id"), F.col("event_timestamp"), F.col("row_index"), F.col("reject_reason")).alias("row_key"))


NAMES = ["KeepSpeed", "Wait", "Accelerate", "Decelerate", "Straight", "KeepLane", "LaneKeep", "LeftLaneChange", "RightLaneChange", "LeftTurn", "RightTurn", "GentleAcceleration", "stop", "  Stop ", "follow_curve_left", "FollowCurveRight", "SlightlyShiftLeft", "None", "none", "Some Thing", "sharp_steer_right", "MaintainSpeed", "turn left"]


@query("f1_action_names", """select doc_id, name, action, canonical, display from documents join (values
  (0, 'KeepSpeed', 'maintain_speed', 'maintain_speed', 'Maintain Speed'),
  (1, 'Wait', 'stop', 'stop', 'Stop'),
  (2, 'Accelerate', 'strong_acceleration', 'strong_acceleration', 'Strong Acceleration'),
  (3, 'Decelerate', 'strong_deceleration', 'strong_deceleration', 'Strong Deceleration'),
  (4, 'Straight', 'go_straight', 'go_straight', 'Go Straight'),
  (5, 'KeepLane', 'keep_lane', 'keep_lane', 'Keep Lane'),
  (6, 'LaneKeep', 'keep_lane', 'keep_lane', 'Keep Lane'),
  (7, 'LeftLaneChange', 'left_lane_change', 'left_lane_change', 'Left Lane Change'),
  (8, 'RightLaneChange', 'right_lane_change', 'right_lane_change', 'Right Lane Change'),
  (9, 'LeftTurn', 'turn_left', 'turn_left', 'Turn Left'),
  (10, 'RightTurn', 'turn_right', 'turn_right', 'Turn Right'),
  (11, 'GentleAcceleration', 'gentle_acceleration', 'gentle_acceleration', 'Gentle Acceleration'),
  (12, 'stop', 'stop', 'stop', 'Stop'),
  (13, '  Stop ', 'stop', 'stop', 'Stop'),
  (14, 'follow_curve_left', 'follow_curve_left', 'follow_curve_left', 'Follow Curve Left'),
  (15, 'FollowCurveRight', 'follow_curve_right', 'follow_curve_right', 'Follow Curve Right'),
  (16, 'SlightlyShiftLeft', 'slightly_shift_left', 'slightly_shift_left', 'Slightly Shift Left'),
  (17, 'None', 'none', 'none', 'Not Available'),
  (18, 'none', 'none', 'none', 'Not Available'),
  (19, 'Some Thing', 'Some Thing', 'something', 'Some Thing'),
  (20, 'sharp_steer_right', 'sharp_steer_right', 'sharp_steer_right', 'Sharp Steer Right'),
  (21, 'MaintainSpeed', 'maintain_speed', 'maintain_speed', 'Maintain Speed'),
  (22, 'turn left', 'turn left', 'turnleft', 'turn left')) v(i, name, action, canonical, display) on i = doc_id % 24
  union all select doc_id, null, 'none', 'none', 'Not Available' from documents where doc_id % 24 = 23""")
def _names(spark, d):
    """Every older name, names in both spellings, unknown ones and null."""
    name = F.try_element_at(F.array(*[F.lit(n) for n in NAMES]), (F.col("doc_id") % (len(NAMES) + 1) + 1).cast("int"))
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", name.alias("name"))
    return docs.select("doc_id", "name", text.normalize_action(F.col("name")).alias("action"), text.canonicalize_action(F.col("name")).alias("canonical"), text.action_text(F.col("name")).alias("display"))


from clipspans.plans import events, files  # noqa: E402, F401  register their queries too


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
