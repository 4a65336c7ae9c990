"""Inputs of the registered queries, all derived by Spark from the given tables.

Every input has a DuckDB twin in ``CTES``; both name their columns alike."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipspans.operators import intervals, keyframes, segments
from clipspans.plans import ticks as tick_plan


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tick_plan.from_events(spark, sf_dir)


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captioned spans in ticks, without cleaning."""
    return intervals.to_tick_spans(segments.label_clips(ticks(spark, sf_dir), clean_up=False))


def stored_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans written to the shared folder and read back, for queries that take them more than once."""
    return stored(spans(spark, sf_dir))


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt_out(df: DataFrame, key: str) -> DataFrame:
    """``df`` in all shuffle partitions by ``key``: its rows are narrow, but what is made of each of them isn't, which coalescing by bytes
    doesn't see. By a hash of the key, as Spark leaves out a repartition by what rows are already dealt out by, and then coalesces these."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(key))


def frame_parts(timing: DataFrame) -> int:
    """Into how many tasks the frames of stored ``clip_timing`` go: under half a million to each, on average."""
    return max(int(timing.sparkSession.conf.get("spark.sql.shuffle.partitions")), timing.count() * 620 // 500_000 + 1)


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-")


def shared_path(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share. On one machine without that setting it is made there."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def numbered(df: DataFrame) -> DataFrame:
    """Spans with line_no per clip."""
    order = Window.partitionBy("clip_id").orderBy("start", "tag", "end")
    return df.withColumn("line_no", F.row_number().over(order) - 1)


def keyframe_rows(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    return keyframes.select_keyframes(spans(spark, sf_dir) if of is None else of)


def _numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with clip_id and tick: a clip for each 200 events of a user."""
    i = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    e = _read(spark, sf_dir, "events").withColumn("i", i)
    block = F.when(F.col("i") >= 200, F.concat(F.floor(F.col("i") / 200).cast("string"), F.lit("b"))).otherwise("")
    clip = F.concat(F.lit("clip_"), block, F.lpad(F.col("user_id").cast("string"), 6, "0"))
    return e.withColumns({"clip_id": clip, "tick": (F.col("i") % 200).cast("int")}).drop("i")


def clip_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _numbered_events(spark, sf_dir).groupBy("clip_id").agg(F.min("ts").alias("ts"))
    return e.select("clip_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("start_us"), F.lit(100000.0).alias("dt_us"))


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases, at their tick's time with a shift of up to 60 ms."""
    t = _numbered_events(spark, sf_dir).where("event_type = 'purchase'").select("clip_id", "tick", "event_id")
    return t.join(clip_timing(spark, sf_dir), "clip_id").select("clip_id", (F.col("start_us") + F.col("tick") * 100000 + (F.col("event_id") % 7) * 10000).alias("time_us"))


def frame_ts(spark: SparkSession, sf_dir: str, timing: DataFrame | None = None) -> DataFrame:
    """A 30 fps grid of 620 frames that begins 0.25 s before the clip, with up to 1 ms of jitter."""
    timing = clip_timing(spark, sf_dir) if timing is None else timing
    return timing.select("clip_id", F.explode(F.sequence(F.lit(0), F.lit(619))).alias("frame_index"), "start_us").select(
        "clip_id", "frame_index", (F.col("start_us") - 250000 + F.expr("frame_index * 100000 div 3") + (F.col("frame_index") * 37 % 11) * 100).alias("ts_us"))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns as model answers of nine forms, with the turn's text as explanation: JSON, fenced, after thinking and line
    breaks, none, with a bad score, in single quotes, without a score, only white space, and with text and line breaks around."""
    c = _read(spark, sf_dir, "conversations").where("role = 'assistant'").select("conv_id", "turn", "text", F.length("text").alias("n"))
    k = (F.col("conv_id") + F.col("turn")) % 9
    said = F.to_json(F.struct(F.concat(F.lit("0."), (F.col("n") % 10).cast("string")).alias("scene_score"), F.when(k == 4, "true").otherwise("1").alias("decision_supported_by_video"), F.col("text").alias("explanation")))
    text = (
        F.when(k == 1, F.concat(F.lit("Here:\n```json\n\t"), said, F.lit("\n\n```"))).when(k == 2, F.concat(F.lit("<think>a {b} c</think>\n\n"), said, F.lit("\n"))).when(k == 3, F.lit("no answer"))
        .when(k == 5, F.lit("{'scene_score': 1, 'decision_supported_by_video': 1}")).when(k == 6, F.lit('{"decision_supported_by_video": 1}')).when(k == 7, F.lit("<think>what?</think>\n \t\n")).when(k == 8, F.concat(F.lit("\r\nSo it is "), said, F.lit("\r\n."))).otherwise(said)
    )
    return c.select("conv_id", "turn", text.alias("response"), F.lit(None).cast("string").alias("api_error"))


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result log with retries: one key per conversation, a line per turn."""
    c = _read(spark, sf_dir, "conversations")
    ok = F.col("turn") % 3 != 0
    return c.select(
        F.when(F.col("conv_id") % 11 != 0, F.concat(F.lit("k"), F.col("conv_id").cast("string"))).alias("row_key"), (F.col("conv_id") * 1000 + F.col("turn")).cast("bigint").alias("line_no"), ok.alias("ok"),
        F.when(~ok, "failed").alias("error"), F.lit(None).cast("string").alias("parse_error"), F.when(ok, F.create_map(F.lit("score"), F.lit("1"))).otherwise(F.create_map().cast("map<string,string>")).alias("evaluation"), F.length("text").alias("size"),
    )


PHRASES = ["Change lanes to the left", "Nudge right to pass", "Keep lane and stop", "Turn right", "Slow down"]


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label rows of the documents: a phrase and the whole text, a missing label in every sixth; times that are missing, wrong, negative
    or whole."""
    d = _read(spark, sf_dir, "documents")
    k = F.col("doc_id")
    phrase = F.element_at(F.array(*[F.lit(t) for t in PHRASES], F.lit("")), (k % 6 + 1).cast("int"))
    label = F.when(k % 6 == 5, "\t nan\n").otherwise(F.concat(phrase, F.lit(". "), F.coalesce("text", F.lit(""))))
    stamp = F.when(k % 9 == 0, "x1").when(k % 7 == 0, "").when(k % 11 == 0, " -5.7\n").otherwise((k * 100000).cast("string"))
    return d.select(k.alias("row_index"), F.when(k % 13 != 0, F.concat(F.lit("c"), (k % 50).cast("string"))).alias("clip_id"), stamp.alias("event_timestamp"), label.alias("coc_label"))


LANE_PIECES = 20


def lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per clip a map of five straight lanes, 3.5 m apart, in pieces of 10 m."""
    maps = dealt_out(_numbered_events(spark, sf_dir).select(F.col("clip_id").alias("map_id")).distinct(), "map_id")
    rows = maps.select("map_id", F.explode(F.sequence(F.lit(-2), F.lit(2))).alias("j")).select("map_id", "j", F.explode(F.sequence(F.lit(0), F.lit(LANE_PIECES - 1))).alias("i"))
    name = lambda j, i: F.concat(F.lit("L"), j.cast("string"), F.lit("_"), i.cast("string"))
    j, i, y = F.col("j"), F.col("i"), F.col("j") * 3.5
    some = lambda ok, value: F.when(ok, F.array(value)).otherwise(F.array().cast("array<string>"))
    point = lambda k: F.struct((k * 10.0).alias("x"), y.alias("y"))
    return rows.select("map_id", name(j, i).alias("lane_id"), F.array(point(i), point(i + 1)).alias("center"), some(i < LANE_PIECES - 1, name(j, i + 1)).alias("next"), some(j < 2, name(j + 1, i)).alias("left"), some(j > -2, name(j - 1, i)).alias("right"))


def lane_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poses along those lanes: y follows a command held for 25 ticks, smoothed over 20."""
    by = Window.partitionBy("clip_id").orderBy("tick")
    e = _numbered_events(spark, sf_dir).repartition("clip_id")  # one exchange for the windows by block and by clip
    e = e.withColumn("k", F.get_json_object("props", "$.k").cast("int")).withColumn("block", F.floor(F.col("tick") / 25))
    e = e.withColumn("goal", (F.pmod(F.first("k").over(Window.partitionBy("clip_id", "block").orderBy("tick")), F.lit(3)) - 1) * 3.5)
    e = e.withColumns({"y": F.round(F.avg("goal").over(by.rowsBetween(-19, 0)), 6), "x": F.round(F.col("tick") * 0.8, 6)})
    heading = F.coalesce(F.atan2(F.lead("y").over(by) - F.col("y"), F.lit(0.8)), F.lit(0.0))
    return e.select("clip_id", F.lit("ego").alias("agent_id"), "tick", F.col("clip_id").alias("map_id"), "x", "y", F.round(heading, 6).alias("heading"))


CTES = {
    "ticks": "(" + tick_plan.SQL + ")",
    "motion": "(select *, sqrt(vx * vx + vy * vy) as speed, vx * cos(heading) + vy * sin(heading) as speed_along from ticks)",
    "accel": "(select *, coalesce((speed - lag(speed) over w) / 0.1e0, (lead(speed) over w - speed) / 0.1e0, 0.0e0) as acceleration from motion window w as (partition by clip_id, agent_id order by tick))",
    "smooth": "(select *, avg(acceleration) over (partition by clip_id, agent_id order by tick rows between 2 preceding and 2 following) as smooth, row_number() over (partition by clip_id, agent_id order by tick) as rn, count(*) over (partition by clip_id, agent_id) as n from accel)",
    "lon_state": "(select *, " + " + ".join(
        [f"case when speed_along >= {v} then {1 << i} else 0 end" for i, v in enumerate((0.3, -0.3))]
        + [
            f"case when last_value(case when rn = 1 then smooth >= {v} when smooth >= {v}e0 * {1.15 if v > 0 else 0.85}e0 then true when smooth < {v}e0 * {0.85 if v > 0 else 1.15}e0 then false end ignore nulls) over (partition by clip_id, agent_id order by tick) then {1 << i} else 0 end"
            for i, v in enumerate((0.1, -0.1, 1.25, -1.25), 2)
        ]) + " as state from smooth)",
    "step": "(select *, sqrt(pow(lead(x) over w - x, 2) + pow(lead(y) over w - y, 2)) as distance, lead(heading) over w - heading as dh0, row_number() over w - 1 as i, count(*) over (partition by clip_id, agent_id) as n0 from motion window w as (partition by clip_id, agent_id order by tick))",
    "wrapped": "(select *, (dh0 + pi()) - 2 * pi() * floor((dh0 + pi()) / (2 * pi())) - pi() as dh, n0 - 1 as n from step where i < n0 - 1)",
    "mirror": "(select a.clip_id, a.agent_id, a.i, sum(b.dh) / 5 as turn from wrapped a, (select unnest(range(-2, 3)) as d) k, wrapped b where a.clip_id = b.clip_id and a.agent_id = b.agent_id and b.i = case when a.i + d < 0 then -(a.i + d) when a.i + d > a.n - 1 then 2 * (a.n - 1) - (a.i + d) else a.i + d end group by 1, 2, 3)",
    "turning": "(select w.clip_id, w.agent_id, w.tick, w.i, w.n, w.distance, w.speed_along, m.turn, case when distance > 1e-6 then m.turn / distance else 0 end as turn_rate from wrapped w join mirror m using (clip_id, agent_id, i))",
    "lat_state": "(select *, case when speed_along >= -0.1 then 1 else 0 end + " + " + ".join(f"case when turn_rate >= {v} then {2 << i} else 0 end" for i, v in enumerate((0.001, -0.001, 0.05, -0.05))) + " as state from turning)",
}


def _cuts(name: str, states: str, index: str, closed: bool) -> dict[str, str]:
    end = "n - 1" if closed else "n"
    return {
        f"{name}_st": f"(select clip_id, agent_id, {index} as i, n, state from {states})",
        f"{name}_cut(clip_id, agent_id, seg, start, s, gap, n)": f"(select clip_id, agent_id, 0, i, state, 1, n from {name}_st where i = 0 union all select c.clip_id, c.agent_id, c.seg + 1, min(t.i), arg_min(t.state, t.i), 3, c.n from {name}_cut c join {name}_st t on t.clip_id = c.clip_id and t.agent_id = c.agent_id and t.i >= c.start + c.gap and t.i <= c.n - 4 and t.state <> c.s group by c.clip_id, c.agent_id, c.seg, c.n)",
        f"{name}_span": f"(select * from (select clip_id, agent_id, seg, start, coalesce(lead(start) over (partition by clip_id, agent_id order by seg), {end}) as stop from {name}_cut) where stop > start)",
    }


CTES |= _cuts("lon", "lon_state", "rn - 1", True) | _cuts("lat", "lat_state", "i", False)
CTES |= {
    "lon_seg": "(select s.clip_id, s.agent_id, s.start * 0.1e0 as start_time, (s.stop - s.start) * 0.1e0 as duration, arg_max(speed, rn) - arg_min(speed, rn) as delta_velocity, (arg_max(speed, rn) - arg_min(speed, rn)) / ((s.stop - s.start) * 0.1e0) as average_acceleration, avg(speed) filter (rn - 1 < s.stop) as average_speed, avg(speed_along) filter (rn - 1 < s.stop) as average_speed_along_heading, s.start, s.stop from lon_span s join lon_state t on t.clip_id = s.clip_id and t.agent_id = s.agent_id and t.rn - 1 between s.start and s.stop group by s.clip_id, s.agent_id, s.start, s.stop)",
    "lon_cap": "(select *, case when average_speed_along_heading <= -0.12 then 'Reverse' when average_speed <= 0.12 then 'Stop' when average_acceleration >= 1.4 and delta_velocity >= 0.8 then 'StrongAcceleration' when average_acceleration between 0.15 and 1.4 and delta_velocity >= 0.8 then 'GentleAcceleration' when average_acceleration <= -1.4 and delta_velocity <= -0.8 then 'StrongDeceleration' when average_acceleration between -1.4 and -0.15 and delta_velocity <= -0.8 then 'GentleDeceleration' else 'MaintainSpeed' end as caption from lon_seg)",
    "lat_seg": "(select s.clip_id, s.agent_id, s.start * 0.1e0 as start_time, (s.stop - s.start) * 0.1e0 as duration, sum(turn) as total_heading_change, case when sum(distance) > 1e-6 then sum(turn) / sum(distance) else 0 end as average_turn_rate, sum(distance) as total_distance, avg(speed_along) as average_speed_along_heading, s.start, s.stop from lat_span s join lat_state t on t.clip_id = s.clip_id and t.agent_id = s.agent_id and t.i >= s.start and t.i < s.stop group by s.clip_id, s.agent_id, s.start, s.stop)",
    "lat_cap": "(select *, case when average_speed_along_heading <= -0.1 and average_turn_rate <= -0.002 and total_heading_change <= -0.2 then 'ReverseRight' when average_speed_along_heading <= -0.1 and average_turn_rate >= 0.002 and total_heading_change >= 0.2 then 'ReverseLeft' when average_turn_rate <= -0.05 and total_heading_change <= -0.2 then 'SharpSteerRight' when average_turn_rate >= 0.05 and total_heading_change >= 0.2 then 'SharpSteerLeft' when average_turn_rate <= -0.0015 and total_heading_change <= -0.015 then 'SteerRight' when average_turn_rate >= 0.0015 and total_heading_change >= 0.015 then 'SteerLeft' else 'GoStraight' end as caption from lat_seg)",
    # cleaning: neighbours of one caption merge, then one span after the other is looked at, done and todo being lists, then they merge again
    "islands": "(select *, sum(case when caption = before then 0 else 1 end) over (partition by clip_id, agent_id, family order by start) as g from (select *, lag(caption) over (partition by clip_id, agent_id, family order by start) as before from (select clip_id, agent_id, 'longitudinal' as family, start, start_time, duration, caption from lon_cap union all select clip_id, agent_id, 'lateral', start, start_time, duration, caption from lat_cap)))",
    "begun": "(select clip_id, agent_id, family, list({'c': c, 's': s, 'd': d} order by g) as todo from (select clip_id, agent_id, family, g, any_value(caption) as c, min(start_time) as s, list_reduce(list(duration order by start), lambda a, b: a + b) as d from islands group by all) group by all)",
    "cleaning(clip_id, agent_id, family, done, todo)": "(select clip_id, agent_id, family, cast([] as struct(c varchar, s double, d double)[]), todo from begun union all select clip_id, agent_id, family, r.done, r.todo from (select *, case when now.d >= least or (len(done) = 0 and len(rest) = 0) then {'done': list_append(done, now), 'todo': rest} when len(done) > 0 and len(rest) > 0 then case when was.c = ahead.c then {'done': done[1:len(done) - 1], 'todo': list_prepend({'c': was.c, 's': was.s, 'd': was.d + now.d + ahead.d}, rest[2:])} else {'done': list_append(done[1:len(done) - 1], {'c': was.c, 's': was.s, 'd': was.d + now.d * 0.5e0}), 'todo': list_prepend({'c': ahead.c, 's': ahead.s - 0.5e0 * now.d, 'd': ahead.d + now.d * 0.5e0}, rest[2:])} end when len(done) > 0 then {'done': list_append(done[1:len(done) - 1], {'c': was.c, 's': was.s, 'd': was.d + now.d}), 'todo': rest} else {'done': done, 'todo': list_prepend({'c': ahead.c, 's': now.s, 'd': ahead.d + now.d}, rest[2:])} end as r from (select *, todo[1] as now, todo[2:] as rest, todo[2] as ahead, done[len(done)] as was, case when family = 'lateral' then 10 when todo[1].c = 'MaintainSpeed' then 12 else 8 end * 0.1e0 as least from cleaning where len(todo) > 0)))",
    "cleaned": "(select clip_id, agent_id, family, any_value(c) as tag, min(s) as s, list_reduce(list(d order by i), lambda a, b: a + b) as d from (select *, sum(case when c = before then 0 else 1 end) over (partition by clip_id, agent_id, family order by i) as g from (select *, lag(c) over (partition by clip_id, agent_id, family order by i) as before from (select clip_id, agent_id, family, i, done[i].c as c, done[i].s as s, done[i].d as d from (select *, unnest(range(1, len(done) + 1)) as i from cleaning where len(todo) = 0)))) group by clip_id, agent_id, family, g)",
    "clean_spans": "(select * from (select clip_id, agent_id, family, tag, cast(round_even(round(s, 9) / 0.1e0, 0) as int) as s, cast(round_even(round(s + d, 9) / 0.1e0, 0) as int) as e from cleaned) where e > s)",
    "spans": "(select clip_id, agent_id, 'longitudinal' as family, caption as tag, cast(start as int) as s, cast(stop as int) as e from lon_cap union all select clip_id, agent_id, 'lateral', caption, cast(start as int), cast(stop as int) from lat_cap)",
    "keys": "(select " + "lower(regexp_replace(tag, '([a-z])([A-Z])', '\\1_\\2', 'g')) as meta_action, clip_id, s as event_start_frame, e as event_end_frame, e - s as duration from spans where e - s >= 10 and s between 20 and 135)",
    "numbered": "(select *, 'clip_' || case when i >= 200 then (i // 200) || 'b' else '' end || lpad(cast(user_id as varchar), 6, '0') as clip_id, cast(i % 200 as int) as tick from (select *, row_number() over (partition by user_id order by ts, event_id) - 1 as i from events))",
    "timing": "(select clip_id, epoch_us(min(ts)) as start_us, 100000.0e0 as dt_us from numbered group by clip_id)",
    "episodes": "(select t.clip_id, start_us + tick * 100000 + (event_id % 7) * 10000 as time_us from numbered t join timing using (clip_id) where event_type = 'purchase')",
    "frame_ts": "(select clip_id, cast(f as int) as frame_index, start_us - 250000 + f * 100000 // 3 + (f * 37 % 11) * 100 as ts_us from timing, (select unnest(range(0, 620)) as f))",
    "log": "(select case when conv_id % 11 <> 0 then 'k' || conv_id end as row_key, conv_id * 1000 + turn as line_no, turn % 3 <> 0 as ok, length(text) as size from conversations)",
    "lane_ticks": "(select clip_id, tick, round(tick * 0.8, 6) as x, round(avg(goal) over (partition by clip_id order by tick rows between 19 preceding and current row), 6) as y from (select *, (first_value(cast(json_extract_string(props, '$.k') as int)) over (partition by clip_id, tick // 25 order by tick) % 3 - 1) * 3.5e0 as goal from numbered))",
    "lane_match": "(select clip_id, tick, y, arg_min(lane, (dist, lane)) as lane_id, arg_min(sign(y - j * 3.5) * dist, (dist, lane)) as lane_offset, count(*) as n from (select *, 'L' || j || '_' || i as lane, sqrt(pow(y - j * 3.5, 2) + pow(greatest(i * 10 - x, 0, x - i * 10 - 10), 2)) as dist from lane_ticks, (select unnest(range(-2, 3)) as j), (select unnest(range(0, 20)) as i)) where dist <= 2 group by 1, 2, 3)",
    "lane_sets": "(select t.clip_id, t.tick, coalesce(cur, []) as cur, coalesce(nxt, []) as nxt, coalesce(lft, []) as lft, coalesce(rgt, []) as rgt, lane_id from lane_ticks t left join lane_match m using (clip_id, tick) left join (select clip_id, tick, list_distinct(list('L' || j || '_' || i)) as cur, list_distinct(list('L' || j || '_' || (i + k)) filter (k > 0 and i + k < 20)) as nxt, list_distinct(list('L' || (j + 1) || '_' || (i + k)) filter (j < 2 and i + k < 20)) as lft, list_distinct(list('L' || (j - 1) || '_' || (i + k)) filter (j > -2 and i + k < 20)) as rgt from lane_ticks, (select unnest(range(-2, 3)) as j), (select unnest(range(0, 20)) as i), (select unnest(range(0, 6)) as k) where sqrt(pow(y - j * 3.5, 2) + pow(greatest(i * 10 - x, 0, x - i * 10 - 10), 2)) <= 2 group by clip_id, tick) using (clip_id, tick))",
    "lane_now": "(select *, case when a and b then case when list_contains(rgt, lane_id) and not list_contains(lft, lane_id) then 'right_lane_change' else 'left_lane_change' end when a then 'left_lane_change' when b then 'right_lane_change' else 'keep_lane' end as instant from (select *, list_has_any(cur, lft) as a, list_has_any(cur, rgt) as b from lane_sets))",
    "lane_votes": "(select *, case when len(ahead) = 0 then instant when l > 0 and r = 0 then 'left_lane_change' when r > 0 and l = 0 then 'right_lane_change' when l > 0 and r > 0 then case when instant <> 'keep_lane' then instant when l >= r then 'left_lane_change' else 'right_lane_change' end else 'keep_lane' end as vote from (select *, len([e for e in ahead if not list_contains(cur, e) and not list_contains(nxt, e) and list_contains(lft, e)]) as l, len([e for e in ahead if not list_contains(cur, e) and not list_contains(nxt, e) and list_contains(rgt, e) and not list_contains(lft, e)]) as r from (select n.*, h, z.cur as ahead from lane_now n join (select clip_id, max(tick) as last from lane_now group by clip_id) using (clip_id), lateral (select unnest([5, 10, 15, 20]) as h) hs join lane_now z on z.clip_id = n.clip_id and z.tick = least(n.tick + h, last))))",
    "labels_in": "(select doc_id as row_index, case when doc_id % 13 <> 0 then 'c' || (doc_id % 50) end as clip_id, case when doc_id % 9 = 0 then 'x1' when doc_id % 7 = 0 then '' when doc_id % 11 = 0 then ' -5.7' || chr(10) else cast(doc_id * 100000 as varchar) end as event_timestamp, case when doc_id % 6 = 5 then chr(9) || ' nan' || chr(10) else ['" + "', '".join(PHRASES) + "'][doc_id % 6 + 1] || '. ' || coalesce(text, '') end as coc_label from documents)",
    # what normalising makes of them; times are cut, not rounded
    "rows_in": "(select row_index, clip_id, case when row_index % 6 <> 5 then regexp_replace(coc_label, '^\\s+|\\s+$', '', 'g') end as label, case when row_index % 9 = 0 then null when row_index % 7 = 0 then null when row_index % 11 = 0 then -5 else row_index * 100000 end as us, case when clip_id is null then 'missing_clip_id' when row_index % 6 = 5 then 'missing_coc_label' when row_index % 9 = 0 then 'invalid_timestamp:x1' end as reject_reason from labels_in)",
    "claims_in": "(select row_index, case when t like '%lane change%' or t like '%change lane%' then 'lane_change' when t like '%nudge%' or t like '%leftward%' or t like '%rightward%' then 'nudge' when t like '%keep lane%' then 'keep_lane' when t like '%turn%' then 'turn' else 'unknown' end as type, case when l and not r then 'left' when r and not l then 'right' else '' end as side from (select row_index, t, contains(' ' || t, ' left') or contains(t, 'left ') as l, contains(' ' || t, ' right') or contains(t, 'right ') as r from (select row_index, lower(coc_label) as t from labels_in)))",
}


def with_ctes(select: str, *names: str) -> str:
    """DuckDB SQL of ``select`` with the named CTEs and all that they need."""
    order = list(CTES)
    need: set[str] = set()

    def take(name: str) -> None:
        if name not in need:
            need.add(name)
            for other in order[: order.index(name)]:
                if any(word == other.split("(")[0] for word in _words(CTES[name])):
                    take(other)

    for n in names:
        take(next(o for o in order if o.split("(")[0] == n))
    return "with recursive " + ",\n".join(f"{n} as {CTES[n]}" for n in order if n in need) + "\n" + select


def _words(sql: str) -> set[str]:
    return set("".join(c if c.isalnum() or c == "_" else " " for c in sql).split())
