"""Registered queries around events: outputs, videos, archives, prompts, scoring and the log stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from clipspans.functions import text
from clipspans.operators import features, intervals, joins, keyframes, prompts, results, stages
from clipspans.plans import inputs
from clipspans.plans.catalog import query
from clipspans.sources.buckets import write_bucketed
from clipspans.streaming.compact import compact_stream


def _events(spark, d):
    return joins.event_time(inputs.keyframe_rows(spark, d), inputs.clip_timing(spark, d))


@query("p7_ego_only", "select clip_id, tick from ticks where tick % 7 <> 0", "ticks")
def _ego(spark, d):
    t = inputs.ticks(spark, d).withColumn("agent_id", F.when(F.col("tick") % 7 == 0, "car").otherwise("ego"))
    return keyframes.ego_only(t).select("clip_id", "tick")


@query("p11_group_filter", "select clip_id, tick from ticks where clip_id like 'clip_00000%'", "ticks")
def _group(spark, d):
    return keyframes.group_filter(inputs.ticks(spark, d), "clip_00000").select("clip_id", "tick")


@query("p12_finite_poses", "select clip_id, tick from ticks where tick % 5 not in (1, 2, 3)", "ticks")
def _finite(spark, d):
    k = F.col("tick") % 5
    t = inputs.ticks(spark, d).withColumn("x", F.when(k == 1, F.lit(None)).when(k == 2, float("nan")).when(k == 3, float("-inf")).otherwise(F.col("x")))
    return keyframes.finite_poses(t).select("clip_id", "tick")


@query("k13_object_rows", """select clip_id, agent_id, cast(row_number() over (partition by clip_id order by agent_id) - 1 as int) as running_id, cast(agent_id[5:] as int) as id_global, type, box, past, future from
  (select clip_id, 'car_' || k as agent_id, max(case when tick = 10 then 'T' || k end) as type, max(case when tick = 10 then array_to_string([round(v, 6) + 0.0e0 for v in [-(y + k), x, k * 1.0e0, 2.0e0, 4.0e0 + k, 1.5e0, heading]], ' ') end) as box,
  string_agg(printf('%.4f', -(y + k) + 0.0e0) || ' ' || printf('%.4f', x), ',' order by tick) filter (tick <= 10 and tick % 3 = 0) as past, string_agg(printf('%.4f', -(y + k) + 0.0e0) || ' ' || printf('%.4f', x), ',' order by tick) filter (tick > 10 and tick <= 40 and (tick - 11) % 3 = 2) as future
  from (select clip_id, tick, x, y, heading, k from ticks, (select unnest([0, 1, 2]) as k)) group by all) where type is not null""", "ticks")
def _objects(spark, d):
    """Three cars beside each ego, which is left out; every third tick, and 30 ticks ahead."""
    t = inputs.ticks(spark, d)
    k = F.col("k")
    cars = t.withColumn("k", F.explode(F.array(*[F.lit(i) for i in (0, 1, 2)]))).withColumns({"agent_id": F.concat(F.lit("car_"), k.cast("string")), "y": F.col("y") + k, "z": k.cast("double"), "length": 4.0 + k, "width": F.lit(2.0), "height": F.lit(1.5), "type": F.concat(F.lit("T"), k.cast("string"))}).drop("k")
    found = features.object_rows(cars.unionByName(t, allowMissingColumns=True), 10, 3, 30)
    path = lambda c: F.when(F.size(c) > 0, F.array_join(F.transform(c, lambda p: F.format_string("%.4f %.4f", p["x"] + 0.0, p["y"])), ",")).alias(c)
    box = F.array_join(F.transform(F.slice("box", 1, 7), lambda v: F.round(v, 6).cast("string")), " ").alias("box")
    return found.select("clip_id", "agent_id", "running_id", "id_global", "type", box, path("past"), path("future"))


@query("k13_ego_state", "select clip_id, vx, vy, 0.5e0 as ax, -0.5e0 as ay, round(coalesce(a * 10, b * 10, 0), 6) as yaw_rate, 4.5e0 as length, 2.0e0 as width, round(sqrt(vx * vx + vy * vy), 6) as speed from (select *, (q + pi()) - 2 * pi() * floor((q + pi()) / (2 * pi())) - pi() as a, (p + pi()) - 2 * pi() * floor((p + pi()) / (2 * pi())) - pi() as b from (select *, lead(heading) over w - heading as q, heading - lag(heading) over w as p from ticks window w as (partition by clip_id order by tick))) where tick = 10", "ticks")
def _ego_state(spark, d):
    t = inputs.ticks(spark, d).withColumns({"ax": F.lit(0.5), "ay": F.lit(-0.5), "length": F.lit(4.5), "width": F.lit(2.0)})
    return features.ego_state(t, 10).withColumns({"yaw_rate": F.round("yaw_rate", 6), "speed": F.round("speed", 6)})


@query("k15_heading_rate", "select clip_id, tick as frame, round(coalesce(atan2(sin(q), cos(q)) / greatest(greatest(speed, 0) / 30.0e0, 1e-6), 0), 4) + 0.0e0 as heading_rate from (select *, heading - lag(heading) over (partition by clip_id order by tick) as q from motion)", "motion")
def _heading_rate(spark, d):
    t = features.add_speed(inputs.ticks(spark, d)).withColumnRenamed("tick", "frame")
    return features.heading_rate_by_speed(t).select("clip_id", "frame", F.round("heading_rate", 4).alias("heading_rate"))


@query("i8_expand_gt", """select clip_id, cast(f as int) as frame, arg_max(tag, s) as longitudinal from (select clip_id, tag, s, unnest(range(least(600, cast(round_even(greatest(s * 100 - (s % 5) * 100, 0) * 30 / 1000.0, 0) as int)), least(600, cast(round_even(greatest(e * 100 - (s % 5) * 100, 0) * 30 / 1000.0, 0) as int)))) as f
  from spans where family = 'longitudinal') group by clip_id, f""", "spans")
def _truth(spark, d):
    s = inputs.spans(spark, d).where("family = 'longitudinal'")
    ms = lambda c: (F.col(c) * 100 - (F.col("start") % 5) * 100).cast("int")
    gt = s.select("clip_id", F.col("start").alias("row_no"), ms("start").alias("segment_start_ms"), ms("end").alias("segment_end_ms"), F.col("tag").alias("gt_longitudinal"), F.lit("").alias("gt_lateral"), F.lit("").alias("gt_lane"))
    return intervals.expand_gt(gt).select("clip_id", "frame", "longitudinal")


@query("a10_token_usage", "select role as model, cast(sum(length(text)) as bigint) as prompt_tokens, cast(sum(turn) as bigint) as response_tokens, cast(sum(conv_id % 7) as bigint) as reasoning_tokens from conversations group by role")
def _tokens(spark, d):
    c = spark.read.parquet(f"{d}/conversations.parquet")
    return results.token_usage(c.select(F.col("role").alias("model"), F.length("text").alias("prompt_tokens"), F.col("turn").alias("response_tokens"), (F.col("conv_id") % 7).alias("reasoning_tokens")))


@query("j5_pending", "select clip_id, meta_action, event_start_frame from keys join timing using (clip_id) where event_start_frame % 4 <> 0", "keys", "timing")
def _pending(spark, d):
    e = _events(spark, d)
    k = F.col("event_start_frame") % 4
    done = e.withColumns({"content": F.when(k == 0, "label: x").when(k == 1, "   ").when(k == 2, "{}"), "size": F.when(k == 3, 0).otherwise(9)}).select("clip_id", "event_start_us", "size", "content")
    return joins.pending_segments(e, done).select("clip_id", "meta_action", "event_start_frame")


@query("j7_allowed_clips", "select clip_id, meta_action, event_start_frame from keys where clip_id like '%3'", "keys")
def _allowed(spark, d):
    return joins.allowed_clips(inputs.keyframe_rows(spark, d), inputs.clip_timing(spark, d).where("clip_id like '%3'").select("clip_id")).select("clip_id", "meta_action", "event_start_frame")


@query("j9_plan_extraction", """with p as (select page_id % 40 as n, 'z' || (page_id % 3) || '.zip' as z, page_id // 40 % 4 as k from pages),
  m as (select n, 'c' || n as clip, z, case when k = 0 then 'c' || n || '.cam.timestamps' when k = 1 then 'cam.mp4' when k = 2 then 'c' || n || '.old.mp4' else 'notes.txt' end as leaf from p where not (k in (1, 2) and n % 4 = 1)),
  t as (select clip, case when leaf like '%.mp4' then clip || '.cam.mp4' else clip || '.cam.timestamps' end as target_name, min({'z': z, 'm': 'a/' || clip || '/' || leaf}) as f from m where leaf <> 'notes.txt' group by all),
  c as (select 'c' || i as clip_id, case when i % 5 = 0 then 'existing' when 'c' || i not in (select clip from t) then 'missing_archive' when 'c' || i not in (select clip from t where target_name like '%.mp4') then 'missing_video' else 'pending' end as status from (select distinct page_id % 50 as i from pages))
  select clip_id, status, target_name, 'x/' || f.z as zip_path, f.m as member_name from c left join t on clip = clip_id and status = 'pending'""")
def _extraction(spark, d):
    """Videos under three names, time files and other members in three archives; some clips have time files only, or nothing."""
    p = spark.read.parquet(f"{d}/pages.parquet")
    n, k = F.col("page_id") % 40, F.expr("page_id div 40 % 4")
    clip = F.concat(F.lit("c"), n.cast("string"))
    leaf = F.when(k == 0, F.concat(clip, F.lit(".cam.timestamps"))).when(k == 1, "cam.mp4").when(k == 2, F.concat(clip, F.lit(".old.mp4"))).otherwise("notes.txt")
    members = p.where(~(k.isin(1, 2) & (n % 4 == 1))).select(F.concat(F.lit("x/z"), (F.col("page_id") % 3).cast("string"), F.lit(".zip")).alias("zip_path"), F.concat(F.lit("a/"), clip, F.lit("/"), leaf).alias("member_name"))
    clips = p.select(F.concat(F.lit("c"), (F.col("page_id") % 50).cast("string")).alias("clip_id")).distinct()
    return joins.plan_extraction(joins.match_members(members, clips, "cam"), clips, clips.where("cast(substring(clip_id, 2) as int) % 5 = 0"), "cam")


@query("j10_resolve_video", """select row_index, case when row_index % 4 = 0 then 'hint' || (row_index % 20) || '.mp4' when clip_id in ('c1', 'c2', 'c3') then clip_id || '/raw.mp4' end as video_path, case when row_index % 4 = 0 then 'hint' when clip_id in ('c1', 'c2', 'c3') then 'raw' end as video_source from labels_in""", "labels_in")
def _video(spark, d):
    labels = inputs.labels(spark, d).withColumn("video_path_hint", F.when(F.col("row_index") % 2 == 0, F.concat(F.lit("hint"), (F.col("row_index") % 20).cast("string"), F.lit(".mp4"))))
    ids = inputs.labels(spark, d).where("clip_id in ('c1', 'c2', 'c3')").select("clip_id").distinct()
    files = ids.select(F.concat("clip_id", F.lit("/raw.mp4")).alias("path"), "clip_id", F.lit(1).alias("priority"), F.lit("raw").alias("source")).unionByName(
        ids.select(F.concat("clip_id", F.lit("/saved.mp4")).alias("path"), "clip_id", F.lit(2).alias("priority"), F.lit("saved").alias("source"))).unionByName(
        labels.where("row_index % 4 = 0").select(F.col("video_path_hint").alias("path"), F.lit("none").alias("clip_id"), F.lit(3).alias("priority"), F.lit("x").alias("source")).distinct())
    return joins.resolve_video(labels, files).select("row_index", "video_path", "video_source")


# the places of a clip's video by its number's remainder, as (remainders, place); {g} four characters of the clip
_PLACES = [
    ([0, 5], "/v/camera/{c}.{m}.mp4"), ([1, 5], "/v/{c}.{m}.mp4"), ([2, 6], "/v/{c}_fpv.mp4"), ([3, 6], "/v/{c}.mp4"), ([4, 7], "/v/{g}/{c}/recordings/recorder-00/{m}.mp4"), ([8, 7], "/v/{c}/recordings/recorder-00/{m}.mp4"),
    ([9, 10], "/v/{g}/{c}/recordings/recorder-03/{m}.mp4"), ([10, 11], "/v/other/{c}/recordings/recorder-02/{m}.mp4"), ([12, 13], "/v/{c}/deep/er/{m}.mp4"), ([13, 14], "/v/{g}/{c}/some/{m}.mp4"), ([15], "/w/{c}.mp4"), ([16], "/v/{c}/recordings/recorder-05/wrong.mp4"),
]


def _place(text: str) -> str:
    return "'" + text.replace("{c}", "' || clip || '").replace("{g}", "' || clip[:4] || '").replace("{m}", "' || cam || '") + "'"


_HIT = "case " + " ".join(f"when i % 17 in ({', '.join(map(str, r))}) then {k}" for k, (r, _) in enumerate(_PLACES[:10])) + " end"
_PATH = "case k " + " ".join(f"when {k} then {_place(p)}" for k, (_, p) in enumerate(_PLACES[:10])) + " end"


@query("j10_find_videos", f"""select i as row_index, case when i % 5 = 2 then '/h/' || i || '.mp4' else {_PATH} end as video_path, case when i % 5 = 2 then 'hint' when k is not null then 'video_root' end as video_source from
  (select *, {_HIT} as k from (select row_index as i, clip_id || '-' || row_index as clip, case when row_index % 3 = 0 then 'camera_rear' else 'cam' end as cam from labels_in where clip_id is not null))""", "labels_in")
def _find_videos(spark, d):
    """Every place of a raw video, two at a time for some clips, with the row's own camera for every third row; hints that exist for every
    fifth row, and hints that are gone for the next."""
    rows = inputs.labels(spark, d).where("clip_id is not null")
    i = F.col("row_index")
    rows = rows.select("row_index", F.concat_ws("-", "clip_id", "row_index").alias("clip_id"), F.when(i % 3 == 0, "camera_rear").when(i % 3 == 1, "").alias("camera_name"), F.when(i % 5 >= 2, F.concat(F.lit("/h/"), i, F.lit(".mp4"))).alias("video_path_hint"))
    named = rows.withColumn("m", F.when(i % 3 == 0, "camera_rear").otherwise("cam"))
    put = lambda p: F.replace(F.replace(F.replace(F.lit(p), F.lit("{c}"), F.col("clip_id")), F.lit("{g}"), F.substring("clip_id", 1, 4)), F.lit("{m}"), F.col("m"))
    there = F.filter(F.array(*[F.when((i % 17).isin(r), put(p)) for r, p in _PLACES], F.when(i % 5 == 2, F.col("video_path_hint"))), lambda x: x.isNotNull())
    return joins.find_videos(rows, named.select(F.explode(there).alias("path")), "/v", "cam").select("row_index", "video_path", "video_source")


@query("j11_clip_chunk", "select clip_id, case when clip_id not like '%5' then length(clip_id) end as chunk from timing", "timing")
def _chunk(spark, d):
    t = inputs.clip_timing(spark, d)
    return joins.clip_chunk(t.select("clip_id"), t.where("clip_id not like '%5'").select("clip_id", F.length("clip_id").alias("chunk")))


@query("j12_assemble", "select clip_id, event_start_us, speed is not null as has_speed from (select distinct clip_id, cast(start_us + event_start_frame * dt_us as bigint) as event_start_us, event_start_frame as f from keys join timing using (clip_id)) left join (select clip_id, tick as f, speed from motion where tick % 2 = 0) using (clip_id, f)", "keys", "timing", "motion")
def _assemble(spark, d):
    e = _events(spark, d).select("clip_id", "event_start_us", "event_start_frame").distinct()
    s = features.add_speed(inputs.ticks(spark, d)).where("tick % 2 = 0").select("clip_id", F.col("tick").alias("event_start_frame"), "speed")
    part = e.join(s, ["clip_id", "event_start_frame"]).select("clip_id", "event_start_us", "speed")
    return joins.assemble(e, part).select("clip_id", "event_start_us", F.col("speed").isNotNull().alias("has_speed"))


@query("j12_bucketed", "select clip_id, event_start_us, speed, later is not null as has_later from (select distinct clip_id, cast(start_us + event_start_frame * dt_us as bigint) as event_start_us, event_start_frame as f from keys join timing using (clip_id)) left join (select clip_id, tick as f, round(speed, 6) + 0.0e0 as speed from motion) using (clip_id, f) left join (select clip_id, tick - 40 as f, tick as later from motion) using (clip_id, f)", "keys", "timing", "motion")
def _bucketed(spark, d):
    """Events and ticks in buckets by clip and frame: the speeds of events are found without an exchange of ticks."""
    base = inputs.shared_path(spark)
    e = _events(spark, d).select("clip_id", "event_start_us", "event_start_frame").distinct()
    ticks = features.add_speed(inputs.ticks(spark, d)).select("clip_id", F.col("tick").alias("event_start_frame"), F.round("speed", 6).alias("speed"))
    keys = ("clip_id", "event_start_frame")
    events, ticks = (write_bucketed(t, f"{base}/{n}", keys) for t, n in ((e, "events"), (ticks, "ticks")))
    later = ticks.select("clip_id", (F.col("event_start_frame") - 40).alias("event_start_frame"), F.lit(True).alias("later"))
    return joins.assemble(events, ticks, later, keys=keys).select("clip_id", "event_start_us", "speed", F.col("later").isNotNull().alias("has_later"))


@query("e2_action_text", """select clip_id, event_start_frame, 'Meta actions:' || chr(10) || string_agg('(t=' || printf('%+.1f', (f - event_start_frame) * 0.1) || 's) longitudinal: ' || lon || ', lateral: -, lane: Not Available', chr(10) order by f) as action_text from
  (select k.clip_id, k.event_start_frame, f, coalesce((select arg_max(tag, s) from spans p where p.family = 'longitudinal' and p.clip_id = k.clip_id and f >= s and f < e), 'Not Available') as lon from (select distinct clip_id, event_start_frame from keys) k,
  lateral (select unnest(range(greatest(k.event_start_frame - 20, 0), k.event_start_frame, 5)) as f union all select unnest(range(k.event_start_frame, least(k.event_start_frame + 60, 200), 5))) g) group by 1, 2""", "keys", "spans")
def _action_text(spark, d):
    spans = inputs.stored_spans(spark, d)
    s = inputs.numbered(spans)
    window = prompts.span_action_window(inputs.keyframe_rows(spark, d, spans).select("clip_id", "event_start_frame").distinct(), s, spans)
    return prompts.action_text_block(window.withColumn("lateral", F.lit("-")))


_SAMPLES = "string_agg('(t=' || printf('%.1f', (tick - e) * 0.1e0) || 's, v_{0}=' || printf('%.3f', {0}_speed) || ' m/s)', ', ' order by tick) filter ({1})"


def _speed_sql(head: str, rows: str) -> str:
    return f"'{head}' || chr(10) || '- Longitudinal (m/s): [' || coalesce({_SAMPLES.format('long', rows)}, '') || ']' || chr(10) || '- Lateral (m/s): [' || coalesce({_SAMPLES.format('lat', rows)}, '') || ']'"


@query("e3_speed_text", f"""select clip_id, e as event_start_frame, {_speed_sql('History speed samples:', 'tick <= e')} as history_text, {_speed_sql('Future speed samples:', 'tick > e')} as future_text,
  {_speed_sql('Ego speed time series (relative to event time t=0.0s):', 'true')} || chr(10) || 'Positive lateral speed means rightward motion, negative means leftward motion.' as speed_text
  from (select distinct clip_id, event_start_frame as e from keys) join (select clip_id, tick, round(vx * cos(heading) + vy * sin(heading), 5) + 0.0e0 as long_speed, round(-vx * sin(heading) + vy * cos(heading), 5) + 0.0e0 as lat_speed from ticks) using (clip_id) where tick between e - 9 and e + 165 group by clip_id, e""", "keys", "ticks")
def _speed_text(spark, d):
    """One second before each keyframe's event, and up to 16.5 s after it."""
    t = features.long_lat_speed(inputs.ticks(spark, d)).select("clip_id", "tick", F.struct(F.round("lon_speed", 5).alias("lon"), F.round("lat_speed", 5).alias("lat")).alias("v"))
    k = inputs.keyframe_rows(spark, d).select("clip_id", "event_start_frame").distinct()
    rows = k.join(t, "clip_id").where("tick between event_start_frame - 9 and event_start_frame + 165")  # a clip has 200 ticks at most
    pick = lambda cond, name: F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("tick", "v")))), lambda x: x["v"]).alias(name)
    series = rows.groupBy("clip_id", "event_start_frame").agg(pick(F.col("tick") <= F.col("event_start_frame"), "history"), pick(F.col("tick") > F.col("event_start_frame"), "future"))
    return prompts.speed_text(series).select("clip_id", "event_start_frame", "history_text", "future_text", "speed_text")


@query("e5_manifest", "select clip_id, event_start_us, clip_id || '_' || event_start_us || '.mp4' as segment_file, 3 as n, printf('frame_%06d.jpg', f * 3) as first_file, t.ts_us as first_ts from (select distinct clip_id, cast(start_us + event_start_frame * dt_us as bigint) as event_start_us, event_start_frame as f from keys join timing using (clip_id)) left join (select clip_id, frame_index, ts_us from frame_ts) t using (clip_id) where t.frame_index = f * 3", "keys", "timing", "frame_ts")
def _manifest(spark, d):
    timing = inputs.stored(inputs.clip_timing(spark, d))
    e = joins.event_time(inputs.keyframe_rows(spark, d), timing).select("clip_id", "event_start_us", "event_start_frame").distinct()
    wanted = e.withColumn("frame_index", F.explode(F.array(*[F.col("event_start_frame") * 3 + k for k in (0, 3, 6)])))
    m = prompts.frame_manifest(joins.frame_timestamp(wanted.drop("event_start_frame"), inputs.frame_ts(spark, d, timing), inputs.frame_parts(timing)))
    first = F.element_at("manifest", 1)
    return m.select("clip_id", "event_start_us", "segment_file", F.size("manifest").alias("n"), first["file"].alias("first_file"), first["ts_us"].alias("first_ts"))


@query("e6_prompts", "select row_index, 2 as messages, 2 as user_parts, coc_label as last_content from labels_in", "labels_in")
def _messages(spark, d):
    parts = [("system", "text", F.lit("s")), ("user", "text", F.col("row_index")), ("user", "text", F.col("coc_label"))]
    m = prompts.build_prompts(inputs.labels(spark, d), parts)
    return m.select("row_index", F.size("messages").alias("messages"), F.size(F.element_at("messages", 2)["content"]).alias("user_parts"), F.element_at(F.element_at("messages", 2)["content"], 2)["content"].alias("last_content"))


@query("e7_stage_prompts", """select row_index, 'Label {"label":' || to_json(coc_label)::varchar || '} of {"row_index":' || row_index || '}' as prompt, 2 as stage from labels_in""", "labels_in")
def _stage_prompts(spark, d):
    return prompts.stage_prompts(inputs.labels(spark, d), 2, "Label %s of %s", metadata=("row_index",)).select("row_index", "prompt", "stage")


@query("e8_stage_window", """select row_index, mode, video, wide, case when saved then 'segment_8s' else 'raw' end as video_mode, case when err is null then case when saved then o else greatest(0, sec - 2 + o) end end as start_s, case when err is null then d end as duration_s, err as window_error from
  (select *, case when saved then null when us is null then 'missing_event_timestamp' when mode = 'other' then 'unsupported_timestamp_mode:other' when bad is not null and mode <> 'relative' then 'timestamp_sidecar_error:' || bad when sec is null and mode = 'sidecar' then 'missing_timestamp_sidecar' when sec is null then 'timestamp_requires_sidecar' end as err from
  (select *, case mode when 'auto' then coalesce(side, rel) when 'sidecar' then side when 'relative' then rel end as sec from
  (select row_index, mode, video, wide, case video when 'auto' then row_index % 10 = 0 and row_index % 20 = 0 when 'raw' then false else true end as saved, case when wide then 0.0e0 else 2.0e0 end as o, case when wide then 8.0e0 else 6.0e0 end as d, us, case when row_index % 4 = 1 then 7.5e0 end as side, case when row_index % 4 = 3 then 'gone' end as bad, case when us between 0 and 600000000 then us / 1e6 end as rel
  from (select row_index, case when row_index % 7 = 0 then null when row_index % 11 = 0 then -5 else row_index * 1000000 end as us from labels_in), (select unnest(['auto', 'sidecar', 'relative', 'other']) as mode), (select unnest(['auto', 'raw', 'segment_8s']) as video), (select unnest([false, true]) as wide))))""", "labels_in")
def _stage_window(spark, d):
    """All modes, with the usual and the whole window of stage 2; negative, missing and late times; time files without the event; every
    second hint of a saved segment is gone, so that the raw video is taken."""
    i = F.col("row_index")
    labels = inputs.labels(spark, d).withColumns({
        "event_timestamp": F.when(i % 7 == 0, F.lit(None)).when(i % 11 == 0, -5).otherwise(i * 1000000).cast("bigint"),
        "hint_is_saved_segment": i % 10 == 0, "video_source": F.when(i % 20 == 0, "hint").otherwise("video_root"), "side": F.when(i % 4 == 1, 7.5), "bad": F.when(i % 4 == 3, "gone"),
    })
    out = [
        prompts.stage_window(labels, 2, seconds="side", problem="bad", source="video_source", mode=mode, video_mode=video, full=wide).withColumns({"mode": F.lit(mode), "video": F.lit(video), "wide": F.lit(wide)})
        for mode in (*prompts.TIME_MODES, "other") for video in prompts.VIDEO_MODES for wide in (False, True)
    ]
    return reduce(lambda a, b: a.unionByName(b), out).select("row_index", "mode", "video", "wide", "video_mode", "start_s", "duration_s", "window_error")


@query("e8_sidecar_seconds", """select r.row_index, case when us between low and high then nearest / 30.0e0 end as seconds, case when n = 0 then 'empty_timestamp_mapping' when us not between low and high then 'timestamp_out_of_range:' || us || ':range=' || low || '..' || high end as sidecar_problem
  from (select row_index, clip_id || '.mp4' as video, us from rows_in where us is not null and clip_id is not null) r left join
  (select row_index, min(ts) as low, max(ts) as high, count(ts) as n, arg_min(f, (abs(ts - us), ts)) as nearest from rows_in join (select 'c' || c as clip_id, f, case when c % 10 <> 4 then c * 70000 + f * 33333 end as ts from range(0, 50) t(c), range(0, 300) u(f) where c % 10 <> 3 and (c % 10 <> 4 or f = 0)) using (clip_id) group by row_index) using (row_index)""", "rows_in")
def _sidecar_seconds(spark, d):
    """Videos with a time file of 300 frames, some without one and some with an empty one; events before, in and after them."""
    rows = text.normalize_record(inputs.labels(spark, d)).where("event_timestamp is not null and clip_id is not null").select("row_index", F.concat("clip_id", F.lit(".mp4")).alias("video_path"), "event_timestamp", "clip_id")
    c = F.substring("clip_id", 2, 9).cast("bigint")
    clips = rows.select("video_path", c.alias("c")).distinct().where("c % 10 <> 3")
    frames = clips.withColumn("frame_index", F.explode(F.when(F.col("c") % 10 == 4, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(299)))))
    ts = frames.select("video_path", "frame_index", F.when(F.col("c") % 10 != 4, F.col("c") * 70000 + F.col("frame_index") * 33333).alias("ts_us"))
    return joins.sidecar_seconds(rows, ts).select("row_index", "seconds", "sidecar_problem")


@query("e11_needs_repair", """select row_index, case when type = '' then null when t = 'keep_lane' then 'keep_lane_despite_prior' when t <> type then 'type:' || t || '->' || type when side <> '' and c <> side then 'direction:' || case when c = '' then 'none' else c end || '->' || side end as reason from
  (select row_index, type as t, side as c, ['', 'lane_change', 'nudge'][row_index % 5 % 3 + 1] as type, ['left', 'right', ''][row_index % 7 % 3 + 1] as side from claims_in)""", "claims_in")
def _needs_repair(spark, d):
    pick = lambda values, by: F.element_at(F.array(*[F.lit(v) for v in values]), (by % 3 + 1).cast("int"))
    labels = inputs.labels(spark, d).withColumns({"expected_type": pick(["", "lane_change", "nudge"], F.col("row_index") % 5), "expected_direction": pick(["left", "right", ""], F.col("row_index") % 7)})
    labels = labels.withColumn("has_prior", F.col("expected_type") != "")
    return labels.select("row_index", prompts.needs_repair(prompts.claim_from_text(F.col("coc_label"))).alias("reason"))


@query("e12_merge_repair", """select row_index, case when row_index % 3 = 0 then 'fixed' else coc_label end as content, coc_label as content_original, row_index % 3 = 0 as repaired, row_index % 2 = 0 or row_index % 3 = 0 as triggered, case when row_index % 2 = 0 then 'r' || row_index end as reason, case when row_index % 3 = 0 then 'v3+v4' else 'v3' end as pipeline_version from labels_in""", "labels_in")
def _repair(spark, d):
    first = inputs.labels(spark, d).select("row_index", F.col("coc_label").alias("content"))
    second = first.where("row_index % 3 = 0").select("row_index", F.lit("fixed").alias("content"))
    reason = F.when(F.col("row_index") % 2 == 0, F.concat(F.lit("r"), F.col("row_index").cast("string")))
    out = prompts.merge_repair(first, second, ("row_index",), reason=reason, versions=("v3", "v4"))
    return out.select("row_index", "content", "content_original", "repaired", "audit.triggered", "audit.reason", "audit.pipeline_version")


_UUID = "01234567-89ab-cdef-0123-456789abcdef"


@query("f5_clip_ids", f"""select page_id, case when k < 18 then 'c' || n when k = 18 then 'c' || n || '.parquet' when k = 19 then 'c' || n || '.other.mp4.timestamps' when k = 20 then '{_UUID}' when k = 21 then '{_UUID}' when k = 22 then 'c' || n end as clip_id from (select page_id, page_id % 40 as n, page_id % 24 as k from pages)""")
def _clip_names(spark, d):
    """Every ending, endings that aren't cut, ids in front of other text, a folder, and a blank name."""
    p = spark.read.parquet(f"{d}/pages.parquet")
    name = F.concat(F.lit("a/b/c"), (F.col("page_id") % 40).cast("string"))
    paths = [F.concat(name, F.lit(e.format("cam"))) for e in text.CLIP_ENDINGS]
    paths += [F.concat(name, F.lit(".parquet")), F.concat(name, F.lit(".other.mp4.timestamps")), F.lit(f"x/{_UUID}.cam.mp4"), F.lit(f"{_UUID}_more.parquet"), F.concat(name, F.lit("/")), F.lit("a/ ")]
    return p.select("page_id", text.normalize_clip_id(F.element_at(F.array(*paths), (F.col("page_id") % 24 + 1).cast("int")), "cam").alias("clip_id"))


@query("f4_parse_tag", """select page_id, case k when 0 then 'Stop' when 1 then 'Follow' when 2 then 'Stop' end as tag, case k when 0 then 'ego' when 1 then 'ego,car' || n when 2 then 'ego' end as agents, case when k < 3 then n end as start, case when k < 3 then n + 7 end as "end", case k when 0 then 'unary' when 1 then 'binary' when 2 then 'unary' end as type from (select page_id, cast(page_id % 30 as int) as n, page_id % 5 as k from pages)""")
def _tags(spark, d):
    n, k = (F.col("page_id") % 30).cast("string"), F.col("page_id") % 5
    to = F.concat(F.lit(" at "), n, F.lit("-"), (F.col("page_id") % 30 + 7).cast("string"), F.lit(")"))
    tag = F.when(k == 0, F.concat(F.lit("Stop(ego"), to)).when(k == 1, F.concat(F.lit("Follow(ego, car"), n, to)).when(k == 2, F.concat(F.lit(" StopTemporal(ego"), to)).when(k == 3, "Stop(ego at x-3)").otherwise("Stop")
    parsed = spark.read.parquet(f"{d}/pages.parquet").select("page_id", text.parse_tag(tag).alias("p"))
    return parsed.select("page_id", "p.tag", F.array_join("p.agents", ",").alias("agents"), "p.start", "p.end", "p.type")


@query("f10_camera", "select conv_id, turn, case when turn % 3 = 0 then 'camera_front_wide_120fov' when turn % 3 = 1 then 'camera_front_' || conv_id end as camera from conversations")
def _camera(spark, d):
    c = spark.read.parquet(f"{d}/conversations.parquet")
    own = F.concat(F.lit("see camera_front_"), F.col("conv_id").cast("string"), F.lit(" here"))
    lists = F.when(F.col("turn") % 3 == 0, F.array(F.lit("none"), F.lit("a camera_front_wide_120fov."), own)).when(F.col("turn") % 3 == 1, F.array(own)).otherwise(F.array(F.lit("camera_rear"), F.lit("")))
    return c.select("conv_id", "turn", text.camera_of(lists).alias("camera"))


@query("i6_counters", "select clip_id, count(*) filter (tag like '%Left%') as malformed, count(*) filter (tag not like '%Left%' and e + 150 > 200) as out_of_range from spans group by clip_id", "spans")
def _frame_counters(spark, d):
    """Left-hand spans are turned round, and all moved by 150 ticks."""
    s = inputs.spans(spark, d)
    turned = F.col("tag").contains("Left")
    start, end = F.when(turned, F.col("end")).otherwise(F.col("start")), F.when(turned, F.col("start")).otherwise(F.col("end"))
    return intervals.frame_counters(s.select("clip_id", (start + 150).alias("start"), (end + 150).alias("end")))


@query("u4_stage_run", "select row_index, true as ok, 'x' || length(coc_label) as answer from labels_in where clip_id is not null and row_index % 3 <> 0", "labels_in")
def _stage(spark, d):
    labels = inputs.labels(spark, d).where("clip_id is not null").withColumn("event_timestamp", F.lit(None).cast("bigint"))
    done = labels.where("row_index % 3 = 0").select(text.row_key(F.col("clip_id"), F.col("event_timestamp"), F.col("row_index")).alias("row_key"), F.col("row_index").alias("line_no"), F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("parse_error"), F.create_map(F.lit("a"), F.lit("1")).alias("evaluation"))
    out = results.stage_run(labels, done, F.col("coc_label"), ["s_score", "a"], lambda batch: [f'{{"s_score": 1, "a": "x{len(p)}"}}' for p in batch])
    return out.select("row_index", "ok", F.col("evaluation")["a"].alias("answer"))


# a stage 3 run: hints of saved segments, of which every second is gone; raw videos for some clips; time files for clips ending in 1 or 2, an
# empty one for those in 2
_STAGE = """(select *, case when error is null and base is not null then greatest(0, base) end as start_s from (select *, case when reject_reason is not null then reject_reason when video is null then 'missing_video' when saved then null when us is null then 'missing_event_timestamp'
  when clip_id[-1] = '2' then 'timestamp_sidecar_error:empty_timestamp_mapping' when clip_id[-1] = '1' and us not between 0 and 29900000 then 'timestamp_sidecar_error:timestamp_out_of_range:' || us || ':range=0..29900000' when clip_id[-1] <> '1' and us not between 0 and 600000000 then 'timestamp_requires_sidecar' end as error,
  case when saved then 0.0e0 when clip_id[-1] = '1' then (us // 100000 + case when us % 100000 > 50000 then 1 else 0 end) / 10.0e0 - 2 else us / 1e6 - 2 end as base from (select *, case when hinted then '/s/' || row_index || '.mp4' when clip_id[-1] in ('1', '2', '3', '4') then '/v/' || clip_id || '.mp4' end as video, coalesce(hinted, false) as saved
  from (select *, row_index % 10 = 0 as hinted from rows_in))))"""


@query("u4_run_stage", f"""select row_index, case when reject_reason is not null then 'row_' || row_index else clip_id || '_' || coalesce(us::varchar, 'None') || '_' || row_index end as row_key, error is null as ok, error, case when reject_reason is null then clip_id end as clip, start_s, case when error is null then 'x' || length(label) end as answer,
  case when reject_reason is null then video end as video_path, case when reject_reason is null and video is not null then case when saved then 'segment_8s' else 'raw' end end as video_mode, case when error is null then case when saved then video else clip_id || '_' || coalesce(nullif(us, 0), row_index) || '_stage3.mp4' end end as segment,
  case when error is null then 'stop' end as finish_reason, case when error is null then 'm' end as evaluator_model_name, '8s_full' as video_segment, 3 as stage from {_STAGE}""", "rows_in")
def _run_stage(spark, d):
    """Two runs of a whole stage; the first model fails on every third row, the second one doesn't."""
    i = F.col("row_index")
    labels = inputs.labels(spark, d).withColumns({"video_path_hint": F.when(i % 5 == 0, F.concat(F.lit("/s/"), i, F.lit(".mp4"))), "hint_is_saved_segment": i % 5 == 0})
    clips = labels.where("substring(clip_id, -1) in ('1', '2', '3', '4')").select("clip_id").distinct()
    files = clips.select(F.concat(F.lit("/v/"), "clip_id", F.lit(".mp4")).alias("path")).unionByName(labels.where("row_index % 10 = 0").select(F.col("video_path_hint").alias("path")))
    timed = clips.select(F.concat(F.lit("/v/"), "clip_id", F.lit(".mp4")).alias("video_path"), F.substring("clip_id", -1, 1).alias("k")).where("k in ('1', '2')")
    frames = timed.select("video_path", "k", F.explode(F.when(F.col("k") == "1", F.sequence(F.lit(0), F.lit(299))).otherwise(F.array(F.lit(0)))).alias("f")).select("video_path", F.when(F.col("k") == "1", F.col("f")).alias("frame_index"), F.when(F.col("k") == "1", F.col("f") * 100000).cast("bigint").alias("ts_us"))
    path = inputs.shared_path(spark)
    answer = lambda p: {"response": f'\n{{"s_score": 1, "explanation": "x{len(p)}"}}\n', "finish_reason": "stop", "max_tokens_used": 9}
    for model in (lambda batch: ["?" if k % 3 == 0 else answer(p) for k, p in enumerate(batch)], lambda batch: [answer(p) for p in batch]):
        out = stages.run_stage(labels, files, path, 3, F.col("coc_label"), ["s_score", "explanation"], model, model_name="m", root="/v", frame_ts=frames, fps=10.0)
    return out.select("row_index", "row_key", "ok", "error", F.col("clip_id").alias("clip"), F.col("segment_start_sec").alias("start_s"), F.col("evaluation")["explanation"].alias("answer"), F.col("source_video_path").alias("video_path"), "video_mode", F.col("segment_mp4_path").alias("segment"), "finish_reason", "evaluator_model_name", "video_segment", "stage")


@query("w1_compact_stream", """select row_key, line_no, ok, size from (select *, row_number() over (partition by row_key order by ok desc, line_no desc) as r from log) where r = 1 or row_key is null""", "log")
def _stream(spark, d):
    """The log in four parts, of which a key's lines are in several; the state goes on from part to part."""
    base = inputs.shared_path(spark)
    log = inputs.log(spark, d)
    run = lambda: compact_stream(spark, f"{base}/log", log.schema, f"{base}/state", f"{base}/checkpoint")
    for part in range(4):
        log.where(F.col("line_no") % 4 == part).write.mode("append").json(f"{base}/log")
        run()
    return run().select("row_key", "line_no", "ok", "size")  # the last call finds nothing new
