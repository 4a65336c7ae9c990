"""Registered queries that write and read back the files around the jobs, in the folder that driver and executors share."""

from __future__ import annotations

import io
from functools import reduce

import pandas as pd
from pyspark.sql import functions as F

from clipspans.functions import text
from clipspans.operators import intervals, joins, keyframes
from clipspans.plans import inputs
from clipspans.plans.catalog import query
from clipspans.plans.inputs import shared_path
from clipspans.sources import tables
from clipspans.sources.archives import write_archives


@query("s1_ticks", "select clip_id, agent_id, tick, x, round(tick * 0.1e0, 6) as time_s from ticks", "ticks")
def _ticks(spark, d):
    path = shared_path(spark)
    t = inputs.ticks(spark, d).withColumns({c: F.lit(0.0) for c in ("z", "ax", "ay")})
    t.write.parquet(path)
    return tables.read_ticks(spark, path).select("clip_id", "agent_id", "tick", "x", F.round("time_s", 6).alias("time_s"))


@query("s2_zipped_ticks", "select clip_id, agent_id, tick, x, vx, heading from ticks", "ticks")
def _zipped_ticks(spark, d):
    """A Parquet member for each clip in a few archives; half of the columns are read."""
    path = shared_path(spark)
    t = inputs.ticks(spark, d).withColumns({"agent_id": F.lit("ego"), "z": F.lit(0.0)}).select("clip_id", "agent_id", "tick", "x", "y", "z", "vx", "vy", "heading")

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        file = io.BytesIO()
        rows.sort_values("tick").drop(columns=["clip_id", "agent_id"]).to_parquet(file, index=False)
        return pd.DataFrame({"clip_id": [rows["clip_id"].iloc[0]], "content": [file.getvalue()]})

    write_archives(t.groupBy("clip_id").applyInPandas(pack, "clip_id string, content binary"), path, ".egomotion.parquet")
    return tables.read_zipped_ticks(spark, path, ["clip_id", "agent_id", "tick", "x", "vx", "heading"])


@query("s13_archive_members", "select distinct clip_id || '.txt' as member_name, cast(null as varchar) as problem from spans", "spans")
def _archive_members(spark, d):
    path = shared_path(spark)
    tables.write_packed_label_text(intervals.format_spans(inputs.spans(spark, d)), path)
    return tables.list_archive_members(spark, f"{path}/*.zip").select("member_name", "problem")


@query("s3_packed_tags", "select clip_id, cast(row_number() over (partition by clip_id order by s, tag, e) - 1 as int) as ord, tag, s as start, e as \"end\" from spans", "spans")
def _packed_tags(spark, d):
    path = shared_path(spark)
    s = inputs.numbered(inputs.spans(spark, d))
    tables.write_packed_tags(s.select("clip_id", F.col("line_no").alias("ord"), text.format_tag(F.col("tag"), F.col("agent_id"), F.col("start"), F.col("end")).alias("tag")), path)
    return tables.read_packed_tags(spark, path).select("clip_id", "ord", "parsed.tag", "parsed.start", "parsed.end")


@query("s4_packed_label_text", "select clip_id, cast(row_number() over (partition by clip_id order by fs, tag, s, e) - 1 as int) as line_no, tag, s as start, e as \"end\" from (select *, min(s) over (partition by clip_id, tag) as fs from spans)", "spans")
def _packed_label_text(spark, d):
    path = shared_path(spark)
    tables.write_packed_label_text(intervals.format_spans(inputs.spans(spark, d)), path)
    return tables.read_packed_label_text(spark, path)


@query("s3_raw_tags", "select clip_id, cast(row_number() over (partition by clip_id order by s, tag, e) - 1 as int) as ord, tag, s as start, e as \"end\" from spans", "spans")
def _raw_tags(spark, d):
    path = shared_path(spark)
    s = inputs.numbered(inputs.spans(spark, d))
    tables.write_raw_tags(s.select("clip_id", F.col("line_no").alias("ord"), text.format_tag(F.col("tag"), F.col("agent_id"), F.col("start"), F.col("end")).alias("tag")), path)
    return tables.read_raw_tags(spark, path).select("clip_id", "ord", "parsed.tag", "parsed.start", "parsed.end")


@query("s4_label_text", "select clip_id, cast(row_number() over (partition by clip_id order by fs, tag, s, e) - 1 as int) as line_no, tag, s as start, e as \"end\" from (select *, min(s) over (partition by clip_id, tag) as fs from spans)", "spans")
def _label_text(spark, d):
    path = shared_path(spark)
    tables.write_label_text(intervals.format_spans(inputs.spans(spark, d)), path)
    return tables.read_label_text(spark, path)


@query("s5_keyframes", "select meta_action, clip_id, event_start_frame, event_end_frame, duration from keys where event_start_frame % 4 <> 3", "keys")
def _keyframes(spark, d):
    """Documents of four forms: new names, old names with a file name, without an end, and without a start, which drop out."""
    k = F.col("event_start_frame") % 4
    rows = inputs.keyframe_rows(spark, d)
    record = F.struct(
        F.when(k != 1, F.col("clip_id")).alias("clip_id"), F.when(k == 1, F.concat(F.lit("a/"), "clip_id", F.lit(".txt"))).alias("filename"), F.when(k.isin(0, 2), F.col("event_start_frame")).alias("event_start_frame"), F.when(k == 1, F.col("event_start_frame")).alias("start"),
        F.when(k == 0, F.col("event_end_frame")).alias("event_end_frame"), F.when(k == 1, F.col("event_end_frame")).alias("end"), F.when(k.isin(2, 3), F.col("duration")).alias("duration"),
    )
    lists = rows.groupBy("clip_id", "meta_action").agg(F.collect_list(record).alias("list"))
    docs = lists.groupBy("clip_id").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("meta_action", "list")))).alias("value"))
    return tables.parse_keyframes(docs.select("value")).drop("ord")


_SHAPED = "(select *, event_start_frame % 7 as k, clip_id[-1] in ('1', '4', '7') as listed from keys)"


def _index_docs(spark, d):
    """A document for each clip, of seven kinds of entries: in buckets of one level or three, some of them a bucket's only entry, or in a
    list at the top for some clips; texts that are file names, numbers and nulls are entries too, or none."""
    rows = inputs.keyframe_rows(spark, d).withColumns({"k": F.col("event_start_frame") % 7, "listed": F.substring("clip_id", -1, 1).isin("1", "4", "7")})
    k, name = F.col("k"), lambda c, value: F.concat(F.lit(f'"{c}":'), value)
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    text = lambda c: F.col(c).cast("string")
    join = lambda *parts: F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    start, end, length, action = name("event_start_frame", text("event_start_frame")), name("event_end_frame", text("event_end_frame")), name("duration", text("duration")), name("meta_action", quoted(F.col("meta_action")))
    entry = (
        F.when(k == 0, join(name("clip_id", quoted(F.col("clip_id"))), start, end, action)).when(k == 1, join(name("filename", quoted(F.concat(F.lit("a/"), "clip_id", F.lit(".txt")))), name("start", quoted(text("event_start_frame"))), length, name("action", quoted(F.upper("meta_action")))))
        .when(k == 2, join(name("file_name", quoted(F.concat("clip_id", F.lit("-2.mp4")))), start, end)).when(k == 3, join(name("video_id", quoted(F.concat("clip_id", F.lit("-3")))), F.lit('"clip_id":null'), start, end)).when(k == 4, quoted(F.concat(F.lit("b/"), "clip_id", F.lit("-4.json"))))
        .when(k == 5, join(name("clip_id", quoted(F.col("clip_id"))), name("event_start_frame", F.lit('"x"')), end)).otherwise(F.lit("17"))
    )
    rows = rows.withColumn("entry", entry)
    listed = rows.where("listed").groupBy("clip_id").agg(F.concat(F.lit("["), F.array_join(F.collect_list("entry"), ", "), F.lit("]")).alias("value"))
    lists = rows.where("not listed").groupBy("clip_id", "meta_action").agg(F.collect_list("entry").alias("e"))
    # one entry of an action with clip_id or filename stands alone, others in a list; every third action lies two buckets deeper
    alone = (F.size("e") == 1) & (F.element_at("e", 1).contains('"clip_id"') | F.element_at("e", 1).contains('"filename"'))
    inside = F.when(alone, F.element_at("e", 1)).otherwise(F.concat(F.lit("["), F.array_join("e", ","), F.lit("]")))
    member = F.concat(quoted(F.col("meta_action")), F.lit(":"), inside)
    deep = F.concat(F.lit('"x'), F.crc32("meta_action").cast("string"), F.lit('":{"none":3,"y":{'), member, F.lit("}}"))
    objects = lists.withColumn("part", F.when(F.crc32("meta_action") % 3 == 0, deep).otherwise(member)).groupBy("clip_id").agg(F.concat(F.lit('{"version":"1","empty":{},'), F.array_join(F.collect_list("part"), ","), F.lit("}")).alias("value"))
    return listed.unionByName(objects).select("value")


@query("s5_nested_index", f"select coalesce(case when k = 0 then meta_action when k = 1 then upper(meta_action) when not listed then meta_action end, 'none') as meta_action, clip_id, event_start_frame, event_end_frame, duration from {_SHAPED} where k < 2", "keys")
def _nested(spark, d):
    return tables.parse_keyframes(_index_docs(spark, d)).select(F.coalesce("meta_action", F.lit("none")).alias("meta_action"), "clip_id", "event_start_frame", "event_end_frame", "duration")


@query("a7_index_clips", f"""select distinct wanted, case when k < 2 or k = 5 then clip_id else clip_id || '-' || k end as clip_id from {_SHAPED}, (select unnest([false, true]) as wanted) where k < 6 and (not wanted or lower(meta_action) in ('stop', 'steer_left') and (k < 2 or not listed))""", "keys")
def _index_clips(spark, d):
    docs = _index_docs(spark, d)
    some = lambda names: tables.index_clip_ids(docs, names).withColumn("wanted", F.lit(names is not None))
    return some(None).unionByName(some(["STOP", "steer_left"]))


@query("s6_segment_lists", "select distinct clip_id, cast(start_us + event_start_frame * dt_us as bigint) as event_start_us from keys join timing using (clip_id)", "keys", "timing")
def _segment_lists(spark, d):
    """Three lists with rows in common, whose time columns have different names."""
    base = shared_path(spark)
    e = inputs.stored(joins.event_time(inputs.keyframe_rows(spark, d), inputs.clip_timing(spark, d)))
    paths = []
    for i, name in enumerate(("event_start_timestamp", "ts", "when_us")):
        paths.append(f"{base}/{i}")
        e.where((F.col("event_start_frame") % 3 == i) | (F.col("event_start_frame") % 2 == 0)).select("clip_id", F.col("event_start_us").alias(name)).write.parquet(paths[-1])
    return keyframes.drop_duplicate_segments(tables.read_segment_lists(spark, paths, times=[["none", "event_start_timestamp"], ["ts"], ["when_us", "ts"]]))


@query("s8_label_tables", "select row_index, kind, clip_id, case when row_index % 6 <> 5 then regexp_replace(coc_label, '^\\s+|\\s+$', '', 'g') end as coc_label, nullif(trim(event_timestamp, ' ' || chr(10)), '') as event_timestamp from labels_in, (select unnest(['csv', 'jsonl', 'parquet']) as kind)", "labels_in")
def _label_tables(spark, d):
    base = shared_path(spark)
    labels = inputs.labels(spark, d).withColumnRenamed("coc_label", "label").withColumn("spare", F.lit(None).cast("string"))
    labels.write.option("header", True).option("escape", '"').csv(f"{base}/a.csv")
    labels.write.json(f"{base}/a.jsonl")
    labels.write.parquet(f"{base}/a.parquet")
    names = {"row_index": ["row_index"], "clip_id": ["clip", "clip_id"], "coc_label": ["spare", "label"], "event_timestamp": ["event_timestamp"]}
    out = [tables.label_rows(tables.read_label_table(spark, f"{base}/a.{kind}"), names).withColumn("kind", F.lit(kind)) for kind in ("csv", "jsonl", "parquet")]
    return reduce(lambda a, b: a.unionByName(b), out).withColumn("row_index", F.col("row_index").cast("bigint"))


@query("s9_frame_ts", "select clip_id, frame_index, ts_us from frame_ts", "frame_ts")
def _frame_ts(spark, d):
    path = f"{shared_path(spark)}/f.parquet"
    inputs.frame_ts(spark, d).withColumnsRenamed({"frame_index": "frame_idx", "ts_us": "timestamp_us"}).write.parquet(path)
    return tables.read_frame_ts(spark, path)


@query("s10_result_log", "select row_key, line_no, ok, size from (select *, row_number() over (partition by row_key order by ok desc, line_no desc) as r from log) where r = 1 or row_key is null", "log")
def _result_log(spark, d):
    base, log = shared_path(spark), inputs.log(spark, d)
    tables.write_result_log(log.where("line_no % 2 = 0"), f"{base}/log")
    tables.write_result_log(log.where("line_no % 2 = 1"), f"{base}/log")
    tables.finalize_results(spark.read.schema(log.schema).json(f"{base}/log"), f"{base}/final")
    return spark.read.schema(log.schema).json(f"{base}/final").select("row_key", "line_no", "ok", "size")


@query("s10_result_document", "select row_key, line_no, ok, size from (select *, row_number() over (partition by row_key order by ok desc, line_no desc) as r from log) where r = 1 or row_key is null", "log")
def _result_document(spark, d):
    base, log = shared_path(spark), inputs.log(spark, d)
    tables.finalize_document(log, f"{base}/final", f"{base}/stage")
    return tables.read_json_document(spark, f"{base}/final", log.schema).select("row_key", "line_no", "ok", "size")


@query("s11_clip_list", "select distinct clip_id from keys", "keys")
def _clip_list(spark, d):
    path = shared_path(spark)
    inputs.keyframe_rows(spark, d).select(F.concat(F.lit("  "), "clip_id", F.lit(" ")).alias("value")).write.text(path)
    return tables.read_clip_list(spark, path)


@query("s12_label_layout", "select clip_id, meta_action, event_start_frame, clip_id[:4] as grp from keys", "keys")
def _layout(spark, d):
    path = shared_path(spark)
    tables.write_labels(inputs.keyframe_rows(spark, d), path)
    return spark.read.parquet(path).select("clip_id", "meta_action", "event_start_frame", "grp")


@query("f6_parse_filter", "select meta_action, clip_id, event_start_frame from keys where meta_action in ('stop', 'steer_left', 'reverse')", "keys")
def _parse_filter(spark, d):
    rows = inputs.keyframe_rows(spark, d).select("meta_action", "clip_id", "event_start_frame")
    assert text.parse_filter(["stop", " ALL "]) is None
    return rows.where(F.col("meta_action").isin(text.parse_filter(["[STOP, 'steer_left']", "Reverse"])))


@query("p6_select_actions", """select meta_action, clip_id, event_start_frame from keys where meta_action in ('gentle_acceleration', 'strong_acceleration', 'gentle_deceleration', 'strong_deceleration', 'maintain_speed', 'stop', 'reverse',
  'steer_left', 'steer_right', 'sharp_steer_left', 'sharp_steer_right', 'reverse_left', 'reverse_right', 'go_straight')""", "keys")
def _select_actions(spark, d):
    names = keyframes.select_actions(["stop", "all_ego"])
    return inputs.keyframe_rows(spark, d).where(F.col("meta_action").isin(names)).select("meta_action", "clip_id", "event_start_frame")


@query("t4_work_order", "select clip_id, meta_action, event_start_frame from keys", "keys")
def _work_order(spark, d):
    return keyframes.spread_work(inputs.keyframe_rows(spark, d)).select("clip_id", "meta_action", "event_start_frame")
