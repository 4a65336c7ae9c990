"""Scoring stages, videos and time files against plain rules."""

import bisect
import fnmatch
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from clipspans.functions import text
from clipspans.operators import joins, prompts, stages


def one(spark, value, function):
    return spark.createDataFrame([(value,)], "v string").select(function(F.col("v")).alias("r")).first().r


def test_white_space_of_any_kind(spark):
    assert one(spark, '<think>a</think>\n\n{"x":1}\n', text.strip_thinking) == '{"x":1}'
    assert one(spark, "\t\r\n\x0b\x1f  nan \n", text.present) is None and one(spark, "\n a b\t", text.present) == "a b"
    assert [one(spark, v, text.parse_model_json).parse_error for v in ("\n", "\x85\t", "<think>x</think>\n\n")] == ["empty_response"] * 3
    assert one(spark, '<think>{"y": 2}</think>\r\n```json\n\n{"x":1}\n\n```\n', text.parse_model_json).evaluation == {"x": "1"}
    assert [one(spark, v, text.whole_number) for v in (" 12.9\n", "-12.9", "1e3", "x", "inf", "12d", "9007199254740993", None)] == [12, -12, 1000, None, None, None, 9007199254740993, None]


def test_rejected_rows_with_a_clip(spark):
    rows = spark.createDataFrame([(0, "c", "5", "x"), (1, "c", "5", "\tnan\n"), (2, "c", "soon", "x"), (3, None, "5", "x"), (4, "c", "-5.5", "x")], "row_index bigint, clip_id string, event_timestamp string, coc_label string")
    got = text.normalize_record(rows)
    got = got.withColumn("k", text.row_key(F.col("clip_id"), F.col("event_timestamp"), F.col("row_index"), F.col("reject_reason"))).orderBy("row_index").collect()
    assert [(r.k, r.reject_reason) for r in got] == [("c_5_0", None), ("row_1", "missing_coc_label"), ("row_2", "invalid_timestamp:soon"), ("row_3", "missing_clip_id"), ("c_-5_4", None)]


def nearest(times, t):
    """times: sorted (ts, frame)."""
    if not times or not times[0][0] <= t <= times[-1][0]:
        return None
    i = bisect.bisect_left([x for x, _ in times], t)
    if i and not times[i][0] - t < t - times[i - 1][0]:
        i = bisect.bisect_left([x for x, _ in times], times[i - 1][0])
    return times[i][1]


def test_nearest_frames_of_many_clips(spark):
    r = random.Random(4)
    frames = {c: sorted({r.randint(0, 300): 0 for _ in range(r.randint(0, 60))}) for c in "abcdef"}
    frames = {c: [(t, i * 3) for i, t in enumerate(ts)] for c, ts in frames.items()}
    events = [(c, r.randint(-20, 320)) for c in "abcdefg" for _ in range(40)]
    f = spark.createDataFrame([(c, i, t) for c, ts in frames.items() for t, i in ts], "clip_id string, frame_index int, ts_us bigint")
    e = spark.createDataFrame(events, "clip_id string, ts_us bigint")
    got = sorted((x.clip_id, x.ts_us, -1 if x.frame_index is None else x.frame_index) for x in joins.nearest_frame(e, f).collect())
    assert got == sorted((c, t, -1 if (n := nearest(frames.get(c, []), t)) is None else n) for c, t in events)
    wanted = spark.createDataFrame([(c, i) for c in "abcg" for i in range(0, 200, 7)], "clip_id string, frame_index int")
    got = {(x.clip_id, x.frame_index): x.ts_us for x in joins.frame_timestamp(wanted, f).collect()}
    assert got == {(c, i): next((t for t, k in frames.get(c, []) if k >= i), None) for c in "abcg" for i in range(0, 200, 7)}


def test_frame_joins_grow_in_proportion(spark):
    """Eight times the frames of a clip; a window over all following rows of each row would take 64 times as long."""

    def took(frames):
        f = spark.range(frames * 4).select((F.col("id") % 4).cast("string").alias("clip_id"), F.expr("cast(id div 4 as int)").alias("frame_index"), F.expr("id div 4 * 100").alias("ts_us"))
        e = f.select("clip_id", (F.col("ts_us") + 40).alias("ts_us"), "frame_index")
        plans = [joins.nearest_frame(e.drop("frame_index"), f), joins.frame_timestamp(e.select("clip_id", "frame_index"), f)]
        for df in plans:
            assert "unboundedfollowing" not in df._jdf.queryExecution().toString().lower().replace("$", "").replace("()", "")
        began = time.time()
        for df in plans:
            df.write.format("noop").mode("overwrite").save()
        return time.time() - began

    took(1000)
    assert took(40_000) < 24 * max(took(5_000), 0.3)


def test_time_file_lookups(spark):
    rows = spark.createDataFrame([(0, "a", 95), (1, "a", 101), (2, "b", 5), (3, "c", 5), (4, "a", None), (5, None, 7)], "i int, video_path string, event_timestamp bigint")
    ts = spark.createDataFrame([("a", i, i * 10) for i in range(11)] + [("c", None, None)], "video_path string, frame_index int, ts_us bigint")
    got = {r.i: (r.seconds, r.sidecar_problem) for r in joins.sidecar_seconds(rows, ts, fps=2.0).collect()}
    assert got == {0: (4.5, None), 1: (None, "timestamp_out_of_range:101:range=0..100"), 2: (None, None), 3: (None, "empty_timestamp_mapping"), 4: (None, None), 5: (None, None)}
    assert {r.i: r.seconds for r in joins.sidecar_seconds(rows, ts.withColumn("fps", F.lit(9.0))).collect()}[0] == 1.0


def plain_video(row, paths, root, camera):
    """The first place that has a file, by looking at each place in order."""
    index, clip, hint, own = row
    m = f"{own or camera}.mp4"
    if hint in paths:
        return hint, "hint"
    exact = [f"camera/{clip}.{m}", f"{clip}.{m}", f"{clip}_fpv.mp4", f"{clip}.mp4", f"{clip[:4]}/{clip}/recordings/recorder-00/{m}", f"{clip}/recordings/recorder-00/{m}"]
    for p in exact:
        if f"{root}/{p}" in paths:
            return f"{root}/{p}", "video_root"

    def below(parts, pattern):
        """Path parts against pattern parts; ** stands for any number of parts."""
        if not pattern:
            return not parts
        if pattern[0] == "**":
            return any(below(parts[i:], pattern[1:]) for i in range(len(parts) + 1))
        return bool(parts) and fnmatch.fnmatchcase(parts[0], pattern[0]) and below(parts[1:], pattern[1:])

    for pattern in (f"{clip[:4]}/{clip}/recordings/recorder-*/{m}", f"*/{clip}/recordings/recorder-*/{m}", f"{clip}/**/{m}", f"{clip[:4]}/{clip}/**/{m}"):
        found = sorted(p for p in paths if p.startswith(root + "/") and below(p[len(root) + 1 :].split("/"), pattern.split("/")))
        if found:
            return found[0], "video_root"
    return None, None


def test_videos_in_every_place(spark):
    r = random.Random(6)
    clips, cams = ["clipA1", "clipB2", "c", "abcd", "x.y"], ["cam", "rear"]
    places = ["camera/{c}.{m}.mp4", "{c}.{m}.mp4", "{c}_fpv.mp4", "{c}.mp4", "{g}/{c}/recordings/recorder-00/{m}.mp4", "{c}/recordings/recorder-00/{m}.mp4", "{g}/{c}/recordings/recorder-07/{m}.mp4", "zz/{c}/recordings/recorder-1/{m}.mp4", "{c}/{m}.mp4", "{c}/a/b/{m}.mp4", "{g}/{c}/{m}.mp4", "{g}/{c}/q/{m}.mp4", "{c}/q/{m}.txt"]
    for _ in range(12):
        paths = {f"/r/{r.choice(places).format(c=c, g=c[:4], m=r.choice(cams))}" for c in clips for _ in range(2)} | {"/h/1.mp4", "/elsewhere/c.mp4"}
        rows = [(i, r.choice(clips), r.choice([None, "/h/1.mp4", "/h/gone.mp4"]), r.choice([None, "", "rear", "nan"])) for i in range(25)]
        df = spark.createDataFrame(rows, "row_index bigint, clip_id string, video_path_hint string, camera_name string")
        got = {x.row_index: (x.video_path, x.video_source) for x in joins.find_videos(df, spark.createDataFrame([(p,) for p in paths], "path string"), "/r/", "cam").collect()}
        assert got == {row[0]: plain_video((*row[:3], row[3] if row[3] == "rear" else None), paths, "/r", "cam") for row in rows}


def labels_of(spark):
    rows = [(0, "c1", "1000000", "good", "/s/0.mp4", True, "cls"), (1, "c1", "2000000", "lost hint", "/s/gone.mp4", True, None), (2, "c2", "5", "no video", None, False, None), (3, "c1", "late", "bad time", None, False, "k"), (4, "c1", "700000000", "late", None, False, None)]
    return spark.createDataFrame(rows, "row_index bigint, clip_id string, event_timestamp string, coc_label string, video_path_hint string, hint_is_saved_segment boolean, label_class_identifier string")


def test_stage_log(spark, tmp_path):
    """Fields of every kind of row; a lost saved segment falls back to the raw video and is cut at the event; runs go on from the log."""
    files = spark.createDataFrame([("/s/0.mp4",), ("/v/c1.mp4",)], "path string")
    ways = dict(root="/v", mode="relative")
    log = f"{tmp_path}/log"
    asked = []
    dry = stages.run_stage(labels_of(spark), files, log, 3, F.col("coc_label"), ["a_score"], lambda b: asked.append(b) or ["{}"] * len(b), dry_run=True, **ways)
    assert {r.row_index: (r.prompt_preview, r.row_error) for r in dry.collect()} == {0: ("good", None), 1: ("lost hint", None), 2: (None, "missing_video"), 3: (None, "invalid_timestamp:late"), 4: (None, "timestamp_requires_sidecar")}
    assert not (tmp_path / "log").exists() and stages.finalize_stage(spark, log).count() == 0
    bad = stages.run_stage(labels_of(spark), files, log, 3, F.col("coc_label"), ["a_score"], lambda b: ["?"] * len(b), **ways)
    assert bad.count() == 5 and bad.where("ok").count() == 0 and {r.parse_error for r in bad.where("model_response_raw = '?'").collect()} == {"json_parse_failed"}
    out = stages.run_stage(labels_of(spark), files, log, 3, F.col("coc_label"), ["a_score"], lambda b: [{"response": '{"a_score": 1}', "finish_reason": "length", "max_tokens_used": 7}] * len(b), model_name="m", backend="local", **ways)
    got = {r.row_index: r.asDict() for r in out.collect()}
    assert out.columns == stages.FIELDS and len(got) == 5
    assert got[0] | {"stage": 3, "row_key": "c1_1000000_0", "video_segment": "8s_full", "source_video_path": "/s/0.mp4", "segment_mp4_path": "/s/0.mp4", "label_class_identifier": "cls", "evaluator_model_name": "m", "evaluator_backend": "local", "ok": True, "finish_reason": "length", "max_tokens_used": 7, "video_mode": "segment_8s", "segment_start_sec": 0.0, "segment_duration_sec": 8.0, "evaluation": {"a_score": "1.0"}} == got[0]
    assert got[1] | {"source_video_path": "/v/c1.mp4", "segment_mp4_path": "c1_2000000_stage3.mp4", "video_mode": "raw", "ok": True} == got[1]
    assert got[3] | {"row_key": "row_3", "clip_id": None, "coc_label": None, "label_class_identifier": None, "error": "invalid_timestamp:late", "source_video_path": None, "video_mode": None} == got[3]
    assert got[4] | {"error": "timestamp_requires_sidecar", "source_video_path": "/v/c1.mp4", "timestamp_mode": "relative", "segment_start_sec": None} == got[4]
    again = stages.run_stage(labels_of(spark), files, log, 3, F.col("coc_label"), ["a_score"], lambda b: ["{}"] * len(b), **ways)
    assert {r.row_index for r in again.where("ok").collect()} == {0, 1}


def test_log_of_another_writer(spark, tmp_path):
    lines = [{"row_key": "k", "ok": True, "evaluation": {"a": 1}, "error": None}, {"row_key": "k", "ok": True, "evaluation": {"a": 2}}, {"row_key": "k", "ok": False, "error": "x"}]
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.jsonl").write_text("".join(json.dumps(x) + "\n" for x in lines))
    assert [r.evaluation for r in stages.finalize_stage(spark, f"{tmp_path}/log").collect()] == [{"a": "2"}]


def test_line_numbers_of_many_tasks(spark):
    df = spark.range(0, 2000, 1, 500).select(stages.line_numbers(3).alias("n"))
    got = [r.n for r in df.collect()]
    assert len(set(got)) == 2000 and min(got) >> 46 == max(got) >> 46 == 3


@pytest.mark.parametrize("video_mode,want", [("auto", [(2.0, "segment_8s"), (5.0, "raw"), (5.0, "raw")]), ("raw", [(5.0, "raw")] * 3), ("segment_8s", [(2.0, "segment_8s")] * 3)])
def test_video_modes(spark, video_mode, want):
    rows = [(0, 5_000_000, True, "hint"), (1, 5_000_000, True, "video_root"), (2, 5_000_000, False, "hint")]
    df = spark.createDataFrame(rows, "i int, event_timestamp bigint, hint_is_saved_segment boolean, video_source string")
    got = prompts.stage_window(df, 2, source="video_source", video_mode=video_mode).orderBy("i").collect()
    assert [(r.start_s, r.video_mode) for r in got] == want
