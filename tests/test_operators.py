"""Small cases with known results."""

import random

import pytest
from pyspark.sql import functions as F

from clipspans.functions import text
from clipspans.operators import features, intervals, joins, keyframes, lanes, prompts, results, segments


def series(spark, values, name="v"):
    return spark.createDataFrame([("c", "ego", i, float(v)) for i, v in enumerate(values)], f"clip_id string, agent_id string, tick int, {name} double")


def column(df, name, by="tick"):
    return [r[name] for r in df.orderBy(by).collect()]


def test_rolling_and_mirrored_mean(spark):
    assert column(features.rolling_mean(series(spark, [1, 2, 3, 4, 5]), "v", "m"), "m") == [2, 2.5, 3, 3.5, 4]
    got = spark.range(1).select(features.mirrored_mean(F.array(*[F.lit(float(v)) for v in (1, 2, 3, 4, 5)])).alias("m")).first().m
    assert [round(v, 6) for v in got] == [2.2, 2.4, 3, 3.6, 3.8]


@pytest.mark.parametrize("threshold,values", [(1.25, [1.3, 1.2, 1.0, 1.3, 1.5, 1.1, 1.0]), (-0.1, [-0.2, -0.09, -0.08, -0.11, -0.12])])
def test_hysteresis(spark, threshold, values):
    on, off = sorted((threshold * 1.15, threshold * 0.85), reverse=True)
    want, state = [], values[0] >= threshold
    for i, v in enumerate(values):
        state = state if i == 0 else v >= on or state and v >= off
        want.append(state)
    got = series(spark, values).withColumn("h", features.hysteresis("v", threshold))
    assert column(got, "h") == want
    if threshold == 1.25:
        assert want == [True, True, False, False, True, True, False]


def test_turn_rate_wraps_and_mirrors(spark):
    t = spark.createDataFrame([("c", "ego", i, float(i), 0.0, h) for i, h in enumerate([3.1, -3.1, -3.0])], "clip_id string, agent_id string, tick int, x double, y double, heading double")
    got = features.add_turn_rate(t, 1).orderBy("tick").collect()
    assert round(got[0].turn, 4) == 0.0832 and len(got) == 2
    smooth = features.add_turn_rate(t, 5).orderBy("tick").collect()
    a, b = got[0].turn, got[1].turn
    assert round(smooth[0].turn, 9) == round((3 * a + 2 * b) / 5, 9) and round(smooth[1].turn, 9) == round((3 * b + 2 * a) / 5, 9)


def cuts(states, first_gap=1, closed=True):
    out, start, i, n = [], 0, first_gap, len(states)
    while i < n - 3:
        if states[i] != states[start]:
            out.append((start, i))
            start, i = i, i + 3
        else:
            i += 1
    return [s for s in out + [(start, n - 1 if closed else n)] if s[1] > s[0]]


def test_cuts(spark):
    r = random.Random(0)
    cases = ["AABABBBBBC", "ABAAAAAA", "A", "AB", "ABCD"] + ["".join(r.choice("AAB") for _ in range(r.randint(1, 40))) for _ in range(60)]
    rows = [(f"c{k}", "ego", i, ord(s)) for k, c in enumerate(cases) for i, s in enumerate(c)]
    t = spark.createDataFrame(rows, "clip_id string, agent_id string, tick int, state int")
    for gap, closed in ((1, True), (3, True), (1, False)):
        got = {}
        for x in segments.cut_on_state_change(t, first_gap=gap, closed=closed).orderBy("start").collect():
            got.setdefault(x.clip_id, []).append((x.start, x.end))
        assert got == {f"c{k}": cuts(c, gap, closed) for k, c in enumerate(cases) if cuts(c, gap, closed)}
    assert cuts("AABABBBBBC") == [(0, 2), (2, 9)] and cuts("ABAAAAAA", 3) == [(0, 7)]


def span(caption, start, duration, dv=0.0, speed=1.0):
    return segments.Span(start, duration, caption, (dv,), (speed,), (0.0,))


def test_clean_cases():
    least, default = segments.LONGITUDINAL_LEAST, segments.LONGITUDINAL_DEFAULT
    one = segments.clean([span("MaintainSpeed", 0, 2.0), span("Stop", 2.0, 0.5), span("MaintainSpeed", 2.5, 1.0)], least, default)
    assert [(s.caption, round(s.duration, 6)) for s in one] == [("MaintainSpeed", 3.5)]
    two = segments.clean([span("GentleAcceleration", 0, 2.0, 1.0, 4.0), span("Stop", 2.0, 0.4, 0.2, 0.0), span("StrongDeceleration", 2.4, 2.0, -2.0)], least, default)
    assert [(s.caption, round(s.start, 6), round(s.duration, 6)) for s in two] == [("GentleAcceleration", 0, 2.2), ("StrongDeceleration", 2.2, 2.2)]
    assert round(two[0].sums[0], 6) == 1.1 and round(two[0].means[0], 6) == round(8 / 2.2, 6)
    lone = segments.clean([span("Stop", 0, 0.3)], least, default)
    assert len(lone) == 1 and lone[0].duration == 0.3
    assert segments.clean([], least, default) == []


def test_clean_keeps_time():
    r = random.Random(1)
    for _ in range(300):
        at, spans = 0.0, []
        for _ in range(r.randint(1, 15)):
            d = r.randint(1, 20) / 10
            spans.append(span(r.choice(["Stop", "MaintainSpeed", "Reverse"]), at, d, r.random()))
            at += d
        out = segments.clean(spans, segments.LONGITUDINAL_LEAST, 8)
        assert abs(sum(s.duration for s in out) - at) < 1e-9 and abs(sum(s.sums[0] for s in out) - sum(s.sums[0] for s in spans)) < 1e-9
        assert all(a.caption != b.caption and abs(a.start + a.duration - b.start) < 1e-9 for a, b in zip(out, out[1:]))


def test_tick_spans_and_subtraction(spark):
    s = spark.createDataFrame([("c", "ego", 0.25, 0.5), ("c", "ego", 1.0, 0.01)], "clip_id string, agent_id string, start_time double, duration double")
    assert [(r.start, r.end) for r in intervals.to_tick_spans(s).collect()] == [(2, 8)]
    spans = spark.createDataFrame([("a", "ego", 10, 50), ("b", "ego", 10, 20), ("d", "ego", 0, 5)], "clip_id string, agent_id string, start int, end int")
    stops = spark.createDataFrame([("a", "ego", 0, 12), ("a", "ego", 20, 25), ("a", "ego", 24, 30), ("b", "ego", 5, 25)], "clip_id string, agent_id string, start int, end int")
    got = sorted((r.clip_id, r.start, r.end) for r in intervals.subtract_intervals(spans, stops).collect())
    assert got == [("a", 12, 20), ("a", 30, 50), ("d", 0, 5)]


def test_frames_and_format(spark):
    s = spark.createDataFrame([("c", "Stop", 0, 3, 0), ("c", "MaintainSpeed", 2, 4, 1), ("c", "Stop", 190, 260, 2), ("c", "Stop", 9, 5, 3)], "clip_id string, tag string, start int, end int, line_no int")
    got = {r.frame: r.longitudinal for r in intervals.expand_to_frames(s, s).collect()}
    assert [got[i] for i in range(5)] == ["Stop", "Stop", "MaintainSpeed", "MaintainSpeed", "Not Available"] and got[190] == got[199] == "Stop" and len(got) == 200
    assert intervals.frame_counters(s).first()[1:] == (1, 1)
    lines = spark.createDataFrame([("c", "ego", "MaintainSpeed", 35, 53), ("c", "ego", "GentleAcceleration", 0, 35), ("c", "ego", "GoStraight", 0, 67), ("c", "ego", "MaintainSpeed", 69, 105)], "clip_id string, agent_id string, tag string, start int, end int")
    order = [r.line for r in intervals.format_spans(lines).orderBy("line_no").collect()]
    assert [x.split()[0] for x in order] == ["GentleAcceleration", "GoStraight", "MaintainSpeed", "MaintainSpeed"] and order[0] == "  GentleAcceleration - Agent:<ego>, Start:0, End:35"


def test_window(spark):
    s = spark.createDataFrame([("c", 0, 35)], "clip_id string, start int, end int")
    assert intervals.clip_to_window(s, 10, 20).select("start", "end").first() == (0, 20)


def test_keyframe_bounds(spark):
    rows = [("c", "ego", "Stop", s, s + d) for s, d in ((19, 20), (20, 20), (135, 20), (136, 20), (50, 9), (50, 10))]
    k = keyframes.select_keyframes(spark.createDataFrame(rows, "clip_id string, agent_id string, tag string, start int, end int"))
    assert sorted((r.event_start_frame, r.duration) for r in k.collect()) == [(20, 20), (50, 10), (135, 20)]
    for n, pairs in ((5, {12: 10, 13: 15}), (2, {5: 4, 7: 8})):
        df = spark.createDataFrame([(a, 30) for a in pairs], "event_start_frame int, duration int")
        assert {r.unrounded_start_frame: r.event_start_frame for r in keyframes.align_event_start(df, n).collect()} == pairs


def test_balance_and_dedupe(spark):
    k = spark.createDataFrame([("stop", c, 0, 9, d) for c, d in (("a", 30), ("b", 50), ("c", 50))], "meta_action string, clip_id string, event_start_frame int, event_end_frame int, duration int")
    assert {r.clip_id for r in keyframes.balance(k, 2).collect()} == {"b", "c"}
    with pytest.raises(ValueError):
        keyframes.balance(k, 2, ["my_action"])
    d = spark.createDataFrame([("c1", 10, "stop", None, 0), ("c1", 10, "turn_left", None, 1), ("c2", 1, "stop", None, 2)], "clip_id string, f int, meta_action string, note string, o int")
    got = {r.clip_id: (r.meta_action, r.note) for r in keyframes.dedupe_concat(d, "o", ["meta_action", "note"]).collect()}
    assert got == {"c1": ("stop,turn_left", "null,null"), "c2": ("stop", None)}


@pytest.mark.parametrize("times,want", [((1.0, 4.5, 6.0), 4.5), ((1.0, 3.0), 1.0), ((7.0, 9.0), 7.0), ((), None)])
def test_asof_episode(spark, times, want):
    e = spark.createDataFrame([("c", 5_000_000)], "clip_id string, event_start_us bigint")
    p = spark.createDataFrame([("c", int(t * 1e6)) for t in times], "clip_id string, time_us bigint")
    assert [r.episode_us for r in joins.asof_episode(e, p).collect()] == ([] if want is None else [int(want * 1e6)])


def test_frames_in_time(spark):
    f = spark.createDataFrame([("c", 0, 0), ("c", 1, 33), ("c", 2, 67)], "clip_id string, frame_index int, ts_us bigint")
    e = spark.createDataFrame([("c", t) for t in (50, 51, -1, 68, 33)], "clip_id string, ts_us bigint")
    got = {r.ts_us: (r.frame_index, r.frame_error is not None) for r in joins.nearest_frame(e, f).collect()}
    assert got == {50: (1, False), 51: (2, False), -1: (None, True), 68: (None, True), 33: (1, False)}
    assert {r.ts_us: r.frame_index for r in joins.nearest_frame(e, f, True).collect()}[51] == 1
    sparse = spark.createDataFrame([("c", 0, 10), ("c", 3, 20), ("c", 6, 30)], "clip_id string, frame_index int, ts_us bigint")
    w = spark.createDataFrame([("c", 5), ("c", 7)], "clip_id string, frame_index int")
    assert {r.frame_index: r.ts_us for r in joins.frame_timestamp(w, sparse).collect()} == {5: 30, 7: None}
    k = spark.createDataFrame([("c", 126), ("d", 1)], "clip_id string, event_start_frame int")
    t = spark.createDataFrame([("c", 1_000_000, 100_000.0)], "clip_id string, start_us bigint, dt_us double")
    assert [r.event_start_us for r in joins.event_time(k, t).collect()] == [13_600_000]
    assert {r.clip_id: r.event_start_us for r in joins.event_time(k, t, "zero").collect()}["d"] == 0


def test_compaction(spark, tmp_path):
    schema = "row_key string, line_no bigint, ok boolean, error string, parse_error string, evaluation map<string,string>"
    good = {"a": "1"}
    rows = [("k1", 0, False, "e", None, None), ("k1", 1, True, None, None, good), ("k1", 2, False, "e", None, None), ("k2", 3, True, None, None, good), ("k2", 4, True, None, None, {"a": "2"}), (None, 5, True, None, None, good)]
    log = spark.createDataFrame(rows, schema)
    want = {("k1", 1, 0), ("k2", 4, 3), (None, 5, 5)}
    assert {(r.row_key, r.line_no, r.position) for r in results.compact_results(log).collect()} == want
    assert {r.row_key for r in results.done_keys(log).collect()} == {"k1", "k2"}
    from clipspans.streaming.compact import compact_stream

    for part in (rows[:2], rows[2:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").json(f"{tmp_path}/log")
        compact_stream(spark, f"{tmp_path}/log", schema, f"{tmp_path}/state", f"{tmp_path}/cp")
    again = compact_stream(spark, f"{tmp_path}/log", schema, f"{tmp_path}/state", f"{tmp_path}/cp")  # nothing new
    assert {(r.row_key, r.line_no) for r in again.collect()} == {w[:2] for w in want}
    (tmp_path / "none").mkdir()
    assert compact_stream(spark, f"{tmp_path}/none", schema, f"{tmp_path}/state2", f"{tmp_path}/cp2").count() == 0
    tied = spark.createDataFrame([("k", 1, True, None, None, good), ("k", 1, True, None, None, {"a": "2"})], schema)
    assert results.compact_results(tied).count() == 1


def one(spark, value, function, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(function(F.col("v")).alias("r")).first().r


def test_names_and_tags(spark):
    assert [one(spark, v, text.normalize_action) for v in ("LaneKeep", "SharpSteerLeft", "Foo Bar", None, " Stop ")] == ["keep_lane", "sharp_steer_left", "Foo Bar", "none", "stop"]
    assert one(spark, "Foo Bar", text.canonicalize_action) == "foobar" and one(spark, "LaneKeep", text.action_text) == "Keep Lane" and one(spark, None, text.action_text) == "Not Available"
    tag = one(spark, "StopTemporal(ego at 0-35)", text.parse_tag)
    assert (tag.tag, tag.agents, tag.start, tag.end, tag.type) == ("Stop", ["ego"], 0, 35, "unary")
    assert one(spark, "Follow(ego, car7 at 3-9)", text.parse_tag).type == "binary" and one(spark, "bad", text.parse_tag) is None
    assert text.parse_filter("[a, b]") == text.parse_filter("a b") == ["a", "b"] and text.parse_filter("all") is text.parse_filter(None) is None
    assert text.parse_filter(["A,b", "[c]"]) == ["a", "b", "c"] and text.parse_filter(["a", "None"]) is None
    uuid = "0a1b2c3d-0000-1111-2222-333344445555"
    assert one(spark, f"x/{uuid}.camera_front_wide_120fov.mp4", text.normalize_clip_id) == uuid and one(spark, "a/c7.mp4", text.normalize_clip_id) == "c7"
    assert [one(spark, v, text.valid_timestamp) for v in ("12", "12.9", "-1", "x", None)] == [12, 12, None, None, None]
    assert one(spark, "a/cot_77_b.yaml", text.filename_timestamp) == 77


def test_model_answers(spark):
    assert one(spark, '<think>a</think> {"x":1}', text.strip_thinking) == '{"x":1}'
    got = [one(spark, v, text.parse_model_json) for v in ("", 'text {"a":1} text', "[1]", '```json\n{"a": 2}\n```', None)]
    assert [(g.evaluation, g.parse_error) for g in got] == [(None, "empty_response"), ({"a": "1"}, None), (None, "json_parse_failed"), ({"a": "2"}, None), (None, "empty_response")]
    check = lambda m: one(spark, m, lambda c: text.validate_scores(c, ["s_score", "explanation"]), "map<string,string>")
    assert [check({"s_score": v}) for v in ("0.8", " 1e-1 ", "true", "1.2", "NaN", "0.5f", None)] == [None, None, *["validation_error:invalid_score:s_score"] * 5]
    assert check({"t": "1"}) == "validation_error:missing_score:s_score" and check(None) is None
    kept = lambda m: one(spark, m, lambda c: text.kept_evaluation(c, ["s_score", "explanation"]), "map<string,string>")
    assert kept({"s_score": "1", "explanation": "x", "more": "y"}) == {"s_score": "1.0", "explanation": "x"} and kept({"explanation": "x"}) is None
    strict = [one(spark, v, text.parse_model_json).parse_error for v in ("{'a': 1}", '{"a": 1} and {"b": 2}', "{}", '{"a": {"b": [1]}}')]
    assert strict == ["json_parse_failed", "json_parse_failed", None, None]
    key = spark.createDataFrame([("c", None, 3), (None, 5, 4)], "c string, t bigint, i int").select(text.row_key(F.col("c"), F.col("t"), F.col("i")).alias("k")).collect()
    assert [r.k for r in key] == ["c_None_3", "row_4"]


def test_scoring(spark):
    labels = spark.createDataFrame([(i, "c", None, "x") for i in range(4)], "row_index int, clip_id string, event_timestamp bigint, coc_label string")
    log = spark.createDataFrame([("c_None_1", 0, True, None, None, {"a": "1"})], "row_key string, line_no bigint, ok boolean, error string, parse_error string, evaluation map<string,string>")

    def model(prompts_):
        return ['{"s": 0.5}' for _ in prompts_]

    def broken(prompts_):
        raise RuntimeError("down")

    out = results.stage_run(labels, log, F.col("coc_label"), ["s"], model, parallel=2).collect()
    assert len(out) == 3 and all(r.ok and r.evaluation == {"s": "0.5"} for r in out)
    bad = results.stage_run(labels, log, F.col("coc_label"), ["s"], broken, limit=2).collect()
    assert len(bad) == 2 and all(not r.ok and r.error.startswith("api_error:RuntimeError") for r in bad)


def test_event_windows(spark):
    frames = spark.range(200).select(F.lit("c").alias("clip_id"), F.col("id").cast("int").alias("frame"), F.lit("Stop").alias("longitudinal"), F.lit("x").alias("lateral"), F.lit("Keep Lane").alias("lane"))
    e = spark.createDataFrame([("c", 7)], "clip_id string, event_start_frame int")
    w = prompts.action_window(e, frames)
    got = {p: sorted(r.ts for r in w.where(F.col("phase") == p).collect()) for p in ("history", "future")}
    assert got == {"history": [-7, -2], "future": list(range(0, 60, 5))}
    assert prompts.action_text_block(w).first().action_text.split("\n")[1] == "(t=-0.7s) longitudinal: Stop, lateral: x, lane: Keep Lane"
    with pytest.raises(ValueError):
        prompts.action_window(e, frames, step=0)


def test_prior_and_claims(spark):
    lanes_ = ["Keep Lane", "Left Lane Change", "Left Lane Change", "Slightly Shift Left"]
    w = spark.createDataFrame([("c", 7, t, x) for t, x in zip((-5, 0, 5, 10), lanes_)], "clip_id string, event_start_frame int, ts int, lane string")
    r = prompts.lateral_prior(w).first()
    assert (r.expected_type, r.expected_direction, r.expected_onset, r.has_prior) == ("lane_change", "left", 0, True)
    got = [tuple(one(spark, v, prompts.claim_from_text)) for v in ("Nudge left to pass", "Keep lane and stop", "Turn right")]
    assert got == [("nudge", "left"), ("keep_lane", ""), ("turn", "right")]


def test_stage_window(spark):
    rows = [(12_600_000, False), (700_000_000, False), (None, True)]
    df = spark.createDataFrame(rows, "event_timestamp bigint, hint_is_saved_segment boolean")
    got = [(r.start_s, r.duration_s, r.window_error) for r in prompts.stage_window(df, 2).collect()]
    assert got == [(12.6, 6.0, None), (None, None, "timestamp_requires_sidecar"), (2.0, 6.0, None)]


def test_lane_match_and_pulse(spark):
    lane = spark.createDataFrame([("m", f"L{j}", [(0.0, 3.5 * j), (50.0, 3.5 * j)], [], [f"L{j + 1}"], [f"L{j - 1}"]) for j in range(-1, 2)], "map_id string, lane_id string, center array<struct<x: double, y: double>>, next array<string>, left array<string>, right array<string>")
    poses = spark.createDataFrame([("c", "ego", 0, "m", 5.0, 0.5, 0.0), ("c", "ego", 1, "m", 6.0, 1.75, 0.0), ("c", "ego", 2, "m", 7.0, 20.0, 0.0), ("c", "ego", 3, "m", 8.0, 0.0, 2.0), ("c", "ego", 4, "m", float("nan"), 0.0, 0.0)], "clip_id string, agent_id string, tick int, map_id string, x double, y double, heading double")
    got = {r.tick: (r.lane_id, r.lane_offset, r.current_lanes) for r in lanes.match_lanes(poses, lane).collect()}
    assert got[0] == ("L0", 0.5, ["L0"]) and got[1][0] == "L0" and got[1][2] == ["L0", "L1"] and got[2] == got[3] == got[4] == (None, None, [])
    pulse = lambda v: tuple(round(x, 6) if isinstance(x, float) else x for x in one(spark, v, lanes.offset_pulse, "array<double>"))
    assert pulse([0.0, 0.1, None, 0.2, 0.3, 0.4, 0.1]) == (0.4, 0.3, "left") and pulse([0.0]) == (0.0, 0.0, "none") and pulse([0.5, 0.4, 0.3, 0.2, 0.1]) == (0.0, 0.4, "right")
    assert lanes.drop_short_runs(["keep_lane", "left_lane_change", "keep_lane"] + ["right_lane_change"] * 4) == ["keep_lane"] * 3 + ["right_lane_change"] * 4
