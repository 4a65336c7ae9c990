"""Event windows and prompt tables for an external model, and the check of its claims against the action timeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipspans.functions.text import action_text
from clipspans.operators.intervals import FRAMES, frame_label, frame_lists

HISTORY, FUTURE, STEP = 20, 60, 5


def action_window(events: DataFrame, frame_actions: DataFrame, n: int = FRAMES, history: int = HISTORY, future: int = FUTURE, step: int = STEP) -> DataFrame:
    """Sampled actions around events (clip_id, event_start_frame, ...): ts counts frames from the event; phase history or future.

    Both phases step from their own start; a null event takes the whole clip from frame 0."""
    rows = _sampled(events, events.columns, n, history, future, step)
    return rows.join(frame_actions.hint("merge"), ["clip_id", "frame"])


def span_action_window(events: DataFrame, spans: DataFrame, clips: DataFrame, tracks: tuple[str, ...] = ("longitudinal", "lane"), n: int = FRAMES, history: int = HISTORY, future: int = FUTURE, step: int = STEP) -> DataFrame:
    """``action_window`` on the frames of ``expand_to_frames``, from each clip's spans: only sampled frames are made."""
    lists = frame_lists(spans, clips, n, tracks)
    rows = _sampled(events.join(lists.hint("merge"), "clip_id"), [*events.columns, *tracks], n, history, future, step)
    first = ["clip_id", "frame", *[c for c in events.columns if c != "clip_id"], "phase", "ts"]
    return rows.select(*first, *[frame_label(F.col(t), F.col("frame")).alias(t) for t in tracks])


def _sampled(events: DataFrame, columns: list[str], n: int, history: int, future: int, step: int) -> DataFrame:
    """A row for each sampled frame of an event, with frame, phase and ts."""
    if step < 1:
        raise ValueError("step must be above 0")
    ev = F.least(F.greatest(F.col("event_start_frame"), F.lit(0)), F.lit(n))
    lo, hi = F.greatest(ev - history, F.lit(0)), F.least(ev + future, F.lit(n))

    def samples(start: Column, stop: Column, phase: str) -> Column:
        frames = F.when(stop > start, F.sequence(start, stop - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
        return F.transform(frames, lambda f: F.struct(f.alias("frame"), F.lit(phase).alias("phase")))

    whole = samples(F.lit(0), F.lit(n), "whole")
    both = F.when(ev.isNull(), whole).otherwise(F.concat(samples(lo, ev, "history"), samples(ev, hi, "future")))
    return events.withColumn("s", F.explode(both)).select(*columns, "s.frame", "s.phase", (F.col("s.frame") - F.coalesce(ev, F.lit(0))).alias("ts"))


def action_text_block(window: DataFrame, keys: tuple[str, ...] = ("clip_id", "event_start_frame")) -> DataFrame:
    """One text per event: a header and a line per sample in order of time."""
    line = F.format_string("(t=%+.1fs) longitudinal: %s, lateral: %s, lane: %s", F.col("ts") * 0.1, "longitudinal", "lateral", "lane")
    lines = F.transform(F.array_sort(F.collect_list(F.struct("ts", line.alias("line")))), lambda x: x["line"])
    return window.groupBy(*keys).agg(F.array_join(F.concat(F.array(F.lit("Meta actions:")), lines), "\n").alias("action_text"))


# fixed values: the texts around speed samples
SPEED_HEADS = {
    "history_text": "History speed samples:",
    "future_text": "Future speed samples:",
    "speed_text": "Ego speed time series (relative to event time t=0.0s):",
}
SPEED_AXES = {"v_long": "- Longitudinal (m/s): ", "v_lat": "- Lateral (m/s): "}
SPEED_NOTE = "Positive lateral speed means rightward motion, negative means leftward motion."


def speed_text(series: DataFrame, dt: float = 0.1) -> DataFrame:
    """(keys, history and future: arrays of struct<lon, lat>) with history_text, future_text and speed_text (both, and what the signs
    mean): a line for each axis. Sample i has the time -(n-1-i)*dt in the history and (i+1)*dt in the future."""
    n = F.size("history")
    timed = lambda values, time: F.transform(values, lambda v, i: F.struct(time(i).cast("double").alias("t"), v["lon"].cast("double").alias("v_long"), v["lat"].cast("double").alias("v_lat")))
    parts = {"history_text": timed(F.col("history"), lambda i: -(n - 1 - i) * F.lit(dt)), "future_text": timed(F.col("future"), lambda i: (i + 1) * F.lit(dt))}
    parts["speed_text"] = F.concat(*parts.values())

    def text(head: str, samples: Column) -> Column:
        lines = [F.lit(head)]
        for axis, name in SPEED_AXES.items():
            one = F.transform(samples, lambda s: F.format_string(f"(t=%.1fs, {axis}=%.3f m/s)", s["t"], s[axis]))  # noqa: B023
            lines.append(F.concat(F.lit(name + "["), F.array_join(one, ", "), F.lit("]")))
        return F.concat_ws("\n", *lines, *([F.lit(SPEED_NOTE)] if head == SPEED_HEADS["speed_text"] else []))

    return series.withColumns({name: text(SPEED_HEADS[name], samples) for name, samples in parts.items()})


def frame_plan(events: DataFrame, source_fps: int = 30, fps: int = 10, before: int = HISTORY, after: int = FUTURE, every: int = STEP) -> DataFrame:
    """Which source frames to read around event_start_frame (in source frames): interval, offset, sampled_event, frames."""
    if source_fps % fps:
        raise ValueError("source_fps must be a multiple of fps")
    k = source_fps // fps
    e = F.col("event_start_frame")
    at = F.floor(e / k).cast("int")
    frames = F.filter(F.sequence(at - before, at + after, F.lit(every)), lambda f: f >= 0)
    return events.withColumns({"interval": F.lit(k), "offset": (e % k).cast("int"), "sampled_event": at, "frames": F.transform(frames, lambda f: f * k + (e % k).cast("int"))})


def frame_manifest(frames: DataFrame, keys: tuple[str, ...] = ("clip_id", "event_start_us")) -> DataFrame:
    """Per event, its frames (frame_index, ts_us) in order with file names, and the name of its saved segment."""
    name = F.format_string("frame_%06d.jpg", F.col("frame_index"))
    rows = frames.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("frame_index", "ts_us", name.alias("file")))).alias("manifest"))
    return rows.withColumn("segment_file", F.format_string("%s_%d.mp4", "clip_id", "event_start_us"))


def build_prompts(rows: DataFrame, parts: list[tuple[str, str, Column]], name: str = "messages") -> DataFrame:
    """A message list from (role, type, content) parts; neighbouring parts of one role become one message."""
    groups: list[tuple[str, list[Column]]] = []
    for role, kind, content in parts:
        item = F.struct(F.lit(kind).alias("type"), content.cast("string").alias("content"))
        if groups and groups[-1][0] == role:
            groups[-1][1].append(item)
        else:
            groups.append((role, [item]))
    return rows.withColumn(name, F.array(*[F.struct(F.lit(r).alias("role"), F.array(*items).alias("content")) for r, items in groups]))


# fixed values: window offset and duration in seconds by stage; stage 2 can also take the whole 8 s
STAGE_WINDOWS = {1: (0.0, 2.0), 2: (2.0, 6.0), 3: (0.0, 8.0)}
FULL_WINDOW = (0.0, 8.0)
RELATIVE_LIMIT_S = 600.0
TIME_MODES = ("auto", "sidecar", "relative")


def stage_prompts(labels: DataFrame, stage: int, template: str, label: str = "coc_label", metadata: tuple[str, ...] = ("clip_id", "event_timestamp")) -> DataFrame:
    """Template with its two places filled: the label as JSON and the metadata as JSON."""
    own = F.to_json(F.struct(F.col(label).alias("label")))
    return labels.withColumn("prompt", F.format_string(template, own, F.to_json(F.struct(*metadata)))).withColumn("stage", F.lit(stage))


VIDEO_MODES = ("auto", "raw", "segment_8s")


def stage_window(labels: DataFrame, stage: int, saved: str = "hint_is_saved_segment", seconds: str | None = None, problem: str | None = None, source: str | None = None, mode: str = "auto", video_mode: str = "auto", full: bool = False) -> DataFrame:
    """start_s, duration_s, video_mode and window_error of a stage's part of the video.

    A saved segment begins at the stage's offset. With video_mode auto only a row's own hinted video can be one: ``saved`` says
    that the hint is, ``source`` names the column that says whether the video is the hint (none: it always is). Else the event's
    second is ``seconds``, a time file's lookup (modes auto and sidecar), or the event's time in microseconds, if from 0 to
    600 s (relative, and auto without a time file). ``problem`` names the column that says why a lookup in a time file failed.
    Errors: missing_event_timestamp, timestamp_sidecar_error, missing_timestamp_sidecar, timestamp_requires_sidecar, unsupported_timestamp_mode."""
    if video_mode not in VIDEO_MODES:
        raise ValueError(f"video_mode is one of {VIDEO_MODES}")
    offset, duration = FULL_WINDOW if full and stage == 2 else STAGE_WINDOWS[stage]
    stamp, none = F.col("event_timestamp"), F.lit(None).cast("double")
    relative = F.when((stamp >= 0) & (stamp <= RELATIVE_LIMIT_S * 1e6), stamp / 1e6)
    looked_up = none if seconds is None else F.col(seconds).cast("double")
    failed = F.lit(None).cast("string") if problem is None or mode == "relative" else F.concat(F.lit("timestamp_sidecar_error:"), F.col(problem))
    second = {"auto": F.coalesce(looked_up, relative), "sidecar": looked_up, "relative": relative}.get(mode, none)
    lacking = {"sidecar": "missing_timestamp_sidecar"}.get(mode, "timestamp_requires_sidecar") if mode in TIME_MODES else f"unsupported_timestamp_mode:{mode}"
    own = F.coalesce(F.col(saved), F.lit(False)) & (F.lit(True) if source is None else F.coalesce(F.col(source) == "hint", F.lit(False)))
    is_saved = own if video_mode == "auto" else F.lit(video_mode == "segment_8s")
    error = F.when(is_saved, F.lit(None).cast("string")).when(stamp.isNull(), "missing_event_timestamp")
    error = (error.when(failed.isNotNull(), failed) if mode in TIME_MODES else error).when(second.isNull(), lacking)
    start = F.when(is_saved, F.lit(offset)).otherwise(F.greatest(F.lit(0.0), second - 2.0 + offset))
    return labels.withColumns({"start_s": F.when(error.isNull(), start), "duration_s": F.when(error.isNull(), F.lit(duration)), "video_mode": F.when(is_saved, "segment_8s").otherwise("raw"), "window_error": error})


def lane_token(text: Column) -> Column:
    token = F.replace(F.regexp_replace(F.lower(F.trim(text)), "[^a-z_ ]", ""), F.lit(" "), F.lit("_"))
    return F.when(token.isin("left_lane_change", "right_lane_change", "slightly_shift_left", "slightly_shift_right"), token)


def lateral_prior(window: DataFrame, keys: tuple[str, ...] = ("clip_id", "event_start_frame")) -> DataFrame:
    """Per event, what the timeline leads one to expect: expected_type, expected_direction, expected_onset, has_prior, summary.

    window: one row per sample with ts and lane. A lane change begins at the first of two samples in a row with one lane-change
    token, at most two steps apart; a nudge at the first shift token. Of both, the one within four steps of the event wins, else
    the earlier one, the lane change on ties."""
    w = Window.partitionBy(*keys).orderBy("ts")
    rows = window.withColumn("token", lane_token(F.col("lane")))
    rows = rows.withColumns({"next_token": F.lead("token").over(w), "gap": F.lead("ts").over(w) - F.col("ts")})
    rows = rows.withColumn("step", F.coalesce(F.min(F.when(F.col("gap") > 0, F.col("gap"))).over(Window.partitionBy(*keys)), F.lit(1)))
    pair = (F.col("token") == F.col("next_token")) & (F.col("gap") > 0) & (F.col("gap") <= 2 * F.col("step"))
    onset = lambda name, cond: F.min(F.when(cond, F.col("ts"))).alias(name)
    out = rows.groupBy(*keys).agg(
        F.first("step").alias("step"), onset("cl", pair & (F.col("token") == "left_lane_change")), onset("cr", pair & (F.col("token") == "right_lane_change")),
        onset("nl", F.col("token") == "slightly_shift_left"), onset("nr", F.col("token") == "slightly_shift_right"),
        F.count_if(F.col("token").endswith("lane_change")).alias("changes"), F.count_if(F.col("token").startswith("slightly_shift")).alias("nudges"),
    )
    side = lambda a, b: F.when(F.col(a).isNull() & F.col(b).isNull(), F.lit("")).when(F.col(b).isNull() | (F.col(a) <= F.col(b)), "left").otherwise("right")
    change, nudge = F.least("cl", "cr"), F.least("nl", "nr")
    near = lambda c: F.abs(c) <= 4 * F.col("step")
    kind = (
        F.when(change.isNull() & nudge.isNull(), "").when(nudge.isNull(), "lane_change").when(change.isNull(), "nudge")
        .when(near(change) != near(nudge), F.when(near(change), "lane_change").otherwise("nudge")).when(change <= nudge, "lane_change").otherwise("nudge")
    )
    out = out.withColumn("expected_type", kind)
    pick = lambda a, b: F.when(F.col("expected_type") == "lane_change", a).when(F.col("expected_type") == "nudge", b)
    out = out.withColumns({"expected_direction": F.coalesce(pick(side("cl", "cr"), side("nl", "nr")), F.lit("")), "expected_onset": pick(change, nudge)})
    show = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    named = lambda c: F.when(F.col(c) == "", "none").otherwise(F.col(c))
    summary = F.format_string(
        "lane changes: %d, left from %s, right from %s; nudges: %d, left from %s, right from %s; near: within %d; expected: %s, direction %s, onset %s",
        "changes", show("cl"), show("cr"), "nudges", show("nl"), show("nr"), 4 * F.col("step"), named("expected_type"), named("expected_direction"), show("expected_onset"),
    )
    return out.select(*keys, "expected_type", "expected_direction", "expected_onset", (F.col("expected_type") != "").alias("has_prior"), summary.alias("summary"))


def claim_from_text(text: Column) -> Column:
    """struct(type, direction) that a label's text claims."""
    t = F.lower(F.coalesce(text, F.lit("")))
    left, right = F.contains(F.concat(F.lit(" "), t), F.lit(" left")) | F.contains(t, F.lit("left ")), F.contains(F.concat(F.lit(" "), t), F.lit(" right")) | F.contains(t, F.lit("right "))
    direction = F.when(left & ~right, "left").when(right & ~left, "right").otherwise("")
    has = lambda *words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(t, w))
    kind = F.when(has("lane change", "change lane"), "lane_change").when(has("nudge", "leftward", "rightward"), "nudge").when(has("keep lane"), "keep_lane").when(has("turn"), "turn").otherwise("unknown")
    return F.struct(kind.alias("type"), direction.alias("direction"))


def needs_repair(claim: Column) -> Column:
    """Why a claim contradicts the prior in expected_type, expected_direction and has_prior; null if it doesn't."""
    kind, side = claim["type"], claim["direction"]
    return (
        F.when(~F.col("has_prior"), F.lit(None).cast("string")).when(kind == "keep_lane", "keep_lane_despite_prior").when(kind != F.col("expected_type"), F.concat(F.lit("type:"), kind, F.lit("->"), F.col("expected_type")))
        .when((F.col("expected_direction") != "") & (side != F.col("expected_direction")), F.concat(F.lit("direction:"), F.when(side == "", "none").otherwise(side), F.lit("->"), F.col("expected_direction")))
    )


def merge_repair(first: DataFrame, second: DataFrame, keys: tuple[str, ...] = ("clip_id", "event_start_us"), content: str = "content", reason: Column | None = None, prior: Column | None = None, versions: tuple[str, str] = ("base", "repair")) -> DataFrame:
    """First-pass answers with the repaired content where there is one; the first text is kept beside it. audit tells why: both
    prompts' versions, whether and why the repair was asked for (``reason``, columns of ``first``), and the ``prior`` it went by."""
    none = F.lit(None).cast("string")
    asked = none if reason is None else reason
    fixed = second.select(*keys, F.col(content).alias("_fixed")).join(first.select(*keys).distinct(), list(keys), "left_semi")
    out = first.withColumns({"_reason": asked, "_prior": none if prior is None else prior}).join(fixed, list(keys), "left")
    done = F.col("_fixed").isNotNull()
    audit = F.struct(
        F.lit(versions[0]).alias("base_version"), F.lit(versions[1]).alias("repair_version"), (F.col("_reason").isNotNull() | done).alias("triggered"),
        F.col("_reason").alias("reason"), F.col("_prior").alias("prior"), F.when(done, "+".join(versions)).otherwise(versions[0]).alias("pipeline_version"),
    )
    return out.withColumns({f"{content}_original": F.col(content), "repaired": done, "audit": audit, content: F.coalesce("_fixed", F.col(content))}).drop("_fixed", "_reason", "_prior")


def display(frame_actions: DataFrame, tracks: tuple[str, ...] = ("longitudinal", "lateral", "lane")) -> DataFrame:
    """Tracks with display texts."""
    return frame_actions.withColumns({t: action_text(F.col(t)) for t in tracks if t in frame_actions.columns})
