"""Interval algebra over spans (clip_id, agent_id, family, tag, start, end), half-open in ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipspans.functions.text import normalize_action
from clipspans.operators.features import DT

FRAMES = 200
LONGITUDINAL_TAGS = ("Stop", "Reverse", "StrongAcceleration", "GentleAcceleration", "StrongDeceleration", "GentleDeceleration", "MaintainSpeed")
LANE_TAGS = ("LeftLaneChange", "RightLaneChange", "TurnLeft", "TurnRight", "SlightlyShiftLeft", "SlightlyShiftRight", "LaneKeep")


def to_tick_spans(segments: DataFrame) -> DataFrame:
    """Seconds to ticks, rounded half to even; empty spans go."""
    tick = lambda s: F.bround(s / DT, 0).cast("int")
    out = segments.withColumns({"start": tick(F.round("start_time", 9)), "end": tick(F.round(F.col("start_time") + F.col("duration"), 9))})
    return out.where("end > start").drop("start_time", "duration")


def subtract_intervals(spans: DataFrame, stops: DataFrame) -> DataFrame:
    """Spans without the union of the stops of their clip and agent; a span may fall into several.

    stops: (clip_id, agent_id, start, end). A clip's stops are one sorted array, so each span is cut where it stands."""
    lists = stops.where("end > start").groupBy("clip_id", "agent_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("stops"))
    piece = "array<struct<start: int, end: int>>"
    none = F.array().cast(piece)
    here = F.filter(F.coalesce("stops", none), lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    begin = F.struct(F.col("start").alias("at"), none.alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.when(s["start"] > acc["at"], F.concat(acc["out"], F.array(F.struct(acc["at"].alias("start"), s["start"].alias("end"))))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), gap.alias("out"))

    def finish(acc: Column) -> Column:
        return F.when(acc["at"] < F.col("end"), F.concat(acc["out"], F.array(F.struct(acc["at"].alias("start"), F.col("end").alias("end"))))).otherwise(acc["out"])

    cut = spans.join(lists, ["clip_id", "agent_id"], "left").withColumn("pieces", F.aggregate(here, begin, step, finish))
    return cut.withColumn("p", F.explode("pieces")).withColumns({"start": F.col("p.start"), "end": F.col("p.end")}).select(*spans.columns)


def remove_stops(spans: DataFrame) -> DataFrame:
    """Stops are taken out of the lateral and lane spans; longitudinal spans stay."""
    stops = spans.where("family = 'longitudinal' and tag = 'Stop'").select("clip_id", "agent_id", "start", "end")
    return spans.where("family = 'longitudinal'").unionByName(subtract_intervals(spans.where("family <> 'longitudinal'"), stops))


def clip_to_window(spans: DataFrame, start: int, length: int) -> DataFrame:
    """What of each span is in [start, start + length], counted from the window's start."""
    inside = (F.col("start") <= start + length) & (F.col("end") >= start)
    return spans.where(inside).withColumns({"start": F.greatest(F.col("start") - start, F.lit(0)), "end": F.least(F.col("end") - start, F.lit(length))})


def infer_clip_len(spans: DataFrame) -> DataFrame:
    return spans.groupBy("clip_id").agg(F.greatest(F.coalesce(F.max("end") + 1, F.lit(FRAMES)), F.lit(1)).alias("length"))


def format_spans(spans: DataFrame, name_length: int = 5) -> DataFrame:
    """Label lines in order: tags by their first start (then name), within a tag by start. (clip_id, line_no, line)."""
    first = F.min(F.struct("start", "tag")).over(Window.partitionBy("clip_id", "tag"))
    line = F.format_string("  %s - Agent:<%s>, Start:%d, End:%d", F.col("tag"), F.substring("agent_id", 1, name_length), F.col("start"), F.col("end"))
    order = Window.partitionBy("clip_id").orderBy("first", "start", "end", "agent_id")
    return spans.withColumn("first", first).select("clip_id", (F.row_number().over(order) - 1).alias("line_no"), line.alias("line"))


def _track(tag: Column) -> Column:
    return F.when(tag.isin(*LONGITUDINAL_TAGS), "longitudinal").when(tag.isin(*LANE_TAGS), "lane").otherwise("lateral")


def expand_to_frames(spans: DataFrame, clips: DataFrame, frames: int = FRAMES, tracks: tuple[str, ...] = ("longitudinal", "lane")) -> DataFrame:
    """One row per clip and frame with a column per track; the later line wins, frames without a span say Not Available.

    spans: (clip_id, tag, start, end, line_no); reversed spans are skipped and the rest is cut to [0, frames)."""
    lists = frame_lists(spans, clips, frames, tracks)
    return lists.withColumn("frame", F.explode(F.sequence(F.lit(0), F.lit(frames - 1)))).select("clip_id", "frame", *[frame_label(F.col(t), F.col("frame")).alias(t) for t in tracks])


def frame_lists(spans: DataFrame, clips: DataFrame, frames: int = FRAMES, tracks: tuple[str, ...] = ("longitudinal", "lane")) -> DataFrame:
    """One row per clip with a column per track: its spans in order of their lines, for ``frame_label``. One exchange of spans; frames are
    neither shuffled nor joined, as a clip's spans tell the label of each. Arguments as in ``expand_to_frames``."""
    own = _cut(spans, frames).where("clip_id is not null and line_no is not null").withColumn("track", _track(F.col("tag"))).where(F.col("track").isin(*tracks))
    row = F.struct("line_no", "start", "end", "tag")
    both = own.select("clip_id", F.lit(False).alias("listed"), "track", row.alias("s")).unionByName(clips.select("clip_id").distinct().withColumn("listed", F.lit(True)), allowMissingColumns=True)
    lists = both.groupBy("clip_id").agg(F.bool_or("listed").alias("listed"), *[F.array_sort(F.collect_list(F.when(F.col("track") == t, F.col("s")))).alias(t) for t in tracks])
    return lists.where("listed").drop("listed")


def frame_label(spans: Column, frame: Column) -> Column:
    """The label of a frame by a list of ``frame_lists``."""
    return F.coalesce(_label(spans, frame), F.lit("Not Available"))


def _cells(points: Column) -> Column:
    """Neighbouring points as array of struct(a, b)."""
    p = F.array_sort(F.array_distinct(points))
    return F.transform(F.slice(p, F.lit(1), F.greatest(F.size(p) - 1, F.lit(0))), lambda a, i: F.struct(a.alias("a"), F.get(p, i + 1).alias("b")))


def _ends(spans: Column) -> Column:
    return F.flatten(F.transform(spans, lambda x: F.array(x["start"], x["end"])))


def _label(spans: Column, at: Column) -> Column:
    """The tag of the last of ``spans`` (in order of line_no) that holds a frame."""
    return F.try_element_at(F.filter(spans, lambda x: (x["start"] <= at) & (x["end"] > at)), F.lit(-1))["tag"]


def _sorted(where: Column | None = None) -> Column:
    row = F.struct("line_no", "start", "end", "tag")
    return F.array_sort(F.collect_list(row if where is None else F.when(where, row)))


def timeline(spans: DataFrame, frames: int | None = FRAMES) -> DataFrame:
    """(clip_id, track, start, end, tag): pieces without overlap, in which the later line wins, of (clip_id, track, tag, start, end, line_no).

    Between two neighbouring starts or ends the label is one, so a clip costs what its spans do, whatever the number of frames.
    Reversed spans are skipped, and the rest is cut to [0, frames)."""
    rows = _cut(spans, frames).groupBy("clip_id", "track").agg(_sorted().alias("s"))
    cells = F.transform(_cells(_ends(F.col("s"))), lambda c: F.struct(c["a"].alias("start"), c["b"].alias("end"), _label(F.col("s"), c["a"]).alias("tag")))
    return rows.select("clip_id", "track", F.explode(cells).alias("c")).select("clip_id", "track", "c.*").where("tag is not null")


def _cut(spans: DataFrame, frames: int | None) -> DataFrame:
    own = spans.where("end > start")
    return own if frames is None else own.withColumns({"start": F.greatest("start", F.lit(0)), "end": F.least("end", F.lit(frames))}).where("end > start")


def span_agreement(predicted: DataFrame, truth: DataFrame, frames: int | None = FRAMES) -> DataFrame:
    """(track, frames, equal): frames that both sides label, and those with equal labels, from spans as in ``timeline``. One grouping by clip
    and track; no span is spread over its frames."""
    names = ["clip_id", "track", "tag", "start", "end", "line_no"]
    both = _cut(predicted, frames).select(*names, F.lit(0).alias("side")).unionByName(_cut(truth, frames).select(*names, F.lit(1).alias("side")))
    rows = both.groupBy("clip_id", "track").agg(_sorted(F.col("side") == 0).alias("p"), _sorted(F.col("side") == 1).alias("t")).where("size(p) > 0 and size(t) > 0")
    cells = F.transform(_cells(F.concat(_ends(F.col("p")), _ends(F.col("t")))), lambda c: F.struct((c["b"] - c["a"]).alias("n"), _label(F.col("p"), c["a"]).alias("p"), _label(F.col("t"), c["a"]).alias("t")))
    found = rows.select("track", F.explode(cells).alias("c")).select("track", "c.*").where("p is not null and t is not null")
    return found.groupBy("track").agg(F.sum("n").cast("bigint").alias("frames"), F.coalesce(F.sum(F.when(F.col("p") == F.col("t"), F.col("n"))), F.lit(0)).cast("bigint").alias("equal"))


def frame_counters(spans: DataFrame, frames: int = FRAMES) -> DataFrame:
    """Per clip: spans that are reversed or empty, and spans that reach outside the frames."""
    bad = F.col("end") <= F.col("start")
    return spans.groupBy("clip_id").agg(F.count_if(bad).alias("malformed"), F.count_if(~bad & ((F.col("start") < 0) | (F.col("end") > frames))).alias("out_of_range"))


def change_points(frames: DataFrame, track: str) -> DataFrame:
    before = F.lag(track).over(Window.partitionBy("clip_id").orderBy("frame"))
    return frames.withColumn("_b", before).where(F.col("_b").isNotNull() & (F.col("_b") != F.col(track))).drop("_b")


def span_change_points(spans: DataFrame, clips: DataFrame, track: str, frames: int = FRAMES) -> DataFrame:
    """``change_points`` of the frames of ``expand_to_frames``, (clip_id, frame, track), from each clip's spans: a label changes only where one
    of them starts or ends, so no frames are sorted."""
    lists = frame_lists(spans, clips, frames, (track,))
    ends = F.array_distinct(_ends(F.col(track)))
    at = lists.withColumn("frame", F.explode(ends)).where((F.col("frame") > 0) & (F.col("frame") < frames))
    labels = at.select("clip_id", "frame", frame_label(F.col(track), F.col("frame")).alias(track), frame_label(F.col(track), F.col("frame") - 1).alias("_b"))
    return labels.where(F.col("_b") != F.col(track)).drop("_b")


def expand_gt(gt: DataFrame, fps: int = 30, frames: int = 600) -> DataFrame:
    """Ground-truth spans in milliseconds as video frames, later rows first served: (clip_id, frame, longitudinal, lateral, lane).

    gt: (clip_id, row_no, segment_start_ms, segment_end_ms, gt_longitudinal, gt_lateral, gt_lane)."""
    at = lambda c: F.greatest(F.lit(0), F.least(F.lit(frames), F.bround(F.col(c) * fps / 1000.0, 0).cast("int")))
    rows = gt.withColumns({"s": at("segment_start_ms"), "e": at("segment_end_ms")}).where("e > s")
    hits = rows.withColumn("frame", F.explode(F.sequence("s", F.col("e") - 1)))
    return hits.groupBy("clip_id", "frame").agg(*[F.max_by(f"gt_{t}", "row_no").alias(t) for t in ("longitudinal", "lateral", "lane")])


def overlap_video_clip(video: DataFrame, clip: DataFrame, fps: int = 30) -> DataFrame:
    """Frames that a video and a clip share: (clip_id, video_start, clip_start, n_frames). Both: (clip_id, start_us, end_us)."""
    both = video.join(clip.select("clip_id", F.col("start_us").alias("c_start"), F.col("end_us").alias("c_end")), "clip_id")
    lo, hi = F.greatest("start_us", "c_start"), F.least("end_us", "c_end")
    frame = lambda us: F.bround(us * fps / 1e6, 0).cast("int")
    return both.where(hi > lo).select("clip_id", frame(lo - F.col("start_us")).alias("video_start"), frame(lo - F.col("c_start")).alias("clip_start"), frame(hi - lo).alias("n_frames"))


def frames_at_30fps(spans: DataFrame, fps: int = 30) -> DataFrame:
    """Spans in ticks as spans of video frames with their track."""
    frame = lambda c: F.floor(F.round(F.col(c) * DT * fps, 6)).cast("int")
    return spans.withColumns({"start": frame("start"), "end": frame("end"), "track": _track(F.col("tag")), "action": normalize_action(F.col("tag"))})
