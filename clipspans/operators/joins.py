"""As-of, nearest and equi joins between events, episodes, video frames, tables of files and archives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipspans.functions.text import CAMERA, normalize_clip_id, present

TOLERANCE_US = 1_000_000


def asof_episode(events: DataFrame, episodes: DataFrame, timing: DataFrame | None = None, tolerance: int = TOLERANCE_US) -> DataFrame:
    """Events moved to an episode's time: the latest one at or before them, or the clip's first if that is over ``tolerance`` away.

    events: (clip_id, event_start_us, ...); episodes: (clip_id, time_us). Clips without episodes drop out. With timing
    (clip_id, start_us, dt_us) the frame is computed anew and ``duration``, where there, shifts by the same frames. Both sides
    are one ordered pass per clip; a tie takes the episode."""
    e = events.withColumns({"_t": F.col("event_start_us"), "_side": F.lit(1)})
    both = e.unionByName(episodes.select("clip_id", F.col("time_us").alias("_t"), F.lit(0).alias("_side"), F.col("time_us").alias("_ep")), allowMissingColumns=True)
    w = Window.partitionBy("clip_id").orderBy("_t", "_side")
    both = both.withColumns({"_last": F.last("_ep", ignorenulls=True).over(w), "_first": F.min("_ep").over(Window.partitionBy("clip_id"))})
    near = F.when(F.col("_last").isNull() | (F.col("_t") - F.col("_last") > tolerance), F.col("_first")).otherwise(F.col("_last"))
    out = both.where("_side = 1 and _first is not null").withColumn("episode_us", near).select(*events.columns, "episode_us")
    if timing is None:
        return out
    out = out.join(timing, "clip_id").withColumn("_frame", frame_of(F.col("episode_us")))
    if "duration" in events.columns:
        out = out.withColumn("duration", F.col("duration") + F.col("event_start_frame") - F.col("_frame"))
    return out.withColumns({"event_start_us": F.col("episode_us"), "event_start_frame": F.col("_frame")}).drop("_frame", "start_us", "dt_us")


def frame_of(us: Column, start: str = "start_us", dt: str = "dt_us") -> Column:
    """Frame of a time, not below 0; dt of 0 or less is an error."""
    step = F.when(F.col(dt) > 0, F.col(dt)).otherwise(F.raise_error(F.lit("dt_us must be above 0")))
    return F.greatest(F.lit(0), ((us - F.col(start)) / step).cast("int"))


def event_time(keyframes: DataFrame, timing: DataFrame, missing: str = "drop") -> DataFrame:
    """Keyframes with event_start_us; clips without timing drop out, or get 0 with missing="zero"."""
    step = F.when(F.col("dt_us") > 0, F.col("dt_us")).when(F.col("dt_us").isNotNull(), F.raise_error(F.lit("dt_us must be above 0")))
    us = (F.col("start_us") + F.col("event_start_frame") * step).cast("bigint")
    out = keyframes.join(timing, "clip_id", "left" if missing == "zero" else "inner")
    return out.withColumn("event_start_us", F.coalesce(us, F.lit(0).cast("bigint"))).drop("start_us", "dt_us")


def nearest_frame(events: DataFrame, frame_ts: DataFrame, at_or_before: bool = False, key: str = "clip_id", parts: int | None = None) -> DataFrame:
    """Events (clip_id, ts_us, ...) with the nearest frame_index; the earlier one on ties, an error text outside the frames.

    The frame before is a fill in order of time, the frame after one in the opposite order: both are running, so a clip's cost
    is that of sorting its rows. ``key`` names the clip's column on both sides. ``parts``: into how many tasks the clips go; frames take
    so few bytes in a shuffle that coalescing by bytes puts too many of them into one task."""
    e = events.withColumns({"_t": F.col("ts_us"), "_side": F.lit(1)})
    f = frame_ts.select(key, F.col("ts_us").alias("_t"), F.lit(0).alias("_side"), F.struct("ts_us", "frame_index").alias("_f"))
    both = _dealt(e.unionByName(f, allowMissingColumns=True), parts, key)
    index = F.col("_f.frame_index")
    onward = Window.partitionBy(key).orderBy("_t", "_side", index.desc_nulls_last())
    back = Window.partitionBy(key).orderBy(F.desc("_t"), F.desc("_side"), index.asc_nulls_first())
    running = lambda w: F.last("_f", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    out = both.withColumn("_before", running(onward)).withColumn("_after", running(back)).where("_side = 1")
    exact = F.col("_before.ts_us") == F.col("_t")
    outside = F.col("_before").isNull() | (F.col("_after").isNull() & ~exact)
    later = F.coalesce((F.col("_after.ts_us") - F.col("_t") < F.col("_t") - F.col("_before.ts_us")), F.lit(False)) & F.lit(not at_or_before)
    return out.withColumns({
        "frame_index": F.when(~outside, F.when(later, F.col("_after.frame_index")).otherwise(F.col("_before.frame_index"))),
        "frame_error": F.when(outside, "timestamp_outside_frames"),
    }).select(*events.columns, "frame_index", "frame_error")


def _dealt(rows: DataFrame, parts: int | None, key: str) -> DataFrame:
    return rows if parts is None else rows.repartition(parts, key)


def frame_timestamp(frames: DataFrame, frame_ts: DataFrame, parts: int | None = None) -> DataFrame:
    """Frames (clip_id, frame_index, ...) with ts_us of the first entry whose index is at least theirs; null beyond the last.
    One fill per clip, from the last entry to the first. ``parts`` as in ``nearest_frame``."""
    e = frames.withColumns({"_i": F.col("frame_index"), "_side": F.lit(0)})
    f = frame_ts.select("clip_id", F.col("frame_index").alias("_i"), F.lit(1).alias("_side"), F.col("ts_us").alias("_ts"))
    back = Window.partitionBy("clip_id").orderBy(F.desc("_i"), F.desc("_side"), F.desc_nulls_last("_ts")).rowsBetween(Window.unboundedPreceding, 0)
    both = _dealt(e.unionByName(f, allowMissingColumns=True), parts, "clip_id").withColumn("ts_us", F.last("_ts", ignorenulls=True).over(back))
    return both.where("_side = 0").select(*frames.columns, "ts_us")


def sidecar_seconds(rows: DataFrame, frame_ts: DataFrame, fps: float = 30.0) -> DataFrame:
    """Rows (video_path, event_timestamp, ...) with seconds, the nearest frame of the video's time file over its frame rate, and
    sidecar_problem, null without a time file or where the lookup worked.

    frame_ts: (video_path, frame_index, ts_us), one row with nulls for a time file without entries; ``fps`` or, where there is one, its
    column fps. The distinct times of a video, without the rows' other columns, and its entries are one linear pass."""
    rate = F.coalesce(F.max("fps"), F.lit(fps)) if "fps" in frame_ts.columns else F.lit(fps)
    bounds = frame_ts.groupBy("video_path").agg(F.min("ts_us").alias("_low"), F.max("ts_us").alias("_high"), F.count("ts_us").alias("_n"), rate.alias("_fps"))
    entries = frame_ts.where("video_path is not null and ts_us is not null").select("video_path", "frame_index", "ts_us")
    times = rows.where("video_path is not null").select("video_path", "event_timestamp", F.col("event_timestamp").alias("ts_us")).distinct()
    found = nearest_frame(times, entries, key="video_path").join(bounds, "video_path", "left")
    range_text = F.format_string("timestamp_out_of_range:%d:range=%d..%d", "event_timestamp", "_low", "_high")
    problem = F.when(F.col("_n") == 0, "empty_timestamp_mapping").when(F.col("event_timestamp").isNotNull() & F.col("frame_error").isNotNull() & F.col("_n").isNotNull(), range_text)
    found = found.select("video_path", "event_timestamp", F.when(F.col("frame_error").isNull(), F.col("frame_index") / F.col("_fps")).alias("seconds"), problem.alias("sidecar_problem"))
    return _looked_up(rows, found, "video_path", "event_timestamp")


def _looked_up(rows: DataFrame, found: DataFrame, key: str, *keys: str) -> DataFrame:
    """Rows with the columns of ``found`` of the same keys, nulls where there are none. A null ``key`` matches nothing, one of the others
    matches null. Rows with a null key are dealt out by all they hold, as they would otherwise be one task's."""
    plain = [c for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    named = {k: f"_of_{k}" for k in (key, *keys)}
    left = rows.withColumn("_deal", F.when(F.col(key).isNull(), F.xxhash64(*plain)).otherwise(F.xxhash64(*named)))
    right = found.withColumnsRenamed(named).withColumn("_of_deal", F.xxhash64(*named.values()))
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(named[k])) for k in keys], (F.col("_deal") == F.col("_of_deal")) & (F.col(key) == F.col(named[key])))
    return left.join(right, same, "left").drop("_deal", "_of_deal", *named.values())


def pending_segments(segments: DataFrame, outputs: DataFrame) -> DataFrame:
    """Segments without a meaningful output; outputs: (clip_id, event_start_us, size, content)."""
    good = outputs.where((F.col("size") > 1) & (F.trim(F.coalesce("content", F.lit(""))) != "") & ~F.trim("content").isin("null", "{}", "[]", "~"))
    return segments.join(good, ["clip_id", "event_start_us"], "left_anti")


def with_cached_ticks(segments: DataFrame, index: DataFrame) -> DataFrame:
    return segments.join(index, ["clip_id", "event_start_frame"], "left_semi")


def allowed_clips(segments: DataFrame, clips: DataFrame | None) -> DataFrame:
    """Only the listed clips; no list means all."""
    return segments if clips is None else segments.join(clips, "clip_id", "left_semi")


# fixed values: endings of a video's time files
SIDECARS = (".timestamps.parquet", ".timestamps", ".mp4.timestamps.parquet", ".mp4.timestamps")


def target_name(member: Column, clip: Column, camera: str = CAMERA) -> Column:
    """File name under which a clip's archive member is kept, ``clip.camera`` with .mp4 or a time file's ending; null for other members."""
    leaf = F.element_at(F.split(member, "/"), -1)
    own = lambda ending: F.concat(clip, F.lit(f".{camera}{ending}"))
    named = leaf.startswith(f"{camera}.")
    out = F.lit(None).cast("string")
    for ending in reversed(SIDECARS):
        out = F.when(leaf.endswith(ending) & (leaf.startswith(clip) | leaf.startswith(camera)), own(ending)).otherwise(out)
    out = F.when(leaf.endswith(".mp4") & (leaf.startswith(clip) | named), own(".mp4")).otherwise(out)
    exact = reduce(lambda x, y: x | y, [leaf == own(e) for e in (".mp4", *SIDECARS)])
    return F.when(leaf == "", F.lit(None)).when(exact, leaf).otherwise(out)


def match_members(members: DataFrame, clips: DataFrame, camera: str = CAMERA) -> DataFrame:
    """Archive members (zip_path, member_name) with their clip, the path part nearest the leaf that names a clip of ``clips``, and
    their target_name, null for members that are neither video nor time file."""
    parts = F.reverse(F.split("member_name", "/"))
    rows = members.select("zip_path", "member_name", F.posexplode(parts).alias("depth", "part")).withColumn("clip_id", normalize_clip_id(F.col("part"), camera))
    hits = rows.join(clips.select("clip_id").distinct(), "clip_id")
    found = hits.groupBy("zip_path", "member_name").agg(F.min_by("clip_id", "depth").alias("clip_id"))
    return found.withColumn("target_name", target_name(F.col("member_name"), F.col("clip_id"), camera))


def plan_extraction(matched: DataFrame, clips: DataFrame, existing: DataFrame, camera: str = CAMERA) -> DataFrame:
    """(clip_id, status, target_name, zip_path, member_name): one row for each file to extract of a pending clip, and one for each
    other clip. status: existing; missing_archive, if no archive has a file of the clip; missing_video, if it has time files only;
    else pending. A target that several members could fill takes the least archive name, then the least member."""
    files = matched.where("target_name is not null")
    zip_name = F.element_at(F.split("zip_path", "/"), -1)
    one = files.groupBy("clip_id", "target_name").agg(F.min(F.struct(zip_name.alias("zip"), "member_name", "zip_path")).alias("m"))
    has = one.groupBy("clip_id").agg(F.bool_or(F.col("target_name") == F.concat("clip_id", F.lit(f".{camera}.mp4"))).alias("_video"))
    out = clips.select("clip_id").distinct().join(existing.select("clip_id", F.lit(True).alias("_have")).distinct(), "clip_id", "left").join(has, "clip_id", "left")
    status = F.when(F.col("_have"), "existing").when(F.col("_video").isNull(), "missing_archive").when(~F.col("_video"), "missing_video").otherwise("pending")
    out = out.select("clip_id", status.alias("status"))
    rows = one.select("clip_id", F.lit("pending").alias("status"), "target_name", "m.zip_path", "m.member_name")
    return out.join(rows, ["clip_id", "status"], "left")


def resolve_video(labels: DataFrame, files: DataFrame) -> DataFrame:
    """Labels (row_index, clip_id, video_path_hint) with their video: the hint if such a file exists, else the clip's file of
    least priority. files: (path, clip_id, priority, source)."""
    best = files.groupBy("clip_id").agg(F.min(F.struct("priority", "path", "source")).alias("_best"))
    return _with_video(labels, files, _looked_up(labels, best, "clip_id"))


def _with_video(labels: DataFrame, files: DataFrame, found: DataFrame) -> DataFrame:
    """found: labels with _best, a struct of path and source."""
    there = files.select(F.col("path").alias("video_path_hint"), F.lit(True).alias("_there")).where("video_path_hint is not null").distinct()
    out = _looked_up(found, there, "video_path_hint")
    hint = F.coalesce(F.col("_there"), F.lit(False))
    path = F.when(hint, F.col("video_path_hint")).otherwise(F.col("_best.path"))
    return out.select(*labels.columns, path.alias("video_path"), F.when(hint, "hint").otherwise(F.col("_best.source")).alias("video_source"))


# fixed values: where a clip's raw video can lie below the root, by priority; {clip}, {grp} (four characters of it) and {camera} are filled in
VIDEO_PLACES = (
    "camera/{clip}.{camera}.mp4",
    "{clip}.{camera}.mp4",
    "{clip}_fpv.mp4",
    "{clip}.mp4",
    "{grp}/{clip}/recordings/recorder-00/{camera}.mp4",
    "{clip}/recordings/recorder-00/{camera}.mp4",
)


def find_videos(labels: DataFrame, files: DataFrame, root: str, camera: str = CAMERA) -> DataFrame:
    """Labels (row_index, clip_id, video_path_hint, maybe camera_name) with video_path and video_source: "hint" if the hint is a file,
    "video_root" for the clip's first place below ``root`` that has one, nulls if none has. files: (path).

    The row's own camera comes before ``camera``. Beyond ``VIDEO_PLACES``, a video in another recorder's folder is next (first in the clip's
    group, then in any), then one at any depth of the clip's folder (first at the root, then in its group); of several, the
    least path. Everything is equi-joins: exact places by path, the others by clip and camera, which a file's path gives."""
    base = root.rstrip("/") + "/"
    rows = labels.where("clip_id is not null").select("row_index", "clip_id", F.coalesce(present(F.col("camera_name")), F.lit(camera)).alias("camera") if "camera_name" in labels.columns else F.lit(camera).alias("camera"))
    below = files.where(F.col("path").startswith(base)).select("path", F.substring("path", len(base) + 1, 1 << 20).alias("rel")).distinct()

    def filled(place: str) -> Column:
        out = F.lit(place)
        for name, value in (("{grp}", F.substring("clip_id", 1, 4)), ("{clip}", F.col("clip_id")), ("{camera}", F.col("camera"))):
            out = F.replace(out, F.lit(name), value)
        return out

    exact = rows.select("row_index", F.posexplode(F.array(*[filled(p) for p in VIDEO_PLACES])).alias("priority", "rel")).join(below, "rel").select("row_index", "priority", "path")
    part = F.split("rel", "/")
    n = F.size(part)
    deep = below.withColumns({"part": part, "n": n, "camera": F.regexp_extract(F.element_at(part, -1), r"^(.+)\.mp4$", 1)}).where("n >= 2 and camera <> ''")
    p = lambda i: F.get("part", F.lit(i))
    in_recorder = (F.col("n") == 5) & (p(2) == "recordings") & p(3).startswith("recorder-")
    grouped = p(0) == F.substring(p(1), 1, 4)
    kinds = [(in_recorder & grouped, p(1)), (in_recorder, p(1)), (F.lit(True), p(0)), (grouped & (F.col("n") >= 3), p(1))]
    at = len(VIDEO_PLACES)
    options = F.filter(F.array(*[F.when(cond, F.struct(clip.alias("clip_id"), F.lit(at + i).alias("priority"))) for i, (cond, clip) in enumerate(kinds)]), lambda x: x.isNotNull())
    places = deep.select("path", "camera", F.explode(options).alias("o")).groupBy("o.clip_id", "camera").agg(F.min(F.struct("o.priority", "path")).alias("f"))
    others = rows.join(places, ["clip_id", "camera"]).select("row_index", "f.priority", "f.path")
    best = exact.unionByName(others).groupBy("row_index").agg(F.min(F.struct("priority", "path", F.lit("video_root").alias("source"))).alias("_best"))
    return _with_video(labels, files, labels.join(best, "row_index", "left"))


def clip_chunk(clips: DataFrame, index: DataFrame) -> DataFrame:
    """Clips with their chunk number, null where the index lacks them."""
    return clips.join(index.select("clip_id", "chunk"), "clip_id", "left")


def assemble(events: DataFrame, *parts: DataFrame, keys: tuple[str, ...] = ("clip_id", "event_start_us")) -> DataFrame:
    """Events with the columns of every part, by the same keys; a missing part leaves nulls."""
    return reduce(lambda out, part: out.join(part, list(keys), "left"), parts, events)
