"""Keyframes: selection, alignment, statistics, balancing and de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipspans.functions.text import ACTION_TEXTS, canonicalize_action

KNOWN = tuple(ACTION_TEXTS)
LANE_ACTIONS = ("keep_lane", "left_lane_change", "right_lane_change", "turn_left", "turn_right", "slightly_shift_left", "slightly_shift_right")
EGO_ACTIONS = tuple(a for a in KNOWN if a not in LANE_ACTIONS and a != "none" and not a.startswith("follow_curve"))


def select_actions(names: list[str], use_lane: bool = False) -> list[str]:
    """``all_ego`` stands for the 14 ego actions, and the 7 lane actions where wanted."""
    out = []
    for n in names:
        out += [*EGO_ACTIONS, *(LANE_ACTIONS if use_lane else ())] if n == "all_ego" else [n]
    return list(dict.fromkeys(out))


def ego_only(df: DataFrame, only: bool = True) -> DataFrame:
    return df.where("agent_id = 'ego'") if only else df


def select_keyframes(spans: DataFrame, actions: list[str] | None = None, min_duration: int = 10, min_start: int = 20, max_start: int = 135) -> DataFrame:
    """Spans as keyframes (meta_action, clip_id, event_start_frame, event_end_frame, duration)."""
    out = spans.select(canonicalize_action(F.col("tag")).alias("meta_action"), "clip_id", F.col("start").alias("event_start_frame"), F.col("end").alias("event_end_frame"), (F.col("end") - F.col("start")).alias("duration"))
    out = out.where((F.col("duration") >= min_duration) & F.col("event_start_frame").between(min_start, max_start))
    return out if actions is None else out.where(F.col("meta_action").isin(actions))


def clip_frame(clip: Column, frame: Column) -> Column:
    return F.format_string("%s_%02d", clip, frame)


def filter_segments(keyframes: DataFrame, actions: list[str] | None = None, exclude: DataFrame | None = None, include: DataFrame | None = None) -> DataFrame:
    """By action (none: every known one and Unknown), without excluded clip_id rows, only included clip_frame rows."""
    out = keyframes.where(F.col("meta_action").isin(*(actions or [*KNOWN, "Unknown"])))
    if exclude is not None:
        out = out.join(exclude, "clip_id", "left_anti")
    if include is not None:
        out = out.withColumn("clip_frame", clip_frame(F.col("clip_id"), F.col("event_start_frame"))).join(include, "clip_frame", "left_semi").drop("clip_frame")
    return out


def align_event_start(keyframes: DataFrame, n: int) -> DataFrame:
    """Starts rounded to the nearest multiple of n (half to even); the old start is kept, the duration shifts along."""
    new = (n * F.bround(F.col("event_start_frame") / n, 0)).cast("int")
    return keyframes.withColumns({"unrounded_start_frame": F.col("event_start_frame"), "duration": F.col("duration") + F.col("event_start_frame") - new, "event_start_frame": new})


def group_filter(df: DataFrame, prefix: str) -> DataFrame:
    return df.where(F.col("clip_id").startswith(prefix))


def finite_poses(poses: DataFrame) -> DataFrame:
    bad = lambda c: F.col(c).isNull() | F.isnan(c) | F.col(c).isin(float("inf"), float("-inf"))
    return poses.where(~(bad("x") | bad("y") | bad("heading")))


def duration_stats(keyframes: DataFrame, actions: list[str]) -> DataFrame:
    """Per action: n, mean, population deviation, least and greatest duration; listed actions without rows have n 0."""
    stats = keyframes.groupBy("meta_action").agg(F.count(F.lit(1)).alias("n"), F.avg("duration").alias("mean"), F.stddev_pop("duration").alias("std"), F.min("duration").alias("least"), F.max("duration").alias("most"))
    listed = keyframes.sparkSession.createDataFrame([(a,) for a in actions], "meta_action string")
    return listed.join(stats, "meta_action", "left").fillna(0, ["n"])


def counts(keyframes: DataFrame) -> DataFrame:
    return keyframes.groupBy("meta_action").agg(F.count(F.lit(1)).alias("segments"), F.countDistinct("clip_id").alias("clips"))


def dedupe_concat(df: DataFrame, order: str, concat: list[str], ignore: tuple[str, ...] = (), sep: str = ",") -> DataFrame:
    """Rows that are equal but for the concat, ignored and order columns become one: the first, with the concat columns joined
    in order where there are several rows ("null" for a missing value)."""
    keys = [c for c in df.columns if c not in (*concat, *ignore, order)]
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(F.col(c).cast("string"), F.lit("null")).alias("v")))), lambda x: x["v"]), sep)
    aggs = [F.when(F.count(F.lit(1)) > 1, joined(c)).otherwise(F.first(F.col(c).cast("string"))).alias(c) for c in concat]
    aggs += [F.min_by(c, order).alias(c) for c in ignore] + [F.min(order).alias(order)]
    return df.groupBy(*keys).agg(*aggs).select(*df.columns)


def load_clip_ids(keyframes: DataFrame, actions: list[str] | None = None) -> DataFrame:
    """Distinct clips of the actions, matched without regard to case."""
    own = keyframes if not actions else keyframes.where(F.lower("meta_action").isin([a.lower() for a in actions]))
    return own.select("clip_id").distinct()


def resolve_clips(index: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Distinct clips of keys ``<clip>_<ts>``; with a list, those of it that are there."""
    clips = index.select(F.regexp_extract("key", "^(.*)_[^_]*$", 1).alias("clip_id")).where("clip_id <> ''").distinct()
    return clips if wanted is None else clips.join(wanted, "clip_id", "left_semi")


def balance(keyframes: DataFrame, target: int, custom: list[str] | None = None) -> DataFrame:
    """At most ``target`` rows per action, the longest first, ties by clip and start. A custom action with fewer is an error.

    Spark turns the filtered row number into a limit per task and action, so a frequent action isn't gathered whole."""
    w = Window.partitionBy("meta_action").orderBy(F.desc("duration"), "clip_id", "event_start_frame", "event_end_frame")
    out = keyframes.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= target)
    own = [a for a in custom or [] if a not in KNOWN]
    if own:
        have = {r["meta_action"]: r["n"] for r in keyframes.where(F.col("meta_action").isin(own)).groupBy("meta_action").agg(F.count(F.lit(1)).alias("n")).collect()}
        short = {a: have.get(a, 0) for a in own if have.get(a, 0) < target}
        if short:
            raise ValueError(f"too few keyframes for custom actions: {short}")
    return out.drop("rank")


def agreement(predicted: DataFrame, truth: DataFrame, tracks: tuple[str, ...] = ("longitudinal", "lateral", "lane")) -> DataFrame:
    """Frames of both that agree, per track: (track, frames, equal)."""
    both = predicted.join(truth.select("clip_id", "frame", *[F.col(t).alias(f"t_{t}") for t in tracks]).hint("merge"), ["clip_id", "frame"])
    rows = both.select(F.explode(F.array(*[F.struct(F.lit(t).alias("track"), F.col(t).alias("p"), F.col(f"t_{t}").alias("t")) for t in tracks])).alias("r")).select("r.*")
    return rows.groupBy("track").agg(F.count(F.lit(1)).alias("frames"), F.count_if(F.col("p") == F.col("t")).alias("equal"))


def drop_duplicate_segments(segments: DataFrame, keys: tuple[str, ...] = ("clip_id", "event_start_us")) -> DataFrame:
    """One row for each event, after lists were put together."""
    return segments.dropDuplicates(list(keys))


def spread_work(segments: DataFrame) -> DataFrame:
    """The rows dealt out by clip, so that tasks get about equal work; no row changes."""
    return segments.repartition("clip_id")
