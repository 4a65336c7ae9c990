"""A whole scoring stage over label rows: from raw labels to the compacted result log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from clipspans.functions.text import CAMERA, normalize_record, present, row_key
from clipspans.operators.joins import find_videos, resolve_video, sidecar_seconds
from clipspans.operators.prompts import FULL_WINDOW, STAGE_WINDOWS, stage_window
from clipspans.operators.results import compact_results, echo_model, parse_responses, pending, score_with

#: One line of the log. line_no is this library's: the order of lines over files and runs.
LOG = (
    "stage int, row_key string, row_index bigint, clip_id string, event_timestamp bigint, video_segment string, source_video_path string, segment_mp4_path string, coc_label string, label_class_identifier string, "
    "yaml_path string, evaluator_model_name string, evaluator_backend string, ok boolean, error string, model_response_raw string, evaluation map<string,string>, parse_error string, finish_reason string, "
    "max_tokens_used bigint, timestamp_mode string, video_mode string, segment_start_sec double, segment_duration_sec double, line_no bigint"
)
FIELDS = [f.split()[0] for f in LOG.split(", ")]
#: Bits of a line number for the lines of one task, and for the tasks of one run.
LINE_BITS, TASK_BITS = 26, 20
# fixed values: what a stage's part of the video is called in the log
SEGMENTS = {1: "2s_history", 2: "6s_future", 3: "8s_full"}
PREVIEW = 900


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The stage's log so far, JSON lines; empty where there is none. Lines of other writers, without a number, count as older than
    this library's, in their files' order."""
    try:
        lines = spark.read.schema(LOG).json(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)
    return lines.withColumn("line_no", F.coalesce("line_no", F.monotonically_increasing_id() - (1 << 62)))


def line_numbers(run: int) -> Column:
    """Numbers of a run's lines, above those of all runs before, whatever the number of tasks."""
    at = F.monotonically_increasing_id()  # the task's number above 33 bits for its lines
    line = at.bitwiseAND(F.lit((1 << 33) - 1))
    checked = F.when(line < 1 << LINE_BITS, line).otherwise(F.raise_error(F.lit("too many lines in one task")))
    return F.lit(run << (LINE_BITS + TASK_BITS)).cast("bigint") + F.shiftleft(F.shiftright(at, 33), LINE_BITS) + checked


def finalize_stage(spark: SparkSession, log_path: str) -> DataFrame:
    """The compacted log alone, without scoring anything."""
    return compact_results(read_log(spark, log_path)).drop("position")


def prepare_rows(labels: DataFrame, files: DataFrame, log: DataFrame, stage: int, root: str | None = None, camera: str = CAMERA, frame_ts: DataFrame | None = None, fps: float = 30.0, mode: str = "auto", video_mode: str = "auto", seconds: str | None = None, full: bool = False, limit: int | None = None) -> DataFrame:
    """What ``run_stage`` scores: rows without a result, with their video, its part, and row_error where they can't be scored."""
    rows = normalize_record(labels)
    missing = lambda c, kind: {} if c in rows.columns else {c: F.lit(None).cast(kind)}
    rows = rows.withColumns(missing("video_path_hint", "string") | missing("hint_is_saved_segment", "boolean") | missing("label_class_identifier", "string") | missing("yaml_path", "string"))
    rows = rows.withColumns({"row_key": row_key(F.col("clip_id"), F.col("event_timestamp"), F.col("row_index"), F.col("reject_reason")), "video_path_hint": present(F.col("video_path_hint"))})
    rows = pending(rows, log, limit)
    # a rejected row is known by its number only
    rows = rows.withColumns({c: F.when(F.col("reject_reason").isNull(), F.col(c)) for c in ("clip_id", "event_timestamp", "coc_label", "label_class_identifier", "yaml_path")})
    rows = resolve_video(rows, files) if root is None else find_videos(rows, files, root, camera)
    if frame_ts is not None:
        rows, seconds, problem = sidecar_seconds(rows, frame_ts, fps), "seconds", "sidecar_problem"
    else:
        problem = None
    rows = stage_window(rows, stage, seconds=seconds, problem=problem, source="video_source", mode=mode, video_mode=video_mode, full=full)
    error = F.coalesce("reject_reason", F.when(F.col("video_path").isNull(), "missing_video"), "window_error")
    there = F.col("reject_reason").isNull() & F.col("video_path").isNotNull()
    offset, duration = FULL_WINDOW if full and stage == 2 else STAGE_WINDOWS[stage]
    stamp = F.coalesce(F.nullif("event_timestamp", F.lit(0).cast("bigint")), "row_index")
    whole = (F.col("video_mode") == "segment_8s") & F.lit(offset == 0.0 and duration >= 8.0)
    cut = F.when(whole, F.col("video_path")).otherwise(F.format_string(f"%s_%d_stage{stage}.mp4", "clip_id", stamp))
    good = error.isNull()
    return rows.withColumns({
        "stage": F.lit(stage), "row_error": error, "video_segment": F.lit(SEGMENTS[stage]), "source_video_path": F.when(there, F.col("video_path")), "timestamp_mode": F.when(there, F.lit(mode)), "video_mode": F.when(there, F.col("video_mode")),
        "segment_mp4_path": F.when(good, cut), "segment_start_sec": F.when(good, F.col("start_s")), "segment_duration_sec": F.when(good, F.col("duration_s")),
    })


def run_stage(labels: DataFrame, files: DataFrame, log_path: str, stage: int, prompt: Column, keys: list[str], model: Callable[[list[str]], list] = echo_model, parallel: int | None = None, model_name: str | None = None, backend: str | None = None, dry_run: bool = False, **ways) -> DataFrame:
    """Normalise, skip what is done, find the video, cut the window, prompt, score, parse, log; returns the compacted log.

    labels: (row_index, clip_id, event_timestamp, coc_label; where there, video_path_hint, hint_is_saved_segment, camera_name,
    label_class_identifier, yaml_path), raw; files as in ``resolve_video``, or paths below a ``root`` as in ``find_videos``. With
    ``frame_ts`` of time files (``sidecar_seconds``) the event's second is looked up in them. The other ``ways`` are those of
    ``prepare_rows``. The prompt is a column of the normalised rows. Rows that can't be scored are logged with their error and
    looked at again in the next run, as are failed answers. Only new lines are written; a run that fails before the write
    leaves the log as it was. ``dry_run`` writes nothing and calls no model: it returns the rows with row_error and the
    beginning of their prompt."""
    spark = labels.sparkSession
    log = read_log(spark, log_path)
    rows = prepare_rows(labels, files, log, stage, **ways)
    if dry_run:
        return rows.withColumn("prompt_preview", F.when(F.col("row_error").isNull(), F.substring(prompt, 1, PREVIEW)))
    done = log.agg(F.max("line_no")).first()[0]
    run = 0 if done is None or done < 0 else (done >> (LINE_BITS + TASK_BITS)) + 1
    scored = parse_responses(score_with(rows.where("row_error is null").withColumn("prompt", prompt), model, parallel=parallel), keys)
    answered = F.col("api_error").isNull()
    scored = scored.withColumns({"model_response_raw": F.when(answered, F.col("response")), "evaluator_model_name": F.when(answered, F.lit(model_name)), "evaluator_backend": F.when(answered, F.lit(backend))})
    failed = rows.where("row_error is not null").withColumns({"ok": F.lit(False), "error": F.col("row_error"), "line_no": F.lit(None).cast("bigint")})
    lines = scored.unionByName(failed, allowMissingColumns=True).withColumn("line_no", line_numbers(run))
    lines.select(*FIELDS).write.mode("append").json(log_path)
    return finalize_stage(spark, log_path)
