"""Scalar functions over text and JSON columns: action names, tags, clip ids, missing values, model answers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: canonical action names with their display texts
ACTION_TEXTS = {
    "gentle_acceleration": "Gentle Acceleration",
    "strong_acceleration": "Strong Acceleration",
    "gentle_deceleration": "Gentle Deceleration",
    "strong_deceleration": "Strong Deceleration",
    "maintain_speed": "Maintain Speed",
    "stop": "Stop",
    "reverse": "Reverse",
    "steer_left": "Steer Left",
    "steer_right": "Steer Right",
    "sharp_steer_left": "Sharp Steer Left",
    "sharp_steer_right": "Sharp Steer Right",
    "reverse_left": "Reverse Left",
    "reverse_right": "Reverse Right",
    "go_straight": "Go Straight",
    "keep_lane": "Keep Lane",
    "left_lane_change": "Left Lane Change",
    "right_lane_change": "Right Lane Change",
    "turn_left": "Turn Left",
    "turn_right": "Turn Right",
    "slightly_shift_left": "Slightly Shift Left",
    "slightly_shift_right": "Slightly Shift Right",
    "follow_curve_left": "Follow Curve Left",
    "follow_curve_right": "Follow Curve Right",
    "none": "Not Available",
}
# fixed values: older names
ALIASES = {
    "KeepSpeed": "maintain_speed",
    "Wait": "stop",
    "Accelerate": "strong_acceleration",
    "Decelerate": "strong_deceleration",
    "Straight": "go_straight",
    "KeepLane": "keep_lane",
    "LaneKeep": "keep_lane",
    "LeftLaneChange": "left_lane_change",
    "RightLaneChange": "right_lane_change",
    "LeftTurn": "turn_left",
    "RightTurn": "turn_right",
}
# fixed values: what stands for a missing value
MISSING = ("", "nan", "none", "null")


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])[key]


def _snake(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, r"(?<!^)(?=[A-Z])", "_"))


def strip(text: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def normalize_action(name: Column) -> Column:
    """Canonical snake-case name of an older or camel-case one; null is "none", an unknown name stays as it is (trimmed)."""
    name = strip(name)
    snake = _snake(name)
    return F.when(name.isNull(), "none").otherwise(F.coalesce(_lookup(ALIASES, name), F.when(snake.isin(*ACTION_TEXTS), snake), name))


def canonicalize_action(name: Column) -> Column:
    """As normalize_action, but an unknown name is lower-cased without blanks."""
    found = normalize_action(name)
    return F.when(found.isin(*ACTION_TEXTS), found).otherwise(F.replace(F.lower(found), F.lit(" "), F.lit("")))


def action_text(name: Column) -> Column:
    """Display text of an action in any spelling; an unknown one stays."""
    found = normalize_action(name)
    return F.coalesce(_lookup(ACTION_TEXTS, found), found)


_TAG = r"^\s*([^()]+)\(\s*([^,()]+?)(?:\s*,\s*([^()]+?))?\s+at\s+(\d+)-(\d+)\s*\)\s*$"


def parse_tag(tag: Column) -> Column:
    """``Name(agent[, agent2] at s-e)`` as struct(tag, agents, start, end, type); null if it has another form."""
    part = lambda i: F.regexp_extract(tag, _TAG, i)
    second = part(3)
    agents = F.when(second == "", F.array(part(2))).otherwise(F.array(part(2), second))
    out = F.struct(
        F.regexp_replace(F.trim(part(1)), "Temporal$", "").alias("tag"), agents.alias("agents"), part(4).try_cast("int").alias("start"), part(5).try_cast("int").alias("end"),
        F.when(second == "", "unary").otherwise("binary").alias("type"),
    )
    return F.when(F.regexp_like(tag, F.lit(_TAG)), out)


def format_tag(tag: Column, agent: Column, start: Column, end: Column) -> Column:
    return F.concat(tag, F.lit("("), agent, F.lit(" at "), start, F.lit("-"), end, F.lit(")"))


_UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
CAMERA = "camera_front_wide_120fov"
# fixed values: endings of file names that aren't part of a clip id, {} for the camera; the first that fits is cut
CLIP_ENDINGS = (
    ".json",
    ".yaml",
    ".yml",
    ".txt",
    ".{}.mp4.timestamps.parquet",
    ".{}.mp4.timestamps",
    ".{}.timestamps.parquet",
    ".{}.timestamps",
    ".{}.mp4",
    "_{}.mp4.timestamps.parquet",
    "_{}.mp4.timestamps",
    "_{}.timestamps.parquet",
    "_{}.timestamps",
    "_{}.mp4",
    ".{}",
    "_{}",
    "_fpv.mp4",
    ".mp4",
)


def normalize_clip_id(path: Column, camera: str = CAMERA) -> Column:
    """Clip id of a path: its last part without the first ending that fits, or the UUID that it begins with; null for a blank one."""
    leaf = F.trim(F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -1))
    # every longer ending stands before the shorter ones that it ends with, so the first that fits is where the search stops
    cut = F.regexp_replace(leaf, "(?:" + "|".join(re.escape(e.format(camera)) for e in CLIP_ENDINGS) + ")$", "")
    uuid = F.regexp_extract(cut, _UUID, 0)
    return F.when(leaf != "", F.when(uuid != "", uuid).otherwise(cut))


def parse_filter(text: str | list[str] | None) -> list[str] | None:
    """Lower-case names of filter texts such as "a b", "a,b" or "[a, b]"; None for no filter (null, or any text that is all, none, null or blank)."""
    found: dict[str, None] = {}
    for one in [text] if isinstance(text, str) else text or []:
        if one.strip().lower() in ("", "all", "none", "null"):
            return None
        names = [x.strip("'\"") for x in re.split(r"[\s,]+", one.strip().strip("[]"))]
        found |= dict.fromkeys(x.lower() for x in names if x)
    return list(found) or None


def present(value: Column) -> Column:
    """Text without white space at its ends, or null if it stands for a missing value."""
    text = strip(value.cast("string"))
    return F.when(~F.lower(text).isin(*MISSING), text)


def first_present(df: DataFrame, names: list[str]) -> Column:
    """The first non-missing value of the candidate columns that ``df`` has; arrays, maps and structs as JSON."""
    kinds = dict(df.dtypes)
    has = [n for n in names if n in kinds]
    nested = lambda n: kinds[n].startswith(("array", "map", "struct"))
    return F.coalesce(*[F.to_json(F.col(n)) if nested(n) else present(F.col(n)) for n in has], F.lit(None).cast("string"))


def pick_column(df: DataFrame, names: list[str]) -> str | None:
    """The first of the candidate columns that ``df`` has."""
    return next((n for n in names if n in df.columns), None)


def valid_timestamp(text: Column) -> Column:
    """Whole number of at least 0 from a text such as "12" or "12.0"; null for anything else."""
    number = text.try_cast("double")
    return F.when((number >= 0) & ~F.isnan(number) & (number < 9.2e18), number.cast("bigint"))


def filename_timestamp(path: Column) -> Column:
    """The number in ``cot_<ts>.yaml`` or ``cot_<ts>_<more>.yaml``."""
    return F.regexp_extract(path, r"(?:^|/)cot_(\d+)(?:_[^/]*)?\.ya?ml$", 1).try_cast("bigint")


def camera_of(prompts: Column) -> Column:
    """The first camera name in a list of prompt texts."""
    hits = F.filter(F.transform(prompts, lambda p: F.regexp_extract(p, r"camera_front_[A-Za-z0-9_]+", 0)), lambda c: c != "")
    return F.try_element_at(hits, F.lit(1))


def strip_thinking(text: Column) -> Column:
    """What follows the first closing think mark, if there is one, without white space at its ends."""
    at = F.locate("</think>", text)
    return strip(F.when(at > 0, F.substring(text, at + 8, F.length(text))).otherwise(text))


_OBJECT = "map<string,string>"
_STRICT = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}


def parse_model_json(text: Column) -> Column:
    """struct(evaluation, parse_error): the JSON object that an answer is, holds in a fence, or has between its outer braces."""
    text = strip_thinking(F.coalesce(text, F.lit("")))
    fence = F.regexp_extract(text, r"(?s)```(?:json|JSON)?\s*(.*?)```", 1)
    braces = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    good = []
    for tried in (text, strip(fence), braces):
        # as the only item of a list, so that a second object behind the first is seen
        items = F.from_json(F.concat(F.lit("["), tried, F.lit("]")), f"array<{_OBJECT}>", _STRICT)
        good.append(F.when(tried.startswith("{") & tried.endswith("}") & (F.size(items) == 1), F.try_element_at(items, F.lit(1))))
    found = F.coalesce(*good)
    error = F.when(text == "", "empty_response").when(found.isNull(), "json_parse_failed")
    return F.struct(found.alias("evaluation"), error.alias("parse_error"))


SUPPORT_KEY = "decision_supported_by_video"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def is_score(key: str) -> bool:
    """Whether an answer's key must be a number from 0 to 1."""
    return key.endswith("_score") or key == SUPPORT_KEY


def validate_scores(evaluation: Column, keys: list[str]) -> Column:
    """The first complaint about the score keys among ``keys``, null if all are numbers from 0 to 1: missing_score or invalid_score.
    Other keys may be missing and hold anything."""
    out = F.lit(None).cast("string")
    for key in reversed([k for k in keys if is_score(k)]):
        value = F.try_element_at(evaluation, F.lit(key))
        good = F.regexp_like(value, F.lit(_NUMBER)) & F.trim(value).try_cast("double").between(0.0, 1.0)
        out = F.when(~F.map_contains_key(evaluation, F.lit(key)), F.lit(f"validation_error:missing_score:{key}")).when(~F.coalesce(good, F.lit(False)), F.lit(f"validation_error:invalid_score:{key}")).otherwise(out)
    return F.when(evaluation.isNotNull(), out)


def kept_evaluation(evaluation: Column, keys: list[str]) -> Column:
    """The listed keys of an answer, scores as number texts; null where a score key is missing or wrong."""
    scores = [k for k in keys if is_score(k)]
    number = lambda k, v: F.when(k.isin(*scores), F.trim(v).try_cast("double").cast("string")).otherwise(v) if scores else v
    own = F.map_filter(evaluation, lambda k, v: k.isin(*keys)) if keys else F.map_filter(evaluation, lambda k, v: F.lit(False))
    return F.when(validate_scores(evaluation, keys).isNull(), F.transform_values(own, number))


def row_key(clip_id: Column, timestamp: Column, row_index: Column, reject_reason: Column | None = None) -> Column:
    """``clip_ts_index``; a null time prints None. A row without a clip, or rejected for any other reason, is ``row_index``."""
    bad = clip_id.isNull() if reject_reason is None else clip_id.isNull() | reject_reason.isNotNull()
    return F.when(bad, F.concat(F.lit("row_"), row_index)).otherwise(F.concat_ws("_", clip_id, F.coalesce(timestamp.cast("string"), F.lit("None")), row_index))


def whole_number(text: Column) -> Column:
    """The number of a text, cut to a whole one, of either sign; null for anything else."""
    number = F.when(F.regexp_like(text, F.lit(_NUMBER)), strip(text).try_cast("double"))
    return F.when(F.abs(number) < 9.2e18, F.coalesce(strip(text).try_cast("bigint"), number.cast("bigint")))


def normalize_record(df: DataFrame, label: str = "coc_label") -> DataFrame:
    """Label rows with reject_reason: missing_clip_id, missing_<label>, invalid_timestamp, or null for a good row. A time can be
    negative; its fraction is cut off."""
    clip, text, raw = present(F.col("clip_id")), present(F.col(label)), present(F.col("event_timestamp"))
    stamp = whole_number(raw)
    reason = F.when(clip.isNull(), "missing_clip_id").when(text.isNull(), f"missing_{label}").when(raw.isNotNull() & stamp.isNull(), F.concat(F.lit("invalid_timestamp:"), raw))
    return df.withColumns({"clip_id": clip, label: text, "event_timestamp": stamp, "reject_reason": reason})
