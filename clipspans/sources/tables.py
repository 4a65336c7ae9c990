"""Readers and writers of the files around the jobs. Paths may be in any store that Spark reads."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clipspans.functions.text import CAMERA, filename_timestamp, first_present, normalize_clip_id, parse_tag, pick_column, present, valid_timestamp
from clipspans.sources.archives import PARTITION_BYTES, parts_of, read_archives, read_files, write_archives, write_files

TICKS = "clip_id string, agent_id string, tick int, x double, y double, z double, vx double, vy double, ax double, ay double, heading double"
SPAN_LINE = r"^\s*(\w+)\s*-\s*Agent:<ego>,\s*Start:(\d+),\s*End:(\d+)\s*$"
LABELS = "row_index bigint, clip_id string, event_timestamp bigint, coc_label string, label_class_identifier string, camera_name string, yaml_path string"
FRAME_NAMES = ["frame_index", "frame_idx", "index_in_video", "frame", "idx"]
TIME_NAMES = ["timestamp_micros", "timestamp_us", "timestamp", "ts", "timestamp_microseconds"]


def read_ticks(spark: SparkSession, path: str) -> DataFrame:
    """The agent state table with its time in seconds."""
    return spark.read.schema(TICKS).parquet(path).withColumn("time_s", F.col("tick") * 0.1)


def read_zipped_ticks(spark: SparkSession, path: str, columns: list[str] | None = None, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """Ticks from archives of Parquet members, one clip each; the member's name gives the clip, a row's place its tick, and agents are
    the ego, where the file doesn't say. Only ``columns`` are read (none: all). Bad members are errors. Members are dealt out by
    size, and a task holds one at a time."""
    kinds = {f.split()[0]: f.split()[1] for f in TICKS.split(", ")}
    wanted = list(kinds) if columns is None else columns
    schema = [f"{c} {kinds[c]}" for c in wanted] + (["row int"] if "tick" in wanted else [])
    rows = read_archives(spark, path, ", ".join(schema), kind="parquet", suffix=".parquet", partitionBytes=str(partition_bytes))
    fill = {"clip_id": F.regexp_replace("clip_id", r"\.egomotion$", ""), "tick": F.coalesce("tick", "row") if "tick" in wanted else None, "agent_id": F.coalesce("agent_id", F.lit("ego")) if "agent_id" in wanted else None}
    return rows.withColumns({c: v for c, v in fill.items() if c in wanted}).select(*wanted)


def _paths(spark: SparkSession, path: str) -> DataFrame:
    """(path) of the files; their contents aren't read."""
    return spark.read.format("binaryFile").load(path).select("path")


def _opened(path: str) -> BinaryIO:
    """A file in a store that tasks can reach, read where it is sought."""
    store, place = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return store.open_input_file(place)


def _clip_of_file(suffix: str) -> Column:
    """The clip that a file is named after, or its folder, where this library wrote it."""
    path = F.input_file_name()
    folder = F.regexp_extract(path, r"/clip_id=([^/]+)/[^/]*$", 1)
    return F.when(folder != "", folder).otherwise(F.regexp_extract(path, r"([^/]+?)" + re.escape(suffix) + "$", 1))


def _whole_files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """(clip_id, value) of the files, as this library wrote them or in any layout that Spark's reader takes."""
    if parts_of(path):
        return read_files(spark, path).select("clip_id", F.col("content").cast("string").alias("value"))
    return spark.read.text(path, wholetext=True).select(_clip_of_file(suffix).alias("clip_id"), "value")


def read_raw_tags(spark: SparkSession, path: str, suffix: str = ".json") -> DataFrame:
    """(clip_id, ord, tag, parsed) of files that hold one JSON list of tags each."""
    rows = _whole_files(spark, path, suffix).select("clip_id", F.from_json("value", "array<string>").alias("tags"))
    return rows.select("clip_id", F.posexplode("tags").alias("ord", "tag")).withColumn("parsed", parse_tag(F.col("tag")))


def _tag_lists(tags: DataFrame) -> DataFrame:
    """(clip_id, value): each clip's tags as a JSON list."""
    return tags.groupBy("clip_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("ord", "tag"))), lambda x: x["tag"])).alias("value"))


def _write_lines(texts: DataFrame, path: str, suffix: str) -> None:
    """(clip_id, value) as files that end with a line break."""
    write_files(texts.select("clip_id", F.concat("value", F.lit("\n")).alias("content")), path, suffix)


def write_raw_tags(tags: DataFrame, path: str) -> None:
    """One JSON list per clip, in a folder of that clip; clips without tags write nothing."""
    _write_lines(_tag_lists(tags), path, ".json")


def write_packed_tags(tags: DataFrame, path: str) -> None:
    """The same lists as members of few archives, as many as there are tasks."""
    write_archives(_tag_lists(tags).withColumnRenamed("value", "content"), path, ".json")


def read_packed_tags(spark: SparkSession, path: str, suffix: str = ".json") -> DataFrame:
    """As ``read_raw_tags``, from archives."""
    rows = read_archives(spark, path, "clip_id string, content binary", suffix=suffix).select("clip_id", F.from_json(F.col("content").cast("string"), "array<string>").alias("tags"))
    return rows.select("clip_id", F.posexplode("tags").alias("ord", "tag")).withColumn("parsed", parse_tag(F.col("tag")))


def parse_label_lines(lines: DataFrame) -> DataFrame:
    """(clip_id, line_no, tag, start, end) of (clip_id, line_no, line); lines of another form or agent are skipped."""
    part = lambda i: F.regexp_extract("line", SPAN_LINE, i)
    out = lines.select("clip_id", "line_no", part(1).alias("tag"), part(2).try_cast("int").alias("start"), part(3).try_cast("int").alias("end"))
    return out.where("tag <> '' and start is not null and `end` is not null")


def read_label_text(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    files = _whole_files(spark, path, suffix).select("clip_id", F.split("value", "\n").alias("lines"))
    return parse_label_lines(files.select("clip_id", F.posexplode("lines").alias("line_no", "line")))


def _label_texts(lines: DataFrame) -> DataFrame:
    return lines.groupBy("clip_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("value"))


def write_label_text(lines: DataFrame, path: str) -> None:
    """One text file per clip from (clip_id, line_no, line)."""
    _write_lines(_label_texts(lines), path, ".txt")


def write_packed_label_text(lines: DataFrame, path: str) -> None:
    """The same texts as members of few archives, as many as there are tasks."""
    write_archives(_label_texts(lines).withColumnRenamed("value", "content"), path, ".txt")


def read_packed_label_text(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """As ``read_label_text``, from archives."""
    files = read_archives(spark, path, "clip_id string, content binary", suffix=suffix).select("clip_id", F.split(F.col("content").cast("string"), "\n").alias("lines"))
    return parse_label_lines(files.select("clip_id", F.posexplode("lines").alias("line_no", "line")))


#: Buckets in buckets that an index may have.
LEVELS = 64
_MAP, _LIST, _ENTRY = "map<string, variant>", "array<variant>", "struct<bucket: string, ord: int, entry: variant>"


def index_entries(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(bucket, ord, entry) of JSON documents (value), entry as VARIANT: the items of a list at the top (no bucket), and of an object the
    items of its lists, and the objects with clip_id or filename, under their key; other objects are buckets with the same
    inside. Other values are no entries; what is no JSON is an error, as are more than ``levels`` buckets in one another.

    Each document is walked in its row, level by level, with the buckets that are still closed; nothing is shuffled."""
    m = lambda v: f"try_cast({v} as {_MAP})"
    own = "map_contains_key(n.m, 'clip_id') or map_contains_key(n.m, 'filename')"
    items = lambda v, bucket: f"transform(coalesce(try_cast({v} as {_LIST}), cast(array() as {_LIST})), (x, i) -> cast(named_struct('bucket', {bucket}, 'ord', i, 'entry', x) as {_ENTRY}))"
    kids = f"flatten(transform(filter(acc.nodes, n -> not ({own})), n -> transform(map_entries(n.m), e -> named_struct('key', e.key, 'value', e.value))))"
    known = f"transform(filter(acc.nodes, n -> {own}), n -> cast(named_struct('bucket', n.bucket, 'ord', 0, 'entry', n.v) as {_ENTRY}))"
    node = f"struct<bucket: string, v: variant, m: {_MAP}>"
    nodes = f"filter(transform(k, e -> cast(named_struct('bucket', e.key, 'v', e.value, 'm', {m('e.value')}) as {node})), n -> n.m is not null)"
    found = f"concat(acc.entries, {known}, flatten(transform(k, e -> {items('e.value', 'e.key')})))"
    # k is computed once: a lambda over an array of one item
    step = f"element_at(transform(array({kids}), k -> named_struct('nodes', {nodes}, 'entries', {found})), 1)"
    kind = f"struct<nodes: array<{node}>, entries: array<{_ENTRY}>>"
    begin = f"cast(named_struct('nodes', filter(array(named_struct('bucket', cast(null as string), 'v', v, 'm', {m('v')})), n -> n.m is not null), 'entries', {items('v', 'cast(null as string)')}) as {kind})"
    walked = f"aggregate(sequence(1, {levels + 1}), {begin}, (acc, i) -> if(size(acc.nodes) = 0, acc, cast({step} as {kind})))"
    rows = docs.select(F.parse_json("value").alias("v")).selectExpr(f"{walked} as w")
    return rows.selectExpr(f"explode(if(size(w.nodes) = 0, w.entries, raise_error('more than {levels} buckets in one another'))) as e").select("e.*")


def parse_keyframes(docs: DataFrame) -> DataFrame:
    """Keyframes of JSON documents (value) of any shape that ``index_entries`` reads, with new or old keys. Entries without a clip or a start,
    without end and duration, or with another value than a number drop out; the one of end and duration that is missing
    follows from the other."""
    entries = index_entries(docs).withColumn("m", F.expr(f"try_cast(entry as {_MAP})")).where("m is not null")
    field = lambda name, kind="string": F.expr(f"try_variant_get(entry, '$.{name}', '{kind}')")
    names = {"start": ("event_start_frame", "start"), "end": ("event_end_frame", "end"), "duration": ("duration",)}
    # a key that is there, though null, stands before the older one
    first = lambda keys, of: F.when(F.map_contains_key("m", F.lit(keys[0])), of(keys[0])).otherwise(of(keys[-1]))
    rows = entries.withColumns({f"_{n}": first(keys, lambda k: field(k, "int")) for n, keys in names.items()} | {f"_{n}_text": first(keys, field) for n, keys in names.items()})
    for n in names:
        rows = rows.where(F.col(f"_{n}").isNotNull() | F.col(f"_{n}_text").isNull())
    start, end = F.col("_start"), F.coalesce("_end", F.col("_start") + F.col("_duration"))
    clip = F.coalesce(present(field("clip_id")), normalize_clip_id(present(field("filename"))))
    out = rows.select(F.coalesce(field("meta_action"), field("action"), "bucket").alias("meta_action"), clip.alias("clip_id"), start.alias("event_start_frame"), end.alias("event_end_frame"), F.coalesce("_duration", end - start).alias("duration"), "ord")
    return out.where("clip_id is not null and event_start_frame is not null and event_end_frame is not null")


def index_clip_ids(docs: DataFrame, actions: list[str] | None = None, camera: str = CAMERA) -> DataFrame:
    """Distinct clips that the entries of JSON documents (value) name: texts, or objects by the first of clip_id, filename, file_name and
    video_id that gives an id. With actions, entries whose bucket or own action is one of them, in any case."""
    entries = index_entries(docs)
    field = lambda name: F.expr(f"try_variant_get(entry, '$.{name}', 'string')")
    if actions is not None:
        wanted = [a.lower() for a in actions]
        match = lambda c: F.coalesce(F.lower(c).isin(wanted), F.lit(False))
        entries = entries.where(match(F.col("bucket")) | match(field("meta_action")) | match(field("action")))
    text = F.expr("case when schema_of_variant(entry) = 'STRING' then cast(entry as string) end")
    ids = [normalize_clip_id(c, camera) for c in (text, *[field(k) for k in ("clip_id", "filename", "file_name", "video_id")])]
    return entries.select(F.coalesce(*ids).alias("clip_id")).where("clip_id is not null").distinct()


def read_keyframes(spark: SparkSession, path: str) -> DataFrame:
    return parse_keyframes(spark.read.text(path, wholetext=True))


def write_keyframes(keyframes: DataFrame, path: str) -> None:
    """JSON lines, in a folder per action: a record per keyframe, so no action is gathered in one place."""
    keyframes.write.partitionBy("meta_action").json(path)


def time_candidates(times: str | list[str] | list[list[str]] | None, files: int) -> list[list[str]]:
    """For each file, the names that its time column may have: one name for all, a name for each file (where there are as many), the same
    candidates for all, or candidates for each."""
    if times is None:
        times = ["event_start_us", "event_start_timestamp", *TIME_NAMES]
        return [times] * files
    if isinstance(times, str):
        return [[times]] * files
    if not times:
        raise ValueError("no time columns")
    if all(not isinstance(t, str) for t in times):
        if len(times) != files:
            raise ValueError("as many lists of time columns as files are needed")
        return [list(t) for t in times]
    return [[t] for t in times] if len(times) == files else [list(times)] * files


def read_segment_lists(spark: SparkSession, paths: list[str], clip: str = "clip_id", times: str | list[str] | list[list[str]] | None = None) -> DataFrame:
    """(clip_id, event_start_us) of several Parquet lists whose time column is named differently (``time_candidates``)."""
    out = None
    for path, candidates in zip(paths, time_candidates(times, len(paths))):
        df = spark.read.parquet(path)
        name = pick_column(df, candidates)
        if name is None:
            raise ValueError(f"{path}: none of the time columns")
        rows = df.select(F.col(clip).cast("string").alias("clip_id"), F.col(name).cast("bigint").alias("event_start_us"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no paths")
    return out


def read_label_docs(spark: SparkSession, path: str) -> DataFrame:
    """Labels of ``<clip>/cot_<ts>.yaml`` documents at any depth; a document that can't be read gives nulls."""

    def pick(text: str) -> tuple:
        import yaml

        try:
            doc = yaml.safe_load(text)
        except yaml.YAMLError:
            return None, None, None, None, None
        entries = doc.get("results", [doc]) if isinstance(doc, dict) else doc if isinstance(doc, list) else []
        for e in entries if isinstance(entries, list) else [entries]:
            if isinstance(e, dict):
                final = e.get("final_content") or {}
                schema = final.get("ego_behavior_schema") or {} if isinstance(final, dict) else {}
                label = (schema.get("effect_on_ego_behavior") if isinstance(schema, dict) else None) or e.get("coc_label")
                if label:
                    prompt = json.dumps(e.get("prompt") or "")
                    camera = re.search(r"camera_front_\w+", prompt)
                    return e.get("clip_id"), str(label), e.get("event_start_timestamp"), e.get("label_class_identifier"), camera and camera[0]
        return None, None, None, None, None

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(p, *(None if v is None else str(v) for v in pick(t))) for p, t in zip(batch["path"], batch["value"])]
            yield pd.DataFrame(rows, columns=["yaml_path", "clip", "coc_label", "ts", "label_class_identifier", "camera_name"])

    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "cot_*.yaml").text(path, wholetext=True)
    rows = files.select(F.input_file_name().alias("path"), "value").mapInPandas(parse, "yaml_path string, clip string, coc_label string, ts string, label_class_identifier string, camera_name string")
    folder = F.regexp_extract("yaml_path", r"([^/]+)/[^/]+$", 1)
    return rows.select(F.coalesce(present(F.col("clip")), folder).alias("clip_id"), F.coalesce(valid_timestamp(present(F.col("ts"))), filename_timestamp(F.col("yaml_path"))).alias("event_timestamp"), "coc_label", "label_class_identifier", "camera_name", "yaml_path")


def read_label_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV, JSON lines, a JSON list or {"rows": [...]}, or Parquet, by the path's ending."""
    if path.endswith(".csv"):
        df = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
        return df.toDF(*[c.lstrip("﻿") for c in df.columns])
    if path.endswith(".jsonl"):
        return spark.read.json(path)
    if path.endswith(".json"):
        df = spark.read.option("multiLine", True).json(path)
        return df.select(F.explode("rows").alias("r")).select("r.*") if df.columns == ["rows"] else df
    return spark.read.parquet(path)


def label_rows(df: DataFrame, names: dict[str, list[str]]) -> DataFrame:
    """Columns by the first non-missing of their candidate columns."""
    return df.select(*[first_present(df, candidates).alias(name) for name, candidates in names.items()])


def read_frame_ts(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(clip_id, frame_index, ts_us) of Parquet sidecars, or of text files with two columns; a malformed line is skipped, or an
    error when strict."""
    if path.rstrip("/*").endswith(".parquet"):
        df = spark.read.parquet(path)
        frame, time = pick_column(df, FRAME_NAMES), pick_column(df, TIME_NAMES)
        if time is None:
            raise ValueError(f"{path}: no time column")
        clip = F.col("clip_id") if "clip_id" in df.columns else normalize_clip_id(F.input_file_name())
        index = F.col(frame).cast("int") if frame else F.col("_metadata.row_index").cast("int")
        return df.select(clip.alias("clip_id"), index.alias("frame_index"), F.col(time).cast("bigint").alias("ts_us"))
    parts = F.split(F.trim("value"), r"[\s,]+")
    index, ts = F.try_element_at(parts, F.lit(1)).try_cast("int"), F.try_element_at(parts, F.lit(2)).try_cast("bigint")
    rows = spark.read.text(path).where("trim(value) <> ''")
    good = index.isNotNull() & ts.isNotNull() & (F.size(parts) == 2)
    if strict:
        rows = rows.where(F.when(good, True).otherwise(F.raise_error(F.concat(F.lit("malformed line: "), F.col("value")))))
    return rows.where(good).select(normalize_clip_id(F.input_file_name()).alias("clip_id"), index.alias("frame_index"), ts.alias("ts_us"))


def write_result_log(results: DataFrame, path: str) -> None:
    results.write.mode("append").json(path)


def finalize_results(log: DataFrame, path: str) -> None:
    """The compacted log, in the order of each key's first line: one JSON line per row, in parts that are sorted among each other."""
    from clipspans.operators.results import compact_results

    rows = compact_results(log)
    rows.repartitionByRange(_parts(rows.sparkSession), "position").sortWithinPartitions("position").write.mode("overwrite").json(path)


def _parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def write_json_document(rows: DataFrame, path: str, order: list[str], stage: str) -> None:
    """``rows`` in order as one JSON list: the parts below ``path``, one after the other by name, are the document, a row in each line.

    The rows are range-partitioned and sorted into a table at ``stage``, where each gets a number; the least and the greatest, all
    that the driver learns, tell which row opens the list and which one closes it. No task gets more than its range."""
    spark = rows.sparkSession
    sorted_rows = rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    keys = [f"o{i}" for i in range(len(order))]
    sorted_rows.repartitionByRange(_parts(spark), *keys, "value").sortWithinPartitions(*keys, "value").select("value", F.monotonically_increasing_id().alias("at")).write.mode("overwrite").parquet(stage)
    table = spark.read.schema("value string, at bigint").parquet(stage)
    first, last = table.agg(F.min("at"), F.max("at")).first()
    if first is None:
        spark.createDataFrame([("[]",)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return
    lines = F.concat(F.when(F.col("at") == first, "[").otherwise(","), "value", F.when(F.col("at") == last, "]").otherwise(""))
    table.repartitionByRange(_parts(spark), "at").sortWithinPartitions("at").select(lines.alias("value")).write.mode("overwrite").text(path)


def read_json_document(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The rows of a document that ``write_json_document`` wrote."""
    text = F.regexp_replace(F.regexp_replace("value", r"^[\[,]", ""), r"\]$", "")
    return spark.read.text(path).select(text.alias("value")).where("value <> ''").select(F.from_json("value", schema).alias("r")).select("r.*")


def finalize_document(log: DataFrame, path: str, stage: str) -> None:
    """The compacted log as one JSON list, in the order of each key's first line."""
    from clipspans.operators.results import compact_results

    write_json_document(compact_results(log), path, ["position"], stage)


def read_clip_list(spark: SparkSession, path: str) -> DataFrame | None:
    """Ids, one per line; None for a list without any."""
    ids = spark.read.text(path).select(F.trim("value").alias("clip_id")).where("clip_id <> ''").distinct()
    return None if ids.isEmpty() else ids


def write_labels(df: DataFrame, path: str) -> None:
    """Parquet in folders by the first four characters of the clip id."""
    df.withColumn("grp", F.substring("clip_id", 1, 4)).write.partitionBy("grp").parquet(path)


def list_archive_members(spark: SparkSession, path: str) -> DataFrame:
    """(zip_path, member_name) from the archives' directories; a bad archive gives one row with its problem."""

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["path"]:
                try:
                    with _opened(name) as file, zipfile.ZipFile(file) as archive:
                        found = [(name, m, None) for m in archive.namelist() if not m.endswith("/")]
                except (zipfile.BadZipFile, pa.ArrowInvalid) as problem:  # the second, where a file is shorter than an archive can be
                    found = [(name, None, str(problem))]
                yield pd.DataFrame(found, columns=["zip_path", "member_name", "problem"]).astype("object")

    return _paths(spark, path).mapInPandas(members, "zip_path string, member_name string, problem string")
