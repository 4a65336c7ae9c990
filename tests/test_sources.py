"""Readers and writers on small files."""

import io
import json
import zipfile

import pandas as pd
import pytest

from clipspans.sources import tables


def test_label_text(spark, tmp_path):
    (tmp_path / "c1.txt").write_text("  Stop - Agent:<ego>, Start:0, End:5\n  Stop - Agent:<ego>, Start:x, End:5\n  Stop - Agent:<car>, Start:0, End:5\n\n  GoStraight - Agent:<ego>, Start:5, End:9\n")
    got = tables.read_label_text(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [(r.clip_id, r.tag, r.start, r.end) for r in got] == [("c1", "Stop", 0, 5), ("c1", "GoStraight", 5, 9)]
    lines = spark.createDataFrame([("c1", 1, "b"), ("c1", 0, "a"), ("c2", 0, "x")], "clip_id string, line_no int, line string")
    tables.write_label_text(lines, str(tmp_path / "out"))
    assert {r.clip_id: r.n for r in spark.read.text(str(tmp_path / "out")).groupBy("clip_id").agg({"value": "count"}).toDF("clip_id", "n").collect()} == {"c1": 2, "c2": 1}


def test_raw_tags(spark, tmp_path):
    (tmp_path / "c1.json").write_text(json.dumps(["StopTemporal(ego at 0-3)", "Reverse(ego at 3-9)"]))
    got = tables.read_raw_tags(spark, str(tmp_path / "c1.json")).orderBy("ord").collect()
    assert [(r.clip_id, r.parsed.tag, r.parsed.end) for r in got] == [("c1", "Stop", 3), ("c1", "Reverse", 9)]
    tables.write_raw_tags(spark.createDataFrame([("c9", 0, "A(ego at 0-1)")], "clip_id string, ord int, tag string"), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first().value == '["A(ego at 0-1)"]'


def test_keyframes(spark, tmp_path):
    (tmp_path / "k.json").write_text(json.dumps({"stop": [{"action": "stop", "filename": "a/c1.txt", "start": 5, "end": 25}, {"clip_id": "c2", "event_start_frame": 7, "duration": 10}, {"clip_id": "c3", "duration": 3}], "reverse": []}))
    got = sorted(tuple(r) for r in tables.read_keyframes(spark, str(tmp_path / "k.json")).drop("ord").collect())
    assert got == [("stop", "c1", 5, 25, 20), ("stop", "c2", 7, 17, 10)]


def test_segment_lists(spark, tmp_path):
    for name, column in (("a", "event_start_timestamp"), ("b", "ts")):
        spark.createDataFrame([(name, 5)], f"clip_id string, {column} int").write.parquet(str(tmp_path / name))
    got = tables.read_segment_lists(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert sorted(tuple(r) for r in got.collect()) == [("a", 5), ("b", 5)]
    assert tables.time_candidates(["x", "y", "z"], 2) == [["x", "y", "z"]] * 2 and tables.time_candidates(["x", "y"], 2) == [["x"], ["y"]]
    spark.createDataFrame([("c",)], "clip_id string").write.parquet(str(tmp_path / "c"))
    with pytest.raises(ValueError):
        tables.read_segment_lists(spark, [str(tmp_path / "c")])


def test_label_docs(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "c1").mkdir()
    (tmp_path / "c1" / "cot_77.yaml").write_text("results:\n- final_content:\n    ego_behavior_schema:\n      effect_on_ego_behavior: Keep lane\n  prompt: [see camera_front_wide]\n")
    (tmp_path / "c1" / "cot_78_x.yaml").write_text("a: [")
    got = {r.event_timestamp: (r.clip_id, r.coc_label, r.camera_name) for r in tables.read_label_docs(spark, str(tmp_path)).collect()}
    assert got == {77: ("c1", "Keep lane", "camera_front_wide"), 78: ("c1", None, None)}


def test_label_tables(spark, tmp_path):
    rows = [{"clip_id": "a", "n": 1}, {"clip_id": "b", "n": 2}]
    (tmp_path / "a.csv").write_text("﻿clip_id,n\na,1\nb,2\n")
    (tmp_path / "b.json").write_text(json.dumps(rows))
    (tmp_path / "c.json").write_text(json.dumps({"rows": rows}))
    (tmp_path / "d.jsonl").write_text("\n".join(map(json.dumps, rows)))
    spark.createDataFrame(rows).write.parquet(str(tmp_path / "e.parquet"))
    for name in ("a.csv", "b.json", "c.json", "d.jsonl", "e.parquet"):
        got = tables.read_label_table(spark, str(tmp_path / name))
        assert sorted((r.clip_id, int(r.n)) for r in got.collect()) == [("a", 1), ("b", 2)], name
    picked = tables.label_rows(spark.createDataFrame([("nan", "x")], "label string, text string"), {"coc_label": ["label", "text", "other"]})
    assert picked.first().coc_label == "x"


def test_frame_sidecars(spark, tmp_path):
    (tmp_path / "c1.txt").write_text("0 100\nbad\n1,133\n\n")
    got = tables.read_frame_ts(spark, str(tmp_path / "c1.txt"))
    assert sorted((r.clip_id, r.frame_index, r.ts_us) for r in got.collect()) == [("c1", 0, 100), ("c1", 1, 133)]
    with pytest.raises(Exception, match="malformed"):
        tables.read_frame_ts(spark, str(tmp_path / "c1.txt"), strict=True).collect()
    spark.createDataFrame([("c2", 4, 9)], "clip_id string, frame_idx int, timestamp_us bigint").write.parquet(str(tmp_path / "f.parquet"))
    assert tuple(tables.read_frame_ts(spark, str(tmp_path / "f.parquet")).first()) == ("c2", 4, 9)


def test_archives(spark, tmp_path):
    data = io.BytesIO()
    pd.DataFrame({"x": [0.0, 1.0], "y": [0.0, 0.0], "vx": [1.0, 1.0], "vy": [0.0, 0.0], "heading": [0.0, 0.0]}).to_parquet(data)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("d/c7.egomotion.parquet", data.getvalue())
    ticks = tables.read_zipped_ticks(spark, str(tmp_path / "a.zip")).orderBy("tick").collect()
    assert [(r.clip_id, r.agent_id, r.tick, r.x) for r in ticks] == [("c7", "ego", 0, 0.0), ("c7", "ego", 1, 1.0)]
    (tmp_path / "b.zip").write_bytes(b"no zip")
    members = {r.member_name: r.problem for r in tables.list_archive_members(spark, str(tmp_path / "*.zip")).collect()}
    assert members["d/c7.egomotion.parquet"] is None and members[None]


def test_lists_and_layout(spark, tmp_path):
    (tmp_path / "ids").write_text(" a \n\nb\n")
    assert sorted(r.clip_id for r in tables.read_clip_list(spark, str(tmp_path / "ids")).collect()) == ["a", "b"]
    (tmp_path / "none").write_text("\n")
    assert tables.read_clip_list(spark, str(tmp_path / "none")) is None
    tables.write_labels(spark.createDataFrame([("abcd1", 1)], "clip_id string, n int"), str(tmp_path / "l"))
    assert spark.read.parquet(str(tmp_path / "l")).first().grp == "abcd"
    log = spark.createDataFrame([("k", 0, False, "e", None, None), ("k", 1, True, None, None, {"a": "1"})], "row_key string, line_no bigint, ok boolean, error string, parse_error string, evaluation map<string,string>")
    tables.write_result_log(log, str(tmp_path / "log"))
    tables.finalize_results(spark.read.schema(log.schema).json(str(tmp_path / "log")), str(tmp_path / "final"))
    assert [r.line_no for r in spark.read.json(str(tmp_path / "final")).collect()] == [1]
    tables.write_keyframes(spark.createDataFrame([("stop", "c", 1)], "meta_action string, clip_id string, duration int"), str(tmp_path / "k"))
    assert spark.read.json(str(tmp_path / "k")).first().meta_action == "stop"
    spark.createDataFrame([("c", "ego", 3) + (0.0,) * 8], tables.TICKS).write.parquet(str(tmp_path / "t"))
    assert round(tables.read_ticks(spark, str(tmp_path / "t")).first().time_s, 6) == 0.3


def test_one_json_document(spark, tmp_path):
    """Parts that are put one after the other are one JSON list in order, whatever their number; also for one row and none."""
    import json
    import random

    from pyspark.sql import functions as F

    from clipspans.operators import results

    def document(path):
        return "".join((path / n).read_text() for n in sorted(p.name for p in path.iterdir()) if n.startswith("part-"))

    r = random.Random(2)
    schema = "row_key string, line_no bigint, ok boolean, error string, parse_error string, evaluation map<string,string>"
    rows = [(None if i % 9 == 0 else f"k{r.randrange(90)}", i, r.random() < 0.5, None, None, {"a": f'],[{{"é\n,{i}'}) for i in range(400)]
    r.shuffle(rows)
    log = spark.createDataFrame(rows, schema)
    tables.finalize_document(log, str(tmp_path / "a"), str(tmp_path / "s"))
    got = json.loads(document(tmp_path / "a"))
    want = [json.loads(x.j) for x in results.compact_results(log).orderBy("position").select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).collect()]
    assert got == want and len(list((tmp_path / "a").glob("part-*"))) > 1
    back = tables.read_json_document(spark, str(tmp_path / "a"), schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, results.compact_results(log).drop("position").collect()))
    for n in (0, 1):
        tables.write_json_document(log.limit(n), str(tmp_path / f"n{n}"), ["line_no"], str(tmp_path / "s"))
        assert len(json.loads(document(tmp_path / f"n{n}"))) == n
        assert tables.read_json_document(spark, str(tmp_path / f"n{n}"), schema).count() == n
