"""Plain files by clip: many clips in few parts."""

from pathlib import Path

from pyarrow import fs
from pyspark.sql import functions as F

from clipspans.sources import archives, tables


def test_folders_below_a_path_are_few(spark, tmp_path):
    lines = spark.range(0, 5000, 1, 3).select(F.concat(F.lit("clip_"), (F.col("id") % 2500).cast("string")).alias("clip_id"), F.floor(F.col("id") / 2500).cast("int").alias("line_no"))
    lines = lines.withColumn("line", F.concat(F.lit("Stop - Agent:<ego>, Start:"), F.substring("clip_id", 6, 9), F.lit(", End:"), F.col("line_no").cast("string")))
    path = str(tmp_path / "text")
    tables.write_label_text(lines, path)
    assert 3 <= len(list(Path(path).iterdir())) < 12  # one for each clip before
    assert all(len(list(p.iterdir())) <= archives.FOLDER for p in Path(path).iterdir())
    want = sorted((f"clip_{i}", k, "Stop", i, k) for i in range(2500) for k in range(2))
    assert sorted(tuple(r) for r in tables.read_label_text(spark, path).collect()) == want
    tags = lines.select("clip_id", F.col("line_no").alias("ord"), F.lit("StopTemporal(ego at 0-3)").alias("tag"))
    tables.write_raw_tags(tags, str(tmp_path / "tags"))
    assert len(list((tmp_path / "tags").iterdir())) < 12
    assert sorted((r.clip_id, r.ord, r.parsed.end) for r in tables.read_raw_tags(spark, str(tmp_path / "tags")).collect()) == [(c, k, 3) for c, k, *_ in want]


def test_names_and_emptiness(spark, tmp_path):
    names = ["a/b", "x=1:2", "50%", "ä b", "..", None]
    tags = spark.createDataFrame([(n, 0, "StopTemporal(ego at 0-3)") for n in names], "clip_id string, ord int, tag string")
    tables.write_raw_tags(tags, str(tmp_path / "some"))
    assert {r.clip_id for r in tables.read_raw_tags(spark, str(tmp_path / "some")).collect()} == set(names)
    tables.write_raw_tags(tags.where("false"), str(tmp_path / "none"))
    assert tables.read_raw_tags(spark, str(tmp_path / "none")).count() == 0


def test_parts_move_by_file_where_folders_cannot(tmp_path):
    (tmp_path / "_job/part=p1/clip_id=a").mkdir(parents=True)
    (tmp_path / "_job/part=p1/clip_id=a/1.txt").write_text("x")
    store = fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem())
    archives.FileWriter({"path": "unused"}, False)._move(store, "_job/part=p1", "part=p1")
    assert (tmp_path / "part=p1/clip_id=a/1.txt").read_text() == "x" and not (tmp_path / "_job/part=p1/clip_id=a/1.txt").exists()
