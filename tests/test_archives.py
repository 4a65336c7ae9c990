"""Archives as a data source."""

import io
import os
import zipfile

import pandas as pd
import pytest

from clipspans.sources import archives, tables


def zipped(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in members.items():
            z.writestr(name, content)


def test_one_archive_on_all_cores(spark, tmp_path):
    """200 members of one archive are dealt out by size, and none is read twice."""
    zipped(f"{tmp_path}/a.zip", {f"x/c{i}.json": str(i) * 1000 for i in range(200)} | {"x/": "", "x/other.txt": "t"})
    df = archives.read_archives(spark, str(tmp_path), suffix=".json", partitionBytes="20000")
    assert df.rdd.getNumPartitions() >= 20
    got = df.collect()
    assert sorted(r.clip_id for r in got) == sorted(f"c{i}" for i in range(200)) and all(bytes(r.content).decode() == r.clip_id[1:] * 1000 and r.size == len(r.content) for r in got)
    assert archives.read_archives(spark, f"{tmp_path}/a.zip").count() == 201


def test_only_named_columns(spark, tmp_path):
    """A directory can be read where contents can't: they aren't touched without their column."""
    zipped(f"{tmp_path}/a.zip", {"c1.json": "x" * 5000})
    with open(f"{tmp_path}/a.zip", "r+b") as f:
        f.seek(45)
        f.write(b"\xff" * 8)
    assert [tuple(r) for r in archives.read_archives(spark, str(tmp_path), "clip_id string, size bigint", suffix=".json").collect()] == [("c1", 5000)]
    with pytest.raises(Exception):
        archives.read_archives(spark, str(tmp_path)).collect()
    file = io.BytesIO()
    pd.DataFrame({"x": [1.0, 2.0], "y": [3.0, 4.0]}).to_parquet(file, index=False)
    os.makedirs(f"{tmp_path}/t")
    zipped(f"{tmp_path}/t/b.zip", {"deep/c9.egomotion.parquet": file.getvalue()})
    got = tables.read_zipped_ticks(spark, f"{tmp_path}/t", ["clip_id", "tick", "y"])
    assert got.columns == ["clip_id", "tick", "y"] and [tuple(r) for r in got.orderBy("tick").collect()] == [("c9", 0, 3.0), ("c9", 1, 4.0)]
    assert [tuple(r) for r in tables.read_zipped_ticks(spark, f"{tmp_path}/t", ["agent_id", "vx"]).collect()] == [("ego", None)] * 2


def test_written_archives(spark, tmp_path):
    """Few archives for many clips, with nothing left beside them; more can be added, or put in their place."""
    path = f"{tmp_path}/out"
    rows = [(f"c{i}", f"text {i} é".encode()) for i in range(300)]
    df = spark.createDataFrame(rows, "clip_id string, content binary")
    archives.write_archives(df.repartition(3), path, ".txt")
    assert len(os.listdir(path)) == 3 and all(n.endswith(".zip") for n in os.listdir(path))
    read = lambda: sorted((r.clip_id, bytes(r.content)) for r in archives.read_archives(spark, path, suffix=".txt").collect())
    assert read() == sorted(rows)
    archives.write_archives(spark.createDataFrame([("new", "as text")], "clip_id string, content string"), path, ".txt")
    assert len(read()) == 301
    archives.write_archives(df.limit(10).coalesce(1), path, ".txt", mode="overwrite")
    assert len(read()) == 10 and len(os.listdir(path)) == 1
    archives.write_archives(df.limit(0), f"{tmp_path}/none", ".txt")
    assert archives.read_archives(spark, f"{tmp_path}/none").count() == 0
    with pytest.raises(Exception):
        archives.read_archives(spark, f"{tmp_path}/missing").collect()


def test_a_failed_job_shows_nothing(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.range(100).select(F.col("id").cast("string").alias("clip_id"), F.when(F.col("id") == 99, F.raise_error(F.lit("no"))).otherwise(F.lit("x").cast("binary")).alias("content"))
    with pytest.raises(Exception):
        archives.write_archives(df, f"{tmp_path}/out", ".txt")
    # a task that ends after the job was given up can leave its hidden folder, which no reader looks at
    os.makedirs(f"{tmp_path}/out", exist_ok=True)
    assert all(n.startswith("_") for n in os.listdir(f"{tmp_path}/out")) and archives.read_archives(spark, f"{tmp_path}/out").count() == 0


def test_packed_tags_and_texts(spark, tmp_path):
    tags = spark.createDataFrame([(f"c{i % 7}", i, f"Stop(ego at {i}-{i + 3})") for i in range(50)], "clip_id string, ord int, tag string")
    tables.write_packed_tags(tags, f"{tmp_path}/tags")
    assert len(os.listdir(f"{tmp_path}/tags")) <= 4
    got = sorted((r.clip_id, r.tag, r.parsed.start) for r in tables.read_packed_tags(spark, f"{tmp_path}/tags").collect())
    assert got == sorted((f"c{i % 7}", f"Stop(ego at {i}-{i + 3})", i) for i in range(50))
    lines = spark.createDataFrame([("c", 0, "  Stop - Agent:<ego>, Start:1, End:5"), ("c", 1, "other")], "clip_id string, line_no int, line string")
    tables.write_packed_label_text(lines, f"{tmp_path}/text")
    assert [tuple(r) for r in tables.read_packed_label_text(spark, f"{tmp_path}/text").collect()] == [("c", 0, "Stop", 1, 5)]
