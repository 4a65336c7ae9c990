"""Rows chosen by file and row number: any number of them, with no text shuffled."""

import random
import re

import pytest
from pyspark.sql import functions as F

from clipspans.llm import common, decontaminate, exact_dedup


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("located") / "docs")
    spark.range(0, 90_000, 1, 6).selectExpr("id as doc_id", "concat('text ', id) as text", "id % 7 as bits", "'x' as row").write.parquet(folder)
    return spark.read.parquet(folder)


def shuffles(df):
    return re.findall(r"Exchange (?:hashpart|rangepart|RoundRobin|SinglePart)\w*", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("share,max_bitmaps", [(0, 100), (0.0005, 100), (0.3, 100), (0.3, 1), (1, 2)])
def test_chosen_rows(spark, docs, share, max_bitmaps):
    """Also where bitmaps take several scans; repeated choices count once."""
    every = docs.select("doc_id", *common.locator(docs, "file", "at")).toDF("doc_id", "file", "row")
    chosen = every.where(F.rand(3) < share) if 0 < share < 1 else every.where(F.lit(share == 1))
    chosen = common.stored(chosen)
    ids = {r.doc_id for r in chosen.select("doc_id").collect()}
    rows = chosen.select("file", "row").unionByName(chosen.select("file", "row").limit(50))
    rest = common.without(docs, rows, max_bitmaps)
    assert rest.columns == docs.columns and shuffles(rest) == []
    got = rest.collect()
    assert {r.doc_id for r in got} == set(range(90_000)) - ids and len(got) == 90_000 - len(ids)
    assert all(r.text == f"text {r.doc_id}" and r.bits == r.doc_id % 7 and r.row == "x" for r in got[:50])
    inside = common.within(docs.select("doc_id", "text"), rows, max_bitmaps)
    assert shuffles(inside) == [] and sorted(r.doc_id for r in inside.collect()) == sorted(ids)
    assert inside.columns == ["doc_id", "text", "file", "row"]
    there = {(r.doc_id, r.file, r.row) for r in inside.collect()}
    assert there == {tuple(r) for r in chosen.select("doc_id", "file", "row").collect()}


def test_each_scan_reads_its_own_files(spark, docs):
    every = common.stored(docs.select(*common.locator(docs)))
    df = common.without(docs, every.where("row % 2 = 0"), 1)
    assert df.count() == 45_000 and df._jdf.queryExecution().executedPlan().toString().count("Scan parquet") >= 6
    one = docs.where(F.pmod(F.xxhash64(common.locator(docs)[0]), F.lit(6)) == 0)
    assert one.rdd.getNumPartitions() < docs.rdd.getNumPartitions()


def test_hot_digest_and_many_hits(spark):
    """One text in half of all rows, with a limit that it passes, and the rest in pairs."""
    rows = [(i, "the same" if i % 2 else f"text {i // 4}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    before = exact_dedup.HOT
    exact_dedup.HOT = 100
    try:
        got = {r.id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.classes(docs).collect()}
    finally:
        exact_dedup.HOT = before
    groups = {}
    for i, t in rows:
        groups.setdefault(t, []).append(i)
    assert got == {i: (max(g), len(g), i == max(g)) for g in groups.values() for i in g}
    assert {r.doc_id for r in exact_dedup.deduplicate(docs).collect()} == {max(g) for g in groups.values()}


def test_hits_keep_every_row(spark):
    docs = spark.createDataFrame([(i, "one two three" if i % 3 == 0 else f"clean {i}", i) for i in range(300)], "doc_id bigint, text string, file int")
    bench = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    got = decontaminate.hits(docs, bench)
    assert got.columns == ["row", "n_words", "n_hit", "items", "spans"]
    assert {r.row.doc_id: (r.n_hit, r["items"], r.row.file) for r in got.collect()} == {i: ((3, ["1"], i) if i % 3 == 0 else (0, [], i)) for i in range(300)}
    assert decontaminate.clean_documents(docs, bench).count() == 200
