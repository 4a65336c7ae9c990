"""Segments of token files are of nearly equal sizes, and none is short beside a long one."""

import pytest
from pyspark.sql import functions as F

from clipspans.llm import token_files


def test_the_rest_of_a_task_joins_its_segment(spark, tmp_path):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for name, rows, segments in (("a", 1250, 1), ("b", 1900, 2)):  # 11.5 MB were two segments before
            docs = spark.range(rows).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("word "), (F.col("id") % 7).cast("string"), F.lit(" ab, ")), 840).alias("text"))
            path = str(tmp_path / name)
            token_files.write(docs, path, tokenizer)
            files = spark.read.parquet(path).select("seq", F.size("ids").alias("n")).orderBy("seq").collect()
            assert [r.seq for r in files] == list(range(segments)) and sum(r.n for r in files) == rows
            got = token_files.read(spark, path).select("id", "start", "n_tokens", F.crc32(F.to_json("tokens")).alias("c")).orderBy("id").collect()
            assert [r.id for r in got] == list(range(rows)) and [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(rows)]
            assert len({r.c for r in got}) == 7 and all(r.c == got[r.id % 7].c for r in got)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_groups_of_blocks():
    for n in (0, 1, 31, 32, 33, 48, 65):
        groups = token_files.side_by_side(list(range(n)))
        assert [b for g in groups for b in g] == list(range(n)) and len(groups) == -(-n // token_files.LANES)
        assert not groups or max(map(len, groups)) - min(map(len, groups)) <= 1
