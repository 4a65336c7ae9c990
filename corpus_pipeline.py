"""A training-corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns the documents that stay, with the columns of ``documents``; the last one
adds the token ids of each text and whether they decode to it exactly. Between stages the documents are written as Parquet
in the shared folder and read again, so a lost executor costs a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clipspans.llm import decontaminate, exact_dedup, sentencepiece_unigram, simhash, toxicity
from clipspans.llm.common import small_batches, stored, table
from clipspans.llm.labelled import training_rows


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, toxicity.fit(training_rows(spark, sf_dir, "toxic")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def with_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with small_batches(spark):
        return stored(sentencepiece_unigram.encode_and_check(docs, sentencepiece_unigram.default_model()))


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("simhash", without_near_copies),
    ("decontaminate", without_benchmark),
    ("sentencepiece", with_tokens),
]

#: SQL can express neither fingerprint links nor the token ids; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
