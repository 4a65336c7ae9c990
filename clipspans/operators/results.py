"""The result log: done keys, compaction, limits, token counts, and scoring with an injected model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipspans.functions.text import kept_evaluation, parse_model_json, row_key, validate_scores


def completed() -> Column:
    return F.coalesce(F.col("ok") & F.col("error").isNull() & F.col("parse_error").isNull() & (F.size("evaluation") > 0), F.lit(False))


def done_keys(log: DataFrame) -> DataFrame:
    return log.where(completed() & F.col("row_key").isNotNull()).select("row_key").distinct()


def line_rank(columns: list[str]) -> Column:
    """The greater, the better a line of its key: completed ones first, then later ones; a hash decides between equal numbers."""
    return F.struct(completed().alias("c"), "line_no", F.xxhash64(F.to_json(F.struct(*[c for c in columns if c not in ("row_key", "line_no")]))).alias("h"))


def compact_results(log: DataFrame) -> DataFrame:
    """One row per key: a completed one before any other, else the latest line; of lines with equal numbers, one. Rows without a
    key all stay. ``position`` is the key's first line. Retries of one key are pre-aggregated by task, so a key with many lines
    isn't gathered whole."""
    keyed = log.where("row_key is not null")
    chosen = keyed.groupBy("row_key").agg(F.max_by(F.struct(*log.columns), line_rank(log.columns)).alias("r"), F.min("line_no").alias("position")).select("r.*", "position")
    return chosen.select(*log.columns, "position").unionByName(log.where("row_key is null").withColumn("position", F.col("line_no")).select(*log.columns, "position"))


def pending(labels: DataFrame, log: DataFrame, limit: int | None = None) -> DataFrame:
    """Labels without a completed result; with a limit, the first of them by row_index."""
    out = labels.join(done_keys(log), "row_key", "left_anti")
    return out if limit is None else out.orderBy("row_index").limit(limit)


def token_usage(results: DataFrame) -> DataFrame:
    return results.groupBy("model").agg(*[F.sum(c).alias(c) for c in ("prompt_tokens", "response_tokens", "reasoning_tokens")])


def echo_model(prompts: list[str]) -> list[str]:
    """Stands in for a model: an empty JSON object for every prompt."""
    return ["{}" for _ in prompts]


ANSWER = "response string, finish_reason string, max_tokens_used bigint"


def score_with(rows: DataFrame, model: Callable[[list[str]], list] = echo_model, prompt: str = "prompt", parallel: int | None = None) -> DataFrame:
    """Rows with response, finish_reason, max_tokens_used and api_error. An answer is a text, or a dict of the first three. A failing
    call marks its rows; it never fails the job. ``parallel`` bounds the calls at a time."""
    rows = rows if parallel is None else rows.repartition(parallel)
    names = [f.split()[0] for f in ANSWER.split(", ")]

    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            try:
                found = [a if isinstance(a, dict) else {"response": a} for a in model(batch.tolist())]
                if len(found) != len(batch):
                    raise ValueError(f"{len(found)} answers to {len(batch)} prompts")
                out = pd.DataFrame([[a.get(n) for n in names] + [None] for a in found], columns=[*names, "api_error"], index=batch.index)
            except Exception as problem:  # what a user's model raises is a result here
                out = pd.DataFrame({**dict.fromkeys(names), "api_error": f"api_error:{type(problem).__name__}:{problem}"}, index=batch.index)
            yield out.astype({n: "object" for n in out} | {"max_tokens_used": "Int64"})

    ask.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    call = F.pandas_udf(ask, f"{ANSWER}, api_error string")
    return rows.withColumn("_r", call(F.col(prompt))).select(*rows.columns, "_r.*")


def parse_responses(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Responses with evaluation, parse_error, ok and error."""
    parsed = rows.withColumn("_p", parse_model_json(F.col("response")))
    problem = validate_scores(F.col("_p.evaluation"), keys)
    return parsed.withColumns({
        "evaluation": kept_evaluation(F.col("_p.evaluation"), keys), "parse_error": F.coalesce(F.col("_p.parse_error"), problem), "error": F.col("api_error"),
        "ok": F.col("api_error").isNull() & F.col("_p.parse_error").isNull() & problem.isNull(),
    }).drop("_p")


def stage_run(labels: DataFrame, log: DataFrame, prompt: Column, keys: list[str], model: Callable = echo_model, limit: int | None = None, parallel: int | None = None) -> DataFrame:
    """One scoring stage: labels (row_index, clip_id, event_timestamp, ...) without a result yet, prompted, scored, parsed."""
    rows = labels.withColumn("row_key", row_key(F.col("clip_id"), F.col("event_timestamp"), F.col("row_index")))
    rows = pending(rows, log, limit).withColumn("prompt", prompt)
    return parse_responses(score_with(rows, model, parallel=parallel), keys)


def latest_first(log: DataFrame) -> DataFrame:
    """Log lines of each key, the newest first."""
    return log.withColumn("age", F.row_number().over(Window.partitionBy("row_key").orderBy(F.desc("line_no"))))
