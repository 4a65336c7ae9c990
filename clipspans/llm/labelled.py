"""What the two learned scorers share: the labelled sample, and a logistic fit of few columns."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipspans.llm.common import held_out, locator, stored, table

#: Labelled rows that a model is fitted on at most, those with the least hashes of their id; all are used if there are fewer. The bound
#: holds for the documents too, where several have one id.
MAX_LABELLED = 12_000


def training_rows(spark: SparkSession, sf_dir: str, label: str, most: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text, y) of the labelled rows that may be learned from, ``most`` at most, which is also the most that is broadcast. Equal
    labels of one id count once; differing ones count each."""
    labels = table(spark, sf_dir, "labels").where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    order = [F.xxhash64("doc_id"), "doc_id", "y"]
    sample = labels.select("doc_id", F.col(label).cast("int").alias("y")).distinct().orderBy(*order).limit(most)
    docs = table(spark, sf_dir, "documents")
    chosen = docs.select("doc_id", *locator(docs)).join(F.broadcast(sample), "doc_id").orderBy(*order, "file", "row").limit(most)
    texts = docs.select(*locator(docs), "text").join(F.broadcast(chosen), ["file", "row"])
    return stored(texts.select("doc_id", "text", "y"))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights, the intercept last, by Newton's method with a small ridge."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
