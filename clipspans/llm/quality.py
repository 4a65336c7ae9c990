"""Quality classifier: naive Bayes features in a support vector machine.

A text becomes indicators of its n-grams: words, the shapes of tokens in a row (lower, capital or mixed case, number, the
sign itself), and how often each shape n-gram occurs (as a power-of-two share of the text). Every indicator is scaled by its
log-count ratio between the classes, and a linear hinge-loss model is fitted to the scaled vectors by dual coordinate
descent. Margins of rows that the model was not fitted on set a logistic curve that turns margins into scores.

Features are hashed into ``SIZE`` columns, so the model is one array of fixed size, whatever the corpus. It is fitted on
``MAX_LABELLED`` rows at most (labelled.py), which is what reaches the driver; scoring runs over all rows.

Defined results: null and empty texts have no features and score by the intercept; with labels of one class only, or none,
every score is the labels' mean (0.5 without labels); repeated and tied rows score alike.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipspans.llm.common import held_out, small_batches, stored, table
from clipspans.llm.labelled import logistic, sigmoid, training_rows

SIZE = 1 << 18
MAX_LABELLED = 8_000
EPOCHS, COST, FOLDS = 8, 0.1, 4

_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]{1,3}|_+|\n")


def _shape(token: str) -> str:
    if token.islower():
        return "a"
    if token.isupper():
        return "A" if len(token) > 1 else "I"
    return "0" if token.isdigit() else "Aa" if token.isalpha() else token


class Vector:
    """Turns texts into sorted column numbers. Columns of words already seen are kept, up to a fixed count."""

    def __init__(self, most: int = 200_000) -> None:
        self.words: dict[str, tuple[int, str]] = {}
        self.grams: dict[str, int] = {}
        self.most = most

    def word(self, token: str) -> tuple[int, str]:
        found = self.words.get(token)
        if found is None:
            if len(self.words) >= self.most:
                self.words.clear()
            found = self.words[token] = zlib.crc32(b"w" + token.lower().encode("utf-8", "surrogatepass")) % SIZE, _shape(token)
        return found

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = _TOKEN.findall(text or "")
        if not tokens:
            return np.zeros(0, np.int32)
        kinds = Counter(tokens)
        known = {t: self.word(t) for t in kinds}
        columns = {c for c, _ in known.values()}
        shapes = [known[t][1] for t in tokens]
        n = len(shapes)
        for count in (Counter(shapes), Counter(zip(shapes, shapes[1:])), Counter(zip(shapes, shapes[1:], shapes[2:]))):
            for gram, times in count.items():
                share = (times * 64 // n).bit_length()  # 0 below 1/64, 7 for all
                for name in (f"s{gram}", f"s{gram}{share}"):
                    column = self.grams.get(name)
                    if column is None:
                        if len(self.grams) >= self.most:
                            self.grams.clear()
                        column = self.grams[name] = zlib.crc32(name.encode("utf-8", "surrogatepass")) % SIZE
                    columns.add(column)
        return np.sort(np.fromiter(columns, np.int32, len(columns)))


def ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Log-count ratio of each column, smoothed by one."""
    total = []
    for label in (1, 0):
        own = [r for r, k in zip(rows, y) if k == label]
        p = 1.0 + np.bincount(np.concatenate(own) if own else np.zeros(0, int), minlength=SIZE)
        total.append(np.log(p / p.sum()))
    return total[0] - total[1]


def descend(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, epochs: int = EPOCHS, cost: float = COST, seed: int = 0) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; rows are indicator columns times scale, brought to length 1."""
    values = [scale[r] / max(np.sqrt((scale[r] ** 2).sum()), 1e-9) for r in rows]
    sign, w, bias, alpha = np.where(y == 1, 1.0, -1.0), np.zeros(SIZE), 0.0, np.zeros(len(rows))
    bound = cost * np.where(y == 1, len(y) / (2 * max(1, (y == 1).sum())), len(y) / (2 * max(1, (y == 0).sum())))
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            r, v = rows[i], values[i]
            gradient = sign[i] * (v @ w[r] + bias) - 1
            new = min(max(alpha[i] - gradient / 2, 0.0), bound[i])  # the row and its constant column have length 1 each
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[r] += step * v
                bias += step
                alpha[i] = new
    return w, bias


@dataclass
class Model:
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.array([self.weights[r] @ self.scale[r] / max(np.sqrt((self.scale[r] ** 2).sum()), 1e-9) + self.bias for r in rows])

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return sigmoid(self.slope * self.margins(rows) + self.shift)


def fit_rows(rows: list[np.ndarray], y: np.ndarray) -> Model:
    if len(set(y.tolist())) < 2:
        p = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
        return Model(np.ones(SIZE), np.zeros(SIZE), 0.0, 0.0, float(np.log(p / (1 - p))))

    def one(keep: np.ndarray) -> Model:
        own, label = [rows[i] for i in np.flatnonzero(keep)], y[keep]
        scale = ratios(own, label)
        return Model(scale, *descend(own, label, scale), 1.0, 0.0)

    fold = np.arange(len(rows)) % FOLDS
    margins = np.zeros(len(rows))
    for k in range(FOLDS):  # margins of rows that the model hasn't seen
        if len(set(y[fold != k].tolist())) == 2:
            margins[fold == k] = one(fold != k).margins([rows[i] for i in np.flatnonzero(fold == k)])
    model = one(np.ones(len(rows), bool))
    model.slope, model.shift = (float(v) for v in logistic(margins[:, None], y))
    return model


def fit(rows: DataFrame) -> Model:
    """rows: (doc_id, text, y), MAX_LABELLED at most."""

    @F.pandas_udf("array<int>")
    def columns(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vector = Vector()
        for batch in texts:
            yield pd.Series([vector(t) for t in batch])

    with small_batches(rows.sparkSession):
        found = rows.select("doc_id", "y", columns("text").alias("x")).toPandas().sort_values("doc_id", ignore_index=True)
    return fit_rows([np.asarray(x, np.int32) for x in found["x"]], found["y"].to_numpy())


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with score in place of text."""
    given = rows.sparkSession.sparkContext.broadcast(model)  # three arrays of SIZE numbers at most

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vector, own = Vector(), given.value
        for batch in texts:
            yield pd.Series(own.scores([vector(t) for t in batch]), dtype="float64")

    return rows.select(*[c for c in rows.columns if c != "text"], scored("text").alias("score"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fit(training_rows(spark, sf_dir, "quality", MAX_LABELLED))
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    with small_batches(spark):
        return stored(score(docs, model).withColumn("predicted", (F.col("score") >= 0.3).cast("int")))
