"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lower-cases, undoes look-alike and accented letters, and turns digits and signs in a word into the letters they stand for.
The lexicon is learned from labelled rows: a word, or a word's beginning, enters when its log odds of toxic against other
rows are above ``MIN_WEIGHT`` and certain enough; the log odds are its weight. Of terms that begin one another the more certain
one enters, so a word matches one term at most. A phrase of a word that has a term and a neighbour that occurs mostly in
other rows is an exception: occurrences inside it don't count. A text's score is a logistic function of its summed
weights, alone and by length.

Defined results: null, empty and wordless texts have no matches and the lowest score; with no labelled rows, or labels of
one class only, the lexicon is empty and every score is the labels' mean (0 without labels). Rows keep their order,
repeats and columns in ``reject``.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipspans.llm.common import column, held_out, located, locator, small_batches, stored, table, without
from clipspans.llm.labelled import logistic, sigmoid, training_rows

MIN_WEIGHT = 2.0
#: Standard errors that a term's log odds must be above zero: the number that predicts best is taken, by folds of the labelled rows.
CERTAINTIES, FOLDS = (2.0, 2.5, 3.0, 3.5, 4.0, 5.0), 4
#: Lengths of words' beginnings that can be terms.
BEGINNINGS = (5, 6, 7, 8)
FLUSH = 200_000

# fixed values: letters that look like Latin ones
LOOK_ALIKE = dict(zip("абвгеёзиіїјкмнопрстухсѕԁһԛԝүαβγεηικμνορτυχωıłøđ", "abvreeзиiijkmнonpctyxcsdhqwyabyenikmvoptuxwilod"))
# fixed values: capitals that look like other Latin letters than their small forms
LOOK_ALIKE_CAPITALS = dict(zip("ВНУХРСΝΡΧΥΗ", "bhyxpcnpxyh"))
# fixed values: digits and signs used for letters
DIGITS = dict(zip("0134578@$!", "oieastbasi"))

_TABLE = str.maketrans(LOOK_ALIKE | {chr(0xFF41 + i): chr(97 + i) for i in range(26)} | {"​": None, "‌": None, "‍": None, "­": None, "﻿": None})
_DIGIT = re.compile(r"(?<![^\W_])[0134578@$!]+(?=[^\W\d_])|(?<=[^\W\d_])[0134578@$!]+(?=[^\W\d_])|(?<=[^\W\d_])(?:[0134578]+|[@$]{1,2})(?![\w@$])")
_DIGIT_TABLE = str.maketrans(DIGITS)
_HAS_DIGIT = re.compile(r"[0134578@$!]")
_WORD = re.compile(r"[^\W_]+")
_MARKS = re.compile("[\u0300-\u036f]+")
LOOK_ALIKE_TABLE = str.maketrans(LOOK_ALIKE_CAPITALS)


def fold(text: str | None) -> list[str]:
    """The folded words of a text."""
    text = text or ""
    if text.isascii():
        text = text.lower()
    else:
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text.translate(LOOK_ALIKE_TABLE).lower().translate(_TABLE)))
    if _HAS_DIGIT.search(text):
        text = _DIGIT.sub(lambda m: m[0].translate(_DIGIT_TABLE), text)
    return _WORD.findall(text)


@dataclass
class Model:
    """Terms are words with a space behind, or words' beginnings."""

    lexicon: dict[str, float]
    exceptions: set[str] = field(default_factory=set)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))

    def automaton(self) -> ahocorasick.Automaton | None:
        """Terms and exception phrases behind a space; the value is (length, weight), weight 0 for an exception."""
        found = ahocorasick.Automaton()
        for term, weight in self.lexicon.items():
            found.add_word(f" {term}", (len(term), weight))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 1, 0.0))
        found.make_automaton()
        return found if len(found) else None


def features(words: list[str], automaton: ahocorasick.Automaton | None) -> tuple[float, float, float]:
    """Any match, log of the summed weights, and summed weights by the root of the length. Matches come in order of their end, so that
    each one's exceptions are looked up, in as much time as there are matches."""
    if automaton is None or not words:
        return 0.0, 0.0, 0.0
    terms, ends, starts = [], [], []
    for end, (length, weight) in automaton.iter(f" {' '.join(words)} "):
        if weight:
            terms.append((end - length + 1, end, weight))
        else:
            ends.append(end)
            starts.append(end - length + 1)
    if not ends:
        return _measure(sum(w for _, _, w in terms), len(words))
    # an exception holds a match if one that ends no earlier begins no later
    first = np.minimum.accumulate(np.array(starts)[::-1])[::-1].tolist() + [math.inf]
    total, i = 0.0, 0
    for a, b, weight in terms:
        while i < len(ends) and ends[i] < b:
            i += 1
        if first[i] > a:
            total += weight
    return _measure(total, len(words))


def _measure(total: float, words: int) -> tuple[float, float, float]:
    return float(total > 0), math.log1p(total), total / math.sqrt(max(1, words))


def word_terms(word: str) -> list[str]:
    """What of a word can be a term: the whole, with a space behind, and its beginnings."""
    return [f"{word} ", *[word[:n] for n in BEGINNINGS if n < len(word)]]


def choose(candidates: dict[str, tuple[float, float]]) -> dict[str, float]:
    """The terms (certainty, weight) of which none begins another: the more certain ones, with their weights."""
    chosen: dict[str, float] = {}
    begun: set[str] = set()  # beginnings of chosen terms
    for term, (_, weight) in sorted(candidates.items(), key=lambda x: (-x[1][0], x[0])):
        starts = [term[:n] for n in range(1, len(term))]
        if term not in begun and not any(s in chosen for s in starts):
            chosen[term] = weight
            begun.update(starts)
    return chosen


def _fold() -> Column:
    return F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int")


def _counts(rows: DataFrame, pieces: Callable[[str], set[str]]) -> DataFrame:
    """(term, toxic, other): rows of each kind and fold that have the term, as arrays by fold. Each task counts before anything is shuffled."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def out() -> pd.DataFrame:
            found = [(t, y, f, n) for (t, y, f), n in seen.items()]
            seen.clear()
            return pd.DataFrame(found, columns=["term", "y", "fold", "n"])

        for batch in batches:
            for text, y, f in zip(batch["text"], batch["y"], batch["fold"]):
                seen.update((t, y, f) for t in pieces(text))
                if len(seen) > FLUSH:
                    yield out()
        yield out()

    found = rows.select("text", "y", _fold().alias("fold")).mapInPandas(count, "term string, y int, fold int, n bigint")
    by_fold = lambda y: F.array(*[F.sum(F.when((F.col("y") == y) & (F.col("fold") == k), F.col("n")).otherwise(0)) for k in range(FOLDS)])
    return found.groupBy("term").agg(by_fold(1).alias("toxic"), by_fold(0).alias("other"))


def log_odds(toxic: float, other: float, n1: int, n0: int) -> tuple[float, float]:
    """Log odds of toxic against other rows, smoothed, and their standard error."""
    a, b = toxic + 0.5, other + 0.5
    return math.log(a / (n1 + 1)) - math.log(b / (n0 + 1)), math.sqrt(1 / a + 1 / b)


def lexicon(terms: dict[str, tuple[float, float]], n1: int, n0: int, certainty: float) -> dict[str, float]:
    """Of terms (toxic, other rows) the chosen ones that are toxic and certain enough, with their weights."""
    counts = np.array(list(terms.values()), float).reshape(-1, 2)
    return _lexicon(list(terms), *_odds(counts[:, 0], counts[:, 1], n1, n0), certainty)


def _odds(toxic: np.ndarray, other: np.ndarray, n1: int, n0: int) -> tuple[np.ndarray, np.ndarray]:
    """``log_odds`` of many terms."""
    a, b = toxic + 0.5, other + 0.5
    return np.log(a / (n1 + 1)) - np.log(b / (n0 + 1)), np.sqrt(1 / a + 1 / b)


def _lexicon(names: list[str], weight: np.ndarray, error: np.ndarray, certainty: float) -> dict[str, float]:
    good = np.flatnonzero((weight >= MIN_WEIGHT) & (weight > certainty * error)).tolist()
    return choose({names[i]: (float(weight[i] - certainty * error[i]), float(weight[i])) for i in good})


def _tune(sample: pd.DataFrame, names: list[str], toxic: np.ndarray, other: np.ndarray) -> tuple[float, np.ndarray]:
    """The certainty that predicts rows best with terms of the other folds, and the logistic weights of these predictions.

    sample: (y, fold, n, terms), n words and the numbers of ``names`` that a row has, with repeats; toxic, other: counts of each
    name by fold."""
    y, fold, n = sample["y"].to_numpy(), sample["fold"].to_numpy(), sample["n"].to_numpy()
    # rows' terms one after the other
    size = np.array([len(t) for t in sample["terms"]], np.int64)
    owner = np.repeat(np.arange(len(y)), size)
    flat = np.concatenate([np.asarray(t, np.int64) for t in sample["terms"]]) if size.sum() else np.zeros(0, np.int64)
    place = {t: i for i, t in enumerate(names)}
    odds = []
    for k in range(FOLDS):
        rest = fold != k
        odds.append(_odds(toxic.sum(axis=1) - toxic[:, k], other.sum(axis=1) - other[:, k], int((y[rest] == 1).sum()), int((y[rest] == 0).sum())))
    best = (math.inf, CERTAINTIES[0], np.zeros(4))
    for certainty in CERTAINTIES:
        total = np.zeros(len(y))
        for k in range(FOLDS):
            weights = np.zeros(len(names))
            for term, weight in _lexicon(names, *odds[k], certainty).items():
                weights[place[term]] = weight
            own = fold == k
            total[own] = np.bincount(owner, weights[flat], len(y))[own]
        x = np.column_stack([total > 0, np.log1p(total), total / np.sqrt(np.maximum(1, n))]).astype(float)
        weights = logistic(x, y)
        p = np.clip(sigmoid(np.column_stack([x, np.ones(len(x))]) @ weights), 1e-9, 1 - 1e-9)
        loss = -float((y * np.log(p) + (1 - y) * np.log(1 - p)).mean())
        if loss < best[0]:
            best = (loss, certainty, weights)
    return best[1], best[2]


def fit(rows: DataFrame) -> Model:
    """rows: (text, y), a bounded sample (labelled.py). The driver gets its certain terms and exceptions, and each row's terms."""
    size = {(r["y"], r["fold"]): r["n"] for r in rows.groupBy("y", _fold().alias("fold")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = (sum(size.get((y, k), 0) for k in range(FOLDS)) for y in (1, 0))
    if not n1 or not n0:
        p = min(max(n1 / max(1, n0 + n1), 1e-6), 1 - 1e-6)
        return Model({}, set(), np.array([0, 0, 0, math.log(p / (1 - p))]))

    def odds(without: int | None) -> tuple[Column, Column]:
        """Log odds of a term in all rows, or in those of the other folds, and their standard error."""
        a, b = (sum((F.col(c)[k] for k in range(FOLDS) if k != without), F.lit(0.5)) for c in ("toxic", "other"))
        m1, m0 = n1 - size.get((1, without), 0), n0 - size.get((0, without), 0)
        return F.log(a / (m1 + 1)) - F.log(b / (m0 + 1)), F.sqrt(1 / a + 1 / b)

    with small_batches(rows.sparkSession):
        # all terms that could enter, by all rows or by any three folds: what a fold's own rows say mustn't choose its terms
        certain = F.lit(False)
        for k in (None, *range(FOLDS)):
            weight, error = odds(k)
            certain = certain | ((weight >= MIN_WEIGHT) & (weight > CERTAINTIES[0] * error))
        found = _counts(rows, lambda t: {x for w in set(fold(t)) for x in word_terms(w)}).where(certain).collect()
        names = [r["term"] for r in found]
        toxic, other = (np.array([r[c] for r in found], float).reshape(-1, FOLDS) for c in ("toxic", "other"))
        given = rows.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(names)})  # learned from a bounded sample

        @F.pandas_udf("n int, terms array<int>")
        def terms(texts: pd.Series) -> pd.DataFrame:
            words, place = [fold(t) for t in texts], given.value
            return pd.DataFrame({"n": [len(w) for w in words], "terms": [[place[x] for one in w for x in word_terms(one) if x in place] for w in words]})

        sample = rows.select("y", _fold().alias("fold"), terms("text").alias("t")).select("y", "fold", "t.*").toPandas()
        certainty, weights = _tune(sample, names, toxic, other)
        chosen = _lexicon(names, *_odds(toxic.sum(axis=1), other.sum(axis=1), n1, n0), certainty)

        def phrases(text: str) -> set[str]:
            words = fold(text)
            known = {w for w in set(words) if any(t in chosen for t in word_terms(w))}
            return {f"{x} {y}" for x, y in zip(words, words[1:]) if x in known or y in known}

        rest = sum((F.col("other")[k] for k in range(FOLDS)), F.lit(0))
        benign = _counts(rows, phrases).where((rest >= 5) & (odds(None)[0] < 0)).select("term")
        return Model(chosen, {r["term"] for r in benign.collect()}, weights)


def measured(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with f0, f1, f2 in place of text."""
    given = rows.sparkSession.sparkContext.broadcast((model.lexicon, model.exceptions))  # learned from a bounded sample
    rest = [c for c in rows.columns if c != "text"]

    @F.pandas_udf("f0 double, f1 double, f2 double")
    def measure(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = Model(*given.value).automaton()
        for batch in texts:
            yield pd.DataFrame([features(fold(t), automaton) for t in batch], columns=["f0", "f1", "f2"], dtype="float64")

    return rows.select(*rest, measure("text").alias("f")).select(*rest, "f.*")


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with score in place of text."""
    rest = [c for c in rows.columns if c != "text"]
    w = [float(x) for x in model.weights]
    z = F.col("f0") * w[0] + F.col("f1") * w[1] + F.col("f2") * w[2] + w[3]
    return measured(rows, model).select(*rest, (1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), z))))).alias("score"))


def reject(docs: DataFrame, model: Model, text: str = "text", above: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``above``, with all columns."""
    docs = located(docs)
    scored = score(docs.select(*locator(docs), column(text).alias("text")), model)
    with small_batches(docs.sparkSession):
        return without(docs, scored.where(F.col("score") >= above))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fit(training_rows(spark, sf_dir, "toxic"))
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    with small_batches(spark):
        return stored(score(docs, model).withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
