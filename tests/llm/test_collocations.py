"""Collocations against plain counts."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clipspans.llm import collocations
from clipspans.llm.common import UPPER

SCHEMA = "doc_id bigint, text string, lang string"


def plain_counts(rows):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate(str.maketrans(UPPER, UPPER.lower()))
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    return f, n


def plain(rows, least, top):
    f, n = plain_counts(rows)
    found = defaultdict(list)
    for key, a in f.items():
        lang, words = key[0], key[1:]
        if len(words) < 2 or a < least:
            continue
        longer = [x for w in {k[1] for k in f if k[0] == lang and len(k) == 2} for x in ((lang, *words, w), (lang, w, *words))] if len(words) == 2 else []
        if any(f[x] >= least and 100 * f[x] >= 50 * a for x in longer):
            continue
        cuts = [(1000000 * a * a // (f[(lang, *words[:k])] * f[(lang, *words[k:])]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(words).encode(), f[(lang, *words[:k])], f[(lang, *words[k:])]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -score) for lang, rows in found.items() for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top]))


def drawn(seed, docs=150):
    r = random.Random(seed)
    words = ["a", "B", "b", "new", "york", "city", "é", "\x00", "x\xa0y", *[f"rare{i}" for i in range(60)]]
    text = lambda: "".join(r.choice(words) + r.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", "\x0b"]) for _ in range(r.choice([0, 1, 5, 40])))
    rows = [(i, r.choice([text(), text(), "New York city", None]), r.choice(["en", "fr", None, "und"])) for i in range(docs)]
    return rows + rows[:20]


@pytest.mark.parametrize("shards", [1, 3, 4])
def test_equals_plain_counts(spark, shards):
    """In any number of shards."""
    rows = drawn(shards)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    f, _ = plain_counts(rows)
    got = {(r["lang"], *r["phrase"].split(" ")): r["c"] for r in collocations.phrase_counts(docs, least=4, shards=shards).collect() if r["n"]}
    assert all(f[k] == c for k, c in got.items())
    assert {k for k, c in f.items() if c >= 4} <= got.keys()
    # few of those without the threshold are counted by name
    assert len(got) < 0.6 * len(f)
    found = collocations.collocations(docs, least=4, top=25, shards=shards)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, 4, 25)


def test_collisions_change_no_count():
    """Where all slots are active at once, or from one stop on, every phrase's passes make one whole cycle."""
    rows = drawn(9, 60)
    f, _ = plain_counts(rows)
    texts = [(t or "").translate(str.maketrans(UPPER, UPPER.lower())) for _, t, _ in rows]
    langs = ["und" if x is None else x for _, _, x in rows]
    for stops in ((0, 0, 0), (1, 1, 1), (2, 3, 5), (3, 6, 9)):
        act = [np.full(collocations.SLOTS, s, np.uint8) for s in stops]
        got = Counter()
        for at in range(12):
            own = [i for i in range(len(rows)) if i % 3 == at % 3]
            named, _ = collocations.count_block(pa.array([texts[i] for i in own]), [langs[i] for i in own], act, at, 3)
            for n, lang, phrase, c in named:
                if n:
                    for key, x, k in zip(lang.to_pylist(), phrase.to_pylist(), c.tolist()):
                        got[(key, *x.split(" "))] += k
        assert got == f


def test_slots_older_than_the_parts_of_a_phrase_change_no_count():
    """Where another phrase made a pair's or triple's slot active before its own words or pairs are, it still goes through one whole cycle."""
    rows = drawn(11, 60)
    f, _ = plain_counts(rows)
    texts = [(t or "").translate(str.maketrans(UPPER, UPPER.lower())) for _, t, _ in rows]
    langs = ["und" if x is None else x for _, _, x in rows]
    for stops in ((2, 1, 1), (3, 4, 2), (3, 1, 5)):
        got = Counter()
        for at in range(12):
            # a stop is known from its pass on
            act = [np.full(collocations.SLOTS, s if s <= at else collocations.NEVER, np.uint8) for s in stops]
            own = [i for i in range(len(rows)) if i % 3 == at % 3]
            named, _ = collocations.count_block(pa.array([texts[i] for i in own]), [langs[i] for i in own], act, at, 3)
            for n, lang, phrase, c in named:
                if n:
                    for key, x, k in zip(lang.to_pylist(), phrase.to_pylist(), c.tolist()):
                        got[(key, *x.split(" "))] += k
        assert got == f


def test_unnamed_counts_saturate():
    r = np.random.default_rng(3)
    h, c = r.integers(0, 50, 4000).astype(np.uint64), r.integers(1, 20, 4000)
    keys, counts = collocations.summed(h, c)
    assert dict(zip(keys.tolist(), counts.tolist())) == {k: min(255, int(c[h == k].sum())) for k in range(50)}


def test_large_counts_are_exact(spark):
    counts = [(9_999_999_999_999, 9_999_999_999_999, 9_999_999_999_999), (7_777_777_777_777, 9_999_999_999_998, 8_888_888_888_889), (10, 3_000_000_019, 11), (1, 9_999_999_999_999, 9_999_999_999_999)]
    got = spark.createDataFrame(counts, "a bigint, l bigint, r bigint").withColumn("score", collocations._score("a", "l", "r")).collect()
    assert [r.score for r in got] == [1000000 * a * a // (x * y) for a, x, y in counts]


def test_one_phrase_in_half_of_all_rows_and_a_long_text(spark):
    rows = [(i, "the same few words here" if i % 2 else f"doc{i} says word{i % 7} again", "en") for i in range(2000)] + [(-1, "very long text indeed " * 60_000, "en")]
    got = collocations.collocations(spark.createDataFrame(rows, SCHEMA), shards=2)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 10, 2000)


def test_empty_and_clashing_columns(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA), shards=1).count() == 0
    docs = spark.createDataFrame([(i, "a b", "en", "s", 3) for i in range(12)], SCHEMA + ", shard string, n int").withColumn("slot", F.lit(1))
    assert [tuple(r) for r in collocations.collocations(docs, shards=2).collect()] == [("en", 1, "a b", 12, 12, 12, 24, 1000000)]
