"""The registered queries: their columns, their SQL, odd tables, and columns whose names clash with what operators use inside."""

import os
import zlib

import pytest
from pyspark.sql import functions as F

from clipspans.llm import decontaminate, exact_dedup, registry, sentencepiece_unigram, sharding, simhash, toxicity
from clipspans.llm.common import BATCH

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

COLUMNS = {
    "op1_sentencepiece": {"doc_id", "n_tokens", "exact"},
    "op2_quality": {"doc_id", "held_out", "score", "predicted"},
    "op3_warc_audit": {"page_id", "file", "offset", "status"},
    "op4_simhash": {"doc_id", "fingerprint", "component_id"},
    "op5_decontaminate": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    "op6_hash_tree_shards": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op7_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op8_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op9_url_rules": {"page_id", "host", "path", "rule", "verdict"},
    "op10_token_files": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op11_prefix_trie": {"conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"},
    "op12_byte_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op13_collocations": {"lang", "rank", "phrase", "a", "l", "r", "n", "score"},
}
#: Rows of queries that don't return one for each row of documents or pages.
OTHER_ROWS = {"op11_prefix_trie": 4, "op13_collocations": 997}


@needs_tables
@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(registry.oracle_sql()[name])
    names = sorted(c[0] for c in want.description)
    order = [[c[0] for c in want.description].index(n) for n in names]
    rows = lambda found: sorted((tuple(str(v) for v in r) for r in found))
    got = registry.queries()[name](spark, SF)
    assert sorted(got.columns) == names
    assert rows(got.select(*names).collect()) == rows([[r[i] for i in order] for r in want.fetchall()])


def odd_documents(spark):
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    texts = [None, "", "  ", "a", "A", "same text here", "same text here", long, long, "x" * 100_000, "漢字 é ▁ \x00", "one two three four five six seven eight nine ten eleven"]
    rows = [(i if i % 5 else None, t, "en", None if i % 3 else "s", len(t or "")) for i, t in enumerate(texts)] * 2
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def write_tables(spark, folder, empty):
    cut = (lambda df: df.limit(0)) if empty else (lambda df: df)
    cut(odd_documents(spark)).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    labels = [(1, 1, 0), (1, 1, 0), (2, 0, 1), (6, 1, 0), (7, 0, 0), (8, 1, 1), (None, 1, 1), (9, None, None)]
    cut(spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).write.parquet(f"{folder}/labels.parquet")
    items = [(1, "one two three four five six seven eight nine ten eleven"), (1, "a"), (2, None), (None, "same text here")]
    cut(spark.createDataFrame(items, "item_id bigint, text string")).write.parquet(f"{folder}/benchmark.parquet")
    pages = [(1, "http://a.com/", "x"), (1, "http://a.com/", "x"), (None, None, None), (90, "http://example.com/en/", "y"), (91, "no url", "")]
    cut(spark.createDataFrame(pages, "page_id bigint, url string, html string")).write.parquet(f"{folder}/pages.parquet")
    turns = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (21, None, None, None), (21, 5, "user", "hi"), (None, 1, "user", "hi"), (40, 1, "user", "x" * 100_000)]
    cut(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")).write.parquet(f"{folder}/conversations.parquet")


@pytest.mark.parametrize("empty", [False, True])
def test_odd_tables(spark, tmp_path, empty):
    """Every query gives a row for each row of its table, has its columns, and leaves the session's settings alone."""
    write_tables(spark, tmp_path, empty)
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.get(BATCH)
    for name, query in registry.queries().items():
        got = query(spark, str(tmp_path))
        assert COLUMNS[name] <= set(got.columns), name
        table = "pages" if "page_id" in got.columns else "documents"
        want = (0 if empty else OTHER_ROWS[name]) if name in OTHER_ROWS else spark.read.parquet(f"{tmp_path}/{table}.parquet").count()
        assert got.count() == want, name
        assert spark.conf.get(BATCH) == before[1], name


def test_pipeline_on_odd_tables(spark, tmp_path):
    import corpus_pipeline

    write_tables(spark, f"{tmp_path}/a", False)
    write_tables(spark, f"{tmp_path}/b", True)
    got = corpus_pipeline.run(spark, f"{tmp_path}/a").collect()
    texts = [r.text for r in got]
    assert all(r.exact or "▁" in r.text for r in got) and len(texts) == len(set(texts)) and texts.count("same text here") == 0
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0


NAMES = ["__file", "__row", "_metadata", "__k", "__b", "__s", "file", "row", "of_file", "k", "b", "place", "bucket", "norm", "digest", "fingerprint", "root", "node", "near", "w", "x", "score", "f0", "shard", "slot", "pieces", "exact", "a.b", "odd`name"]


def test_clashing_columns(spark):
    rows = [(i, t, *[f"{n}{i}" for n in NAMES]) for i, t in enumerate(["a b c d e f g", "a b c d e f g", "A b c d e f g", "one two three", None, "", "", "vile words stand here"])]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *NAMES])
    bench = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    model = toxicity.Model({"vile ": 5.0}, set(), __import__("numpy").array([9.0, 0, 0, -5.0]))
    for what, kept in ((exact_dedup.deduplicate, {2, 3, 6, 7}), (simhash.deduplicate, {0, 3, 4, 7}), (lambda d: decontaminate.clean_documents(d, bench), {0, 1, 2, 4, 5, 6, 7}), (lambda d: toxicity.reject(d, model), set(range(7)))):
        out = what(docs)
        assert out.columns == docs.columns
        assert {r.doc_id: tuple(r)[2:] for r in out.collect()} == {i: r[2:] for i, r in enumerate(rows) if i in kept}
    spans = decontaminate.remove_spans(docs, bench)
    assert spans.columns == docs.columns and {r.doc_id: r.text for r in spans.collect()}[3] == ""
    more = sharding.assign(docs)
    assert more.columns == [*docs.columns, "_shard", "_slot"]
    assert {r.doc_id: tuple(r)[2:-2] for r in more.collect()} == {i: r[2:] for i, r in enumerate(rows)}
    coded = sentencepiece_unigram.encode_and_check(docs, sentencepiece_unigram.default_model())
    assert coded.columns == [*docs.columns, "token_ids", "_exact"]
    assert {r.doc_id: tuple(r)[2:-2] for r in coded.collect()} == {i: r[2:] for i, r in enumerate(rows)}


def plain_hash(spark, *values):
    return spark.range(1).select(F.xxhash64(*[F.lit(v) for v in values]).alias("h")).first().h & ((1 << 64) - 1)


def test_shards_by_plain_draws(spark):
    """Every level's draw and every slot, by hand."""
    import math

    docs = [(i * 37, f"t{i % 11}") for i in range(12)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: (r.shard, r.slot) for r in sharding.assign(df).collect()}
    nodes = sharding.tree(24)

    def descend(key, level):
        if not isinstance(level, list):
            return level
        if len(level) == 1:
            return descend(key, level[0][2])
        # Spark hashes a bigint key after the node's name
        draw = lambda name, weight: -math.log(((spark.range(1).select(F.xxhash64(F.lit(name), F.lit(key).cast("bigint")).alias("h")).first().h & ((1 << 64) - 1)) >> 11) / (1 << 53) + 0.5 / (1 << 53)) / weight
        return descend(key, min(level, key=lambda n: draw(n[0], n[1]))[2])

    for key, _ in docs[:4]:
        assert got[key][0] == descend(key, nodes)
    by = {}
    for i, t in docs:
        h = spark.range(1).select(F.xxhash64(F.lit("slot"), F.lit(i).cast("bigint"), F.lit(zlib.crc32(t.encode())).cast("bigint")).alias("h")).first().h
        by.setdefault(got[i][0], []).append((h % sharding.SLOT_BUCKETS, h, i))
    for shard, rows in by.items():
        assert [got[i] for _, _, i in sorted(rows)] == [(shard, s) for s in range(len(rows))]


def test_toxic_matches_by_plain_scan():
    """Aho-Corasick against a look at every word and pair."""
    import random

    r = random.Random(3)
    words = ["vile", "viler", "vilest", "bad", "badge", "ok", "weather", "nastier", "nasty"]
    model = toxicity.Model({"vile ": 3.0, "nasti": 2.0, "bad": 1.5}, {"vile weather", "ok badge"})
    automaton = model.automaton()
    for _ in range(500):
        text = [r.choice(words) for _ in range(r.randint(0, 12))]
        total = 0.0
        for i, w in enumerate(text):
            weight = next((v for t, v in model.lexicon.items() if f"{w} ".startswith(t)), 0.0)
            free = i + 1 < len(text) and f"{w} {text[i + 1]}" in model.exceptions or i and f"{text[i - 1]} {w}" in model.exceptions
            total += 0.0 if free else weight
        got = toxicity.features(text, automaton)
        assert got == pytest.approx(toxicity._measure(total, len(text)))


def test_quality_by_plain_arithmetic():
    """Log-count ratios and margins, one number at a time."""
    import math

    import numpy as np

    from clipspans.llm import quality

    r = np.random.default_rng(8)
    rows = [np.sort(r.choice(30, 5, replace=False)).astype(np.int32) for _ in range(40)]
    y = r.integers(0, 2, 40)
    scale = quality.ratios(rows, y)
    count = lambda c, label: 1 + sum(c in x for x, k in zip(rows, y) if k == label)
    total = [quality.SIZE + sum(len(x) for x, k in zip(rows, y) if k == label) for label in (0, 1)]
    for c in (0, 7, 29, 1000):
        assert scale[c] == pytest.approx(math.log(count(c, 1) / total[1]) - math.log(count(c, 0) / total[0]))
    model = quality.fit_rows(rows, y)
    for x in rows[:10]:
        v = [model.scale[c] for c in x]
        margin = sum(model.weights[c] * s for c, s in zip(x, v)) / math.sqrt(sum(s * s for s in v)) + model.bias
        assert model.margins([x])[0] == pytest.approx(margin)
        assert model.scores([x])[0] == pytest.approx(1 / (1 + math.exp(-(model.slope * margin + model.shift))))


def test_toxic_features_of_long_texts():
    """A million words, all matches and many exceptions; and any nesting of both against a look at every pair."""
    import random
    import time

    import ahocorasick

    model = toxicity.Model({"vile ": 3.0}, {"vile weather", "ok vile"})
    words = ["vile", "weather", "ok", "vile", "vile"] * 200_000
    began = time.time()
    got = toxicity.features(words, model.automaton())
    assert time.time() - began < 8 and got == pytest.approx(toxicity._measure(3.0 * 200_000, len(words)))
    r = random.Random(5)
    for _ in range(300):
        automaton = ahocorasick.Automaton()
        for _ in range(12):
            n = r.randint(1, 4)
            automaton.add_word(" " + " ".join(r.choice("ab") for _ in range(n)), (2 * n - 1, r.choice([0.0, 1.0, 2.5])))
        automaton.make_automaton()
        text = [r.choice("abc") for _ in range(r.randint(1, 40))]
        found = [(end - n + 1, end, w) for end, (n, w) in automaton.iter(f" {' '.join(text)} ")]
        free = [(a, b) for a, b, w in found if not w]
        total = sum(w for a, b, w in found if w and not any(x <= a and b <= y for x, y in free))
        assert toxicity.features(text, automaton) == pytest.approx(toxicity._measure(total, len(text)))


def test_lexicon_by_plain_rules():
    """The chosen terms, one at a time: the more certain ones, of which none begins another."""
    import random

    r = random.Random(11)
    for certainty in (0.5, 2.0):
        terms = {"".join(r.choice("ab") for _ in range(r.randint(1, 6))) + r.choice(["", " "]): (r.randint(0, 40), r.randint(0, 6)) for _ in range(60)}
        scored = {}
        for t, (toxic, other) in terms.items():
            weight, error = toxicity.log_odds(toxic, other, 50, 60)
            if weight >= toxicity.MIN_WEIGHT and weight > certainty * error:
                scored[t] = (weight - certainty * error, weight)
        want = {}
        for t in sorted(scored, key=lambda t: (-scored[t][0], t)):
            if not any(t.startswith(x) or x.startswith(t) for x in want):
                want[t] = scored[t][1]
        got = toxicity.lexicon(terms, 50, 60, certainty)
        assert got.keys() == want.keys() and all(got[t] == pytest.approx(want[t]) for t in want) and want


def test_tuning_by_plain_loops():
    """The certainty of least loss, with every row scored by terms of the other folds, row by row."""
    import math
    import random

    import numpy as np
    import pandas as pd

    from clipspans.llm.labelled import logistic, sigmoid

    r = random.Random(4)
    names = [f"{a}{b} " for a in "abcd" for b in "wxyz"]
    rows = []
    for i in range(300):
        y = int(r.random() < 0.4)
        own = [r.randrange(6) if y and r.random() < 0.7 else r.randrange(len(names)) for _ in range(r.randint(0, 5))]
        rows.append((y, i % toxicity.FOLDS, r.randint(1, 50), own))
    toxic, other = np.zeros((len(names), toxicity.FOLDS)), np.zeros((len(names), toxicity.FOLDS))
    for y, k, _, own in rows:
        for t in set(own):
            (toxic if y else other)[t, k] += 1
    best = (math.inf, None, None)
    for certainty in toxicity.CERTAINTIES:
        x = []
        for y, k, n, own in rows:
            rest = [(yy, f) for yy, f, _, _ in rows if f != k]
            n1 = sum(yy for yy, _ in rest)
            known = toxicity.lexicon({t: (toxic[i].sum() - toxic[i, k], other[i].sum() - other[i, k]) for i, t in enumerate(names)}, n1, len(rest) - n1, certainty)
            x.append(toxicity._measure(sum(known.get(names[t], 0.0) for t in own), n))
        x, ys = np.array(x, float), np.array([y for y, *_ in rows])
        w = logistic(x, ys)
        p = np.clip(sigmoid(np.column_stack([x, np.ones(len(x))]) @ w), 1e-9, 1 - 1e-9)
        loss = -float((ys * np.log(p) + (1 - ys) * np.log(1 - p)).mean())
        if loss < best[0]:
            best = (loss, certainty, w)
    got = toxicity._tune(pd.DataFrame(rows, columns=["y", "fold", "n", "terms"]), names, toxic, other)
    assert got[0] == best[1] and got[1] == pytest.approx(best[2], rel=1e-6)
