"""Decontamination, toxicity, quality, SentencePiece and token files."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clipspans.llm import decontaminate, quality, range_coder, sentencepiece_unigram, sharding, token_files, toxicity

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_hits(text, items):
    words = WORD.findall(lower(text))
    hit, found = set(), set()
    for item, body in items:
        w = WORD.findall(lower(body))
        n = min(10, len(w))
        for s in range(len(w) - n + 1) if n else ():
            for i in range(len(words) - n + 1):
                if words[i : i + n] == w[s : s + n]:
                    hit |= set(range(i, i + n))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def test_decontamination(spark):
    r = np.random.default_rng(0)
    vocabulary = [f"w{i}" for i in range(9)] + ["é", "Ünï", "A1"]
    items = [(1, " ".join(r.choice(vocabulary, 25))), (2, "short item W1"), (3, "one"), (4, ""), (5, None), (6, " ".join(r.choice(vocabulary, 10))), (7, "short item W1")]
    texts = [" ".join(r.choice(vocabulary, int(n))) for n in r.integers(0, 60, 30)]
    texts += [f"x {items[0][1]} y", f"A, {items[0][1].upper()}!", items[0][1][:-3], "go short-item_w1", "one one", None, "", "...", items[5][1] * 1, " ".join([items[5][1]] * 300)]
    docs = [(i % 37, t, "n", i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, items string, n_hit bigint")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for limit in (decontaminate.MAX_BROADCAST_ROWS, 0):  # broadcast, then shuffled
        got = {x.row.n_hit: (x.n_words, x.n_hit, x["items"]) for x in decontaminate.hits(df, bench, max_broadcast_rows=limit).collect()}
        assert got == {k: plain_hits(t, items) for _, t, _, k in docs}
    clean = decontaminate.clean_documents(df, bench)
    assert clean.columns == df.columns
    assert {x.n_hit for x in clean.collect()} == {k for _, t, _, k in docs if not plain_hits(t, items)[1]}
    rest = {x.n_hit: x.text for x in decontaminate.remove_spans(df, bench).collect()}
    assert rest[30] == "x y" and rest[33] == "go" and rest[36] == ""
    assert decontaminate.clean_documents(df, bench.limit(0)).count() == len(docs)
    assert decontaminate.clean_documents(df.limit(0), bench).count() == 0


def test_fold():
    assert toxicity.fold("An 1d10t! а fооl, H3ll0 2024 b4 5TUP1D %%% x$$$ <b>Ｂad</b>") == ["an", "idiot", "a", "fool", "hello", "2024", "ba", "stupid", "x", "b", "bad", "b"]
    assert toxicity.fold("ВAD НOT a$$ ïdiöt 𝐛𝐚𝐝 x@ $5") == ["bad", "hot", "ass", "idiot", "bad", "xa", "5"]
    assert toxicity.fold(None) == toxicity.fold("") == toxicity.fold("%% !!") == []


def toxic_rows():
    r = np.random.default_rng(4)
    plain = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(10) for j in range(10)]
    out = []
    for i in range(400):
        words = r.choice(plain, int(r.integers(5, 80))).tolist()
        y = int(i % 8 == 0)
        if y:
            words.insert(int(r.integers(0, len(words))), ["vile", "v1le", "VILE"][i % 3])
        elif i % 15 == 0:
            words += ["vile", "weather"]
        out.append((i, " ".join(words), y))
    return out


def test_toxicity(spark):
    data = toxic_rows()
    rows = spark.createDataFrame(data, "doc_id bigint, text string, y int").select("text", "y")
    model = toxicity.fit(rows)
    assert "vile weather" in model.exceptions and list(model.lexicon) == ["vile "]
    docs = spark.createDataFrame([(1, "so vile a thing", "s"), (2, "vile weather today", "s"), (3, None, "s"), (4, "", "s"), (4, "", "s"), (5, "wab " * 20000, "s")], "doc_id bigint, text string, score string")
    got = [x.score for x in toxicity.score(docs.select("doc_id", "text"), model).orderBy("doc_id").collect()]
    assert got[2] == got[3] == got[4] and all(0 <= x <= 1 for x in got)
    kept = toxicity.reject(docs, model)
    assert kept.columns == docs.columns and kept.count() >= 5
    none = toxicity.fit(rows.limit(0))
    assert toxicity.score(docs.select("doc_id", "text"), none).where("score > 0.001").count() == 0
    assert toxicity.reject(docs.limit(0), model).count() == 0


def test_toxicity_exceptions():
    model = toxicity.Model({"vile ": 3.0, "nasti": 2.0}, {"vile weather"})
    assert toxicity.features(["nastiest"], model.automaton())[0] == 1 and toxicity.features(["nasty", "dynastic"], model.automaton())[0] == 0
    a = model.automaton()
    assert toxicity.features(["vile", "weather"], a)[0] == 0
    assert toxicity.features(["vile", "weather", "vile"], a)[0] == 1
    assert toxicity.features(["vileness"], a)[0] == 0
    assert toxicity.features(["vile"], a)[2] > toxicity.features(["vile"] + ["x"] * 99, a)[2]


def test_quality(spark):
    r = np.random.default_rng(5)
    good = [" ".join(r.choice(["Sun", "rain", "tree", "house,", "walks."], 60)) for _ in range(160)]
    bad = [" ".join(w + "%%%" for w in r.choice(["sun", "RAIN", "tree"], 60)) for _ in range(40)]
    vector = quality.Vector()
    rows = [vector(t) for t in good + bad]
    y = np.array([1] * len(good) + [0] * len(bad))
    seen = np.arange(len(y)) % 2 == 0
    model = quality.fit_rows([x for x, s in zip(rows, seen) if s], y[seen])
    scores = model.scores([x for x, s in zip(rows, seen) if not s])
    assert ((scores >= 0.3) == y[~seen]).all()
    docs = spark.createDataFrame([(1, good[0]), (1, good[0]), (2, None), (3, ""), (None, bad[0] * 50)], "doc_id bigint, text string")
    got = quality.score(docs, model).collect()
    assert len(got) == 5 and got[0] == got[1] and got[2].score == got[3].score and all(0 <= x.score <= 1 for x in got)
    assert quality.score(docs.limit(0), model).count() == 0
    one = quality.fit_rows(rows[:5], y[:5])
    assert 0.99 < one.scores(rows[:1])[0] <= 1
    assert quality.fit_rows([], np.zeros(0)).scores([np.zeros(0, np.int32)])[0] == 0.5


def test_dual_coordinate_descent_optimum():
    """No row's dual variable can be improved: margins agree with the variables' bounds."""
    r = np.random.default_rng(6)
    rows = [np.sort(r.choice(40, 6, replace=False)).astype(np.int32) for _ in range(60)]
    y = (np.array([(x < 20).sum() for x in rows]) > 3).astype(int)
    scale = np.ones(quality.SIZE)
    w, b = quality.descend(rows, y, scale, epochs=400, cost=1.0)
    v = np.array([w[x].sum() / np.sqrt(6) + b for x in rows]) * np.where(y == 1, 1, -1)

    def primal(w, b):
        m = np.array([w[x].sum() / np.sqrt(6) + b for x in rows]) * np.where(y == 1, 1, -1)
        c = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum()))
        return 0.5 * (w @ w + b * b) + (c * np.maximum(0, 1 - m)).sum()

    best = primal(w, b)
    for _ in range(200):
        assert primal(w + r.normal(0, 0.01, len(w)) * (w != 0), b + r.normal(0, 0.01)) >= best - 1e-6
    assert (v > 0).mean() > 0.9


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece_unigram.load(sentencepiece_unigram.default_model())


TEXTS = ["Hello world", "a  b", "  x ", " ", "", "漢字 😀\x00z", "line\nnext\ttab", "ünïcödé, naïve! " * 30, "x" * 3000, "́a", "The and attion to thanedble."]


def test_sentencepiece_round_trip(spark, pieces):
    for t in TEXTS:
        assert pieces.decode(pieces.encode(t)) == t
    assert pieces.decode(pieces.encode("a▁b")) == "a b"
    assert pieces.decode([pieces.bytes[0xFF], pieces.bytes[0x41]]) == "�A" and pieces.decode([1, 2]) == ""
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*TEXTS, None])], "doc_id bigint, text string, token_ids string")
    out = sentencepiece_unigram.encode(df, sentencepiece_unigram.default_model())
    assert out.columns == ["doc_id", "text", "token_ids", "_token_ids"]
    back = sentencepiece_unigram.decode(out, sentencepiece_unigram.default_model(), "_token_ids").collect()
    assert all(r.decoded == (r.text or "") for r in back)
    assert sentencepiece_unigram.round_trip(df.limit(0), sentencepiece_unigram.default_model()).count() == 0


def test_sentencepiece_best_path(pieces):
    """Against all segmentations of short runs."""
    usable = {t: i for i, (t, k) in enumerate(zip(pieces.texts, pieces.kinds)) if k == 1}

    def best(run):
        if not run:
            return 0.0
        options = [pieces.scores[usable[run[:n]]] + best(run[n:]) for n in range(1, len(run) + 1) if run[:n] in usable]
        if run[0] not in usable:
            options.append(pieces.unknown + best(run[1:]))
        return max(options)

    for run in ("▁hello", "▁▁▁a", "▁tttion", "▁ab漢c", "▁unitedly"):
        ids = pieces.best(run)
        score, k = 0.0, 0
        while k < len(ids):
            if ids[k] in pieces.spelt:
                first = pieces.spelt[ids[k]]
                k += 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                score += pieces.unknown
            else:
                score += pieces.scores[ids[k]]
                k += 1
        assert abs(score - best(run)) < 1e-9


def test_range_coder():
    r = np.random.default_rng(7)
    blocks = [r.integers(0, range_coder.MAX_ID, n) for n in (0, 1, 5, 300)] + [r.zipf(1.3, 500) % 49408, np.zeros(400, int), np.tile([5, 9, 70000], 100)]
    coded = range_coder.encode(blocks)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(blocks, range_coder.decode(coded)))
    for k in (3, 6):  # each block alone
        assert (range_coder.decode([coded[k]])[0] == blocks[k]).all()
    assert len(coded[5]) < 80 and len(coded[6]) < 150
    bad = bytearray(coded[3])
    bad[40] ^= 1
    with pytest.raises(ValueError):
        range_coder.decode([bytes(bad)])
    with pytest.raises(ValueError):
        range_coder.decode([b"nothing"])
    with pytest.raises(ValueError):
        range_coder.encode([np.array([-1])])
    assert range_coder.encode([]) == range_coder.decode([]) == []


def plain_decode(data):
    """One block by loops over single ids, after the description of the format."""
    import math
    import struct

    magic, n, bits, crc = struct.unpack_from("<4sIII", data)
    lanes = max(1, -(-n // 1024))
    steps = min(1024, n)
    sizes = struct.unpack_from(f">{lanes}H", data, 16)
    at = 16 + 2 * lanes
    coders = []
    for size in sizes:
        digits = list(struct.unpack_from(f">{size}H", data, at)) + [0] * 8
        at += 2 * size
        coders.append({"code": digits[0] << 32 | digits[1] << 16 | digits[2], "range": 1 << 48, "next": iter(digits[3:] + [0] * 4000)})
    two, one, counts = {}, {}, {}
    states = {}  # (sure2, sure1, same) -> outcomes
    spent, seen, missed, escapes = [0] * 4, [], [], 0
    slots = [(None, 0, 65536)]
    cost = [12 * 256] + [round(-math.log2(i / 4096) * 256) for i in range(1, 4097)]
    weights = [round(65536 * 2 ** (-i / 4)) for i in range(64)] + [0]

    def predictions(s):
        alike = [lambda k: k == s, lambda k: k[0] == s[0] and k[2] == s[2], lambda k: k[1] == s[1] and k[2] == s[2], lambda k: k[2] == s[2]]
        sums = [[sum(c[o] for k, c in states.items() if f(k)) for o in range(3)] for f in alike]
        return [[(2 * x + 1) / (2 * sum(t) + 3) for x in t] for t in sums]

    mixed = {}

    def bounds(s):
        if s not in mixed:
            w = [weights[min((x - min(spent)) >> 10, 64)] for x in spent]
            p = predictions(s)
            q = [(w[0] * p[0][o] + w[1] * p[1][o] + w[2] * p[2][o] + w[3] * p[3][o]) / sum(w) for o in range(2)]
            first = min(max(math.floor(q[0] * 65536), 16), 65536 - 4096)
            mixed[s] = first, min(first + min(max(math.floor(q[1] * 65536), 16), 65536), 65536 - 1024)
        return mixed[s]

    def renew(c):
        while c["range"] < 1 << 32:
            c["range"] <<= 16
            c["code"] = c["code"] << 16 | next(c["next"])

    got = [[] for _ in range(lanes)]
    spans = [x for x in [1, 2, 3, 4, 6, *range(8, 1024, 8)] if x < steps] + [steps]
    renewals = {1 << e for e in range(12)} | {96, 192, 384, 768}
    start = 0
    for stop in spans:
        waiting = []
        for t in range(start, stop):
            for c, ids in zip(coders, got):
                last, before = ((ids[-k] * 0x9E3779B1) & 0xFFFFFFFF if len(ids) >= k else 0 for k in (1, 2))
                at2 = ((last + (before << 7) + (before >> 9)) & 0xFFFFFFFF) >> (32 - range_coder._TWO)
                at1 = last >> (32 - range_coder._ONE)
                (c2, f2), (c1, f1) = two.get(at2, (0, 0)), one.get(at1, (0, 0))
                # entries are alike where they differ by less than 8 in their bits, which is where the ids are the same
                s = f2, f1, c2 == c1
                first, second = bounds(s)
                part = c["range"] >> 16
                target = c["code"] // part
                o = (target >= first) + (target >= second)
                low, high = ((0, first), (first, second), (second, 65536))[o]
                c["code"] -= low * part
                c["range"] = (high - low) * part
                x = (c2, c1, None)[o]
                part = c["range"] >> 16
                escaped = False
                if o == 2:
                    place = c["code"] // part
                    x, low, size = next(v for v in slots if v[1] <= place < v[1] + v[2])
                    c["code"] -= low * part
                    c["range"] = size * part
                    escaped = x is None
                else:
                    c["range"] = part << 16
                renew(c)
                if escaped:
                    part = c["range"] >> bits
                    x = min(c["code"] // part, (1 << bits) - 1)
                    c["code"] -= x * part
                    c["range"] = part
                    renew(c)
                    escapes += 1
                ids.append(x)
                seen.append((s, o))
                if o == 2:
                    missed.append(x)
                waiting.append((at2, (c2, f2), at1, (c1, f1), x))
        for a2, e2, a1, e1, x in waiting:
            for table, a, (c, f) in ((two, a2, e2), (one, a1, e1)):
                table[a] = (x if f < 2 else c, min(f + 1, 7) if c == x else max(f >> 1, 1))
        if stop in renewals and stop < steps:
            before = {s: predictions(s) for s, _ in seen}
            spent = [x >> 1 for x in spent]
            for s, o in seen:
                for k in range(4):
                    spent[k] += cost[math.floor(before[s][k][o] * 4096)]
            for s, o in seen:
                states.setdefault(s, [0, 0, 0])[o] += 1
            for x in missed:
                counts[x] = counts.get(x, 0) + 1
            if counts:
                e = min(max(65536 * (escapes + 1) // (len(missed) + 2), 16), 65536 >> 1)
                slots, end = [], 0
                for x in sorted(counts):
                    size = 1 + counts[x] * (65536 - e - len(counts)) // sum(counts.values())
                    slots.append((x, end, size))
                    end += size
                slots.append((None, end, 65536 - end))
            seen, missed, escapes = [], [], 0
            mixed.clear()
        start = stop
    out = [x for ids in got for x in ids][:n]
    assert zlib.crc32(np.array(out, "<u4").tobytes()) == crc
    return out


def test_range_coder_against_a_plain_one():
    r = np.random.default_rng(9)
    blocks = [r.zipf(1.4, 300) % 5000, np.concatenate([r.zipf(1.3, 900) % 3000, np.tile(r.integers(0, 60000, 50), 24)]), np.array([7])]
    for b in blocks:
        assert plain_decode(range_coder.encode([b])[0]) == b.tolist()


def test_range_coder_is_shorter_than_deflate():
    """On ids drawn with the frequencies of words, and on repeats, in the same blocks."""
    r = np.random.default_rng(10)
    ids = np.minimum(r.zipf(1.2, range_coder.BLOCK), 49000)
    ids[50_000:60_000] = ids[:10_000]
    assert len(range_coder.encode([ids])[0]) < len(zlib.compress(ids.astype("<u2").tobytes(), 9))


def test_token_files(spark, tmp_path, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    monkeypatch.setattr(token_files, "TOGETHER", 500)
    texts = [*TEXTS, "<|endoftext|> a b\x1cc", None, "Éá it's 12"] * 3
    data = [(i * 7 % 45 if i else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    token_files.write(df.repartition(3), str(tmp_path / "a"), path)
    got = sorted(token_files.read(spark, str(tmp_path / "a")).collect(), key=lambda r: r.start)
    want = {}
    for i, t in data:
        want.setdefault(i, []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])
    place = 0
    for r in got:
        assert r.start == place and r.n_tokens == len(r.tokens) and r.tokens in want[r.id]
        want[r.id].remove(r.tokens)
        place += r.n_tokens
    assert not any(want.values()) and [r.id for r in got] == sorted((i for i, _ in data), key=lambda i: -1 if i is None else i)
    token_files.write(df.limit(0), str(tmp_path / "b"), path)
    assert token_files.read(spark, str(tmp_path / "b")).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_piece_tokens_equal_the_library(name):
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    tokenizer, own, r = Tokenizer.from_file(path), token_files.PieceTokens(path, most=300), random.Random(0)
    letters = "aAbZé ÉİıßŒœ×÷ ' |<>\t\n\x0b\x0c\x1c\xa0 12²½&%_-.,!?s't'll<|endoftext|>漢😀\u0301\u212aﬁǅΣσ٣"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(2000)]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for i in range(0, len(texts), 100):
        ids, n = own(pa.array(texts[i : i + 100]))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == want[i : i + 100]


def test_sharding(spark):
    data = [(i, f"t{i % 50}", "s") for i in range(3000)] + [(None, None, "s"), (5, "t5", "s"), (5, "t5", "s")]
    df = spark.createDataFrame(data, "doc_id bigint, text string, shard string")
    rows = sharding.assign(df).collect()
    assert rows[0].__fields__ == ["doc_id", "text", "shard", "_shard", "slot"]
    by = {}
    for r in rows:
        by.setdefault(r["_shard"], []).append(r.slot)
    assert set(by) == set(range(24)) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) < 2 * min(map(len, by.values()))
    both = df.select("doc_id", *[sharding.shard_of(F.col("doc_id"), sharding.tree(n)).alias(f"n{n}") for n in (24, 25, 26)]).collect()
    assert all(r.n25 in (r.n24, 24) and r.n26 in (r.n25, 25) for r in both) and any(r.n25 == 24 for r in both)
    assert sharding.assign(df.limit(0)).count() == 0


def test_movement_stays_in_the_subtree(spark):
    a = sharding.tree(24)
    heavier = [(n, w + 4, k) if n == "1" else (n, w, k) for n, w, k in a]
    df = spark.range(4000).select(F.col("id"), sharding.shard_of(F.col("id"), a).alias("a"), sharding.shard_of(F.col("id"), heavier).alias("b"))
    moved = df.where("a <> b").collect()
    assert moved and all(r.b >= 12 for r in moved)


def test_token_checksum():
    assert zlib.crc32(np.array([1], "<u4").tobytes()) == zlib.crc32(b"\x01\0\0\0")
