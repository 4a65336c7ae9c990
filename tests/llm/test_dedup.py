"""Exact dedup, SimHash and components against plain versions."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clipspans.llm import exact_dedup, simhash
from clipspans.llm.components import components

DOCS = "doc_id bigint, text string, digest string, file string"
WORDS = "the quick brown fox jumps over a lazy dog while rain falls on old roofs and nobody minds it at all today".split()


def rows():
    r = np.random.default_rng(1)
    base = [" ".join(r.choice(WORDS, 60)) for _ in range(12)]
    near = [b.replace("fox", "Fox", 1) + (" end" if i % 2 else "") for i, b in enumerate(base)]
    texts = base + near + base[:3] + [b.upper() for b in base[:2]] + ["", None, "  \t", "one", "One", "x" * 50000, " ".join(WORDS * 2000)]
    return [(i if i != 7 else None, t, "d", "f") for i, t in enumerate(texts)] + [(0, base[0], "d", "f"), (0, base[0], "d", "f")]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_exact_classes(spark):
    data = rows()
    got = exact_dedup.classes(spark.createDataFrame(data, DOCS)).collect()
    groups = {}
    for i, t, *_ in data:
        groups.setdefault(lower(t), []).append(i)
    want = sorted(((-1 if i is None else i), max((x for x in g if x is not None), default=None), len(g)) for g in groups.values() for i in g)
    assert sorted(((-1 if r.id is None else r.id), r.keep_id, r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)


def test_exact_collisions(spark):
    """With a digest of eight values, full bytes tell the texts apart."""
    data = rows()
    weak = lambda c: (F.crc32(c.cast("binary")) % 8).cast("string")
    got = exact_dedup.classes(spark.createDataFrame(data, DOCS), digest=weak)
    assert got.where("kept").count() == len({lower(t) for _, t, *_ in data})
    assert got.count() == len(data)


def test_exact_rows_and_empty(spark):
    data = rows()
    df = spark.createDataFrame(data, DOCS)
    out = exact_dedup.deduplicate(df)
    assert out.columns == df.columns
    assert sorted(lower(r.text) for r in out.collect()) == sorted({lower(t) for _, t, *_ in data})
    assert exact_dedup.deduplicate(df.limit(0)).count() == 0


def test_state_goes_on(spark, tmp_path):
    """A second run with the same checkpoint adds to the retained state."""
    arrive = lambda n: spark.createDataFrame([("a", n, "f", n), ("b", n, "f", n)], exact_dedup.ARRIVAL).write.mode("append").parquet(f"{tmp_path}/in")
    for n in (1, 5, 3):
        arrive(n)
        exact_dedup.update_state(spark.readStream.schema(exact_dedup.ARRIVAL).parquet(f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp")
    got = {r.digest: (r.n, r.keep.id) for r in exact_dedup.retained(spark, f"{tmp_path}/out").collect()}
    assert got == {"a": (3, 5), "b": (3, 5)}


def plain_print(text, shingle, seed):
    words = lower(text).split() if text is None or text.isascii() else None
    if words is None:
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower(text)) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, seed) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, far):
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i in range(len(prints)):
            for j in range(len(prints)):
                if (prints[i] ^ prints[j]).bit_count() <= far and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


@pytest.mark.parametrize("chunk", [4096, 5])
def test_simhash_against_all_pairs(spark, monkeypatch, chunk):
    """Small chunks send every cell down the path for large ones."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    data = [(i, t) for i, (_, t, *_) in enumerate(rows())]
    prints = [plain_print(t, 4, 42) for _, t in data]
    got = {r.id: (int(r.fingerprint, 16), r.component) for r in simhash.classes(spark.createDataFrame(data, "doc_id bigint, text string")).collect()}
    assert got == {i: (p, c) for i, p, c in zip(range(len(data)), prints, plain_components(prints, 4))}


def test_segments_meet():
    """Any two fingerprints at distance 4 or less share a cell."""
    r = np.random.default_rng(2)
    for _ in range(300):
        a = int(r.integers(0, 1 << 63))
        b = a
        for bit in r.choice(64, int(r.integers(0, 5)), replace=False):
            b ^= 1 << int(bit)
        assert any(((a ^ b) >> low & (1 << bits) - 1).bit_count() <= radius for _, low, bits, radius in simhash.SEGMENTS_4)


def test_candidates_to_23_bits(spark):
    """The pipeline's search finds every pair up to distance 23, also where no segment differs in fewer than 2 bits."""
    r = np.random.default_rng(6)
    prints, pairs = [], []
    for far in [23] * 40 + list(range(16, 23)) * 5:
        bits = r.choice(128, far, replace=False)
        if far == 23:
            bits = np.concatenate([16 * i + r.choice(16, 2 if i == 7 else 3, replace=False) for i in range(8)])
        a = int.from_bytes(r.bytes(16), "little")
        b = a ^ sum(1 << int(x) for x in bits)
        pairs.append(tuple(sorted("".join(f"{x >> s & (1 << 64) - 1:016x}" for s in (0, 64)) for x in (a, b))))
        prints += [tuple((x >> s & (1 << 64) - 1) - (x >> s + 63 & 1) * (1 << 64) for s in (0, 64)) for x in (a, b)]
    df = spark.createDataFrame(prints, "f0 bigint, f1 bigint")
    got = simhash.edges(df, simhash.SEGMENTS_128, 2, 29).collect()
    assert {tuple(sorted((x.u, x.v))) for x in got} == set(pairs)


def test_simhash_dedup(spark):
    data = rows()
    out = simhash.deduplicate(spark.createDataFrame(data, DOCS))
    kept = out.collect()
    assert out.columns == ["doc_id", "text", "digest", "file"]
    assert sum(1 for r in kept if r.text and len(r.text.split()) == 60 or r.text and len(r.text.split()) == 61) == 12
    assert simhash.deduplicate(spark.createDataFrame([], DOCS)).count() == 0


def plain_set(text, shingle=5):
    words = lower(text).split()
    return {tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))} if words else set()


def plain_kept(texts, least=0.8):
    """Ids that stay: the smallest of each component of pairs whose shingle sets are similar."""
    sets, label = [plain_set(t) for t in texts], list(range(len(texts)))
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] == sets[j] or len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            if label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    return {i for i, x in enumerate(label) if i == x}


@pytest.mark.parametrize("part", [2048, 7])
def test_near_copies_need_similar_sets(spark, monkeypatch, part):
    """A repeated line and a shared passage do not make copies; parts of a large component meet each other."""
    monkeypatch.setattr(simhash, "PART_TEXTS", part)
    r = np.random.default_rng(5)
    fresh = lambda n: [f"w{x}" for x in r.integers(0, 50000, n)]
    texts = [" ".join(["subscribe to our newsletter now"] * 100 + fresh(300)) for _ in range(6)]
    passage = fresh(300)
    texts += [" ".join(passage + fresh(52)) for _ in range(40)]  # Jaccard about 0.74
    near = fresh(400)
    texts += [" ".join(near[:i] + ["changed"] + near[i + 1 :]) for i in range(0, 400, 20)]
    texts += ["", " ", "one", "One", "one two"]
    got = {x.doc_id for x in simhash.deduplicate(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert got == plain_kept(texts)
    assert len(got) == 6 + 40 + 1 + 3


@pytest.mark.parametrize("part", [200_000, 9])
def test_components(spark, monkeypatch, part):
    """In one part, and in many that leave the groups apart."""
    from clipspans.llm import components as module

    monkeypatch.setattr(module, "PART_EDGES", part)
    r = np.random.default_rng(3)
    pairs = [(str(a), str(b)) for a, b in r.integers(0, 80, (60, 2))] + [("h", f"h{i}") for i in range(50)] + [("c0", "c0")]
    pairs += [(f"p{i:03}", f"p{i + 1:03}") for i in range(40)]
    got = {x.node: x.root for x in components(spark.createDataFrame(pairs, "u string, v string")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[root(a)] = root(b)
    groups = {}
    for x in parent:
        groups.setdefault(root(x), []).append(x)
    want = {x: min(g) for g in groups.values() if len(g) > 1 for x in g}
    assert got == want
    assert components(spark.createDataFrame([], "u string, v string")).count() == 0
