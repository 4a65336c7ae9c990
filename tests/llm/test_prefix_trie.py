"""The conversation trie against a plain one."""

import hashlib
import random
import re
import zlib

import pytest

from clipspans.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain_trie(rows):
    """All nodes by taking every prefix of every rebuilt conversation."""
    of = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            of.setdefault(c, []).append(((turn is not None, turn or 0, digest), (role, text)))
    of = {c: [t for _, t in sorted(turns)] for c, turns in of.items()}
    rebuilt = {}
    for c, own in of.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(of.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])[:h] + own[h:])
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) or 1
        own = (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = own + sum(saved[x] for x in below)
    ends = lambda node: hashlib.sha256(",".join(str(c) for c in sorted(members[node]) if len(rebuilt[c]) == len(node)).encode()).hexdigest()
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children.get(n, [])), leaves[n], saved[n], ends(n)) for n, m in members.items()
    )


def check(spark, rows):
    got = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == prefix_trie.COLUMNS
    order = lambda found: sorted(found, key=lambda r: (*r[:2], r[2] is not None, *[x or 0 for x in r[2:7]], r[7]))
    assert order(tuple(r) for r in got.collect()) == order(plain_trie(rows))


def drawn(r, n, deep, texts):
    rows = []
    for c in range(-n // 4, n):
        if r.random() < 0.8:
            rows += [(c, t if r.random() < 0.9 else None, r.choice(["user", "a", None]), r.choice(texts)) for t in range(r.choice([1, 2, 3, deep]))]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_trie(spark, seed):
    r = random.Random(seed)
    rows = drawn(r, 120, 9, ["x", "y z", None, "", "two  words\tand a\nline"])
    rows += rows[::7] + [(None, 1, "user", "x"), (None, None, None, None)]
    check(spark, rows)


def grown(paths, cuts, most):
    """Rows of the forests of parts of a sorted list, merged, without Spark."""
    import numpy as np

    ordered = sorted(paths)
    bounds = [0, *sorted(cuts), len(ordered)]
    rows, forests = [], []
    for part, (a, b) in enumerate(zip(bounds, bounds[1:])):
        f = prefix_trie.Forest(part)
        for k, (path, c) in enumerate(ordered[a:b]):
            f.add(path, np.arange(len(path) // prefix_trie.WIDTH, dtype=np.int32) % 3, {len(path) // prefix_trie.WIDTH: prefix_trie.Attached(1, c, ends=str(c).encode())})
            if k % most == most - 1:
                f.merge()
        f.merge()
        forests += f.paths
        rows += f.rows
    last = prefix_trie.Forest(-1)
    for k, p in enumerate(forests):
        attached = [prefix_trie.Attached(*a[1:6], named=bool(a[6]), pieces=bool(a[7])) for a in (w.row(d) for d, w in p.at.items())]
        last.add(p.path, p.words, dict(zip(p.at, attached)))
        if k % 5 == 4:
            last.merge()
    last.merge(last=True)
    rows += last.rows
    names = prefix_trie.OUT.replace(" int", "").replace(" bigint", "").split(", ")
    at = {n.split()[0]: i for i, n in enumerate(names)}
    pieces = {}
    for r in rows:
        if r[at["kind"]] == 2:
            pieces.setdefault(r[at["key"]], []).append((r[at["part"]], r[at["seq"]], r[at["piece"]]))
    ends = {k: hashlib.sha256(b",".join(p for _, _, p in sorted(v))).hexdigest() for k, v in pieces.items()}
    least = {r[at["key"]]: r[at["conv_id"]] for r in rows if r[at["kind"]] == 0 and r[at["key"]] is not None}
    out = []
    for r in rows:
        if r[at["kind"]] == 0:
            parent = r[at["parent_conv_id"]] if r[at["parent_key"]] is None else least[r[at["parent_key"]]]
            out.append((r[at["conv_id"]], r[at["depth"]], parent, *[r[at[c]] for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], r[at["ends_sha256"]] or ends[r[at["key"]]]))
    return out


def test_cuts_change_nothing():
    """Any partitions and parts of them give the same nodes: long chains, combs, many copies, paths that begin others."""
    r = random.Random(5)
    digest = lambda i: hashlib.md5(bytes([i])).digest()
    for round in range(150):
        letters, deep, n = r.choice([1, 2, 3]), r.choice([1, 4, 12]), r.randint(1, 40)
        paths = []
        for c in range(n):
            path = b"".join(digest(r.randrange(letters)) for _ in range(r.randint(0, deep)))
            paths.append((path, c))
        order = lambda rows: sorted(map(str, rows))
        whole = order(grown(paths, [], 1000))
        assert order(grown(paths, [r.randint(0, n) for _ in range(r.randint(0, 6))], r.choice([1, 2, 5]))) == whole
        assert len(whole) == len({p[: 16 * d] for p, _ in paths for d in range(len(p) // 16 + 1)})


def test_copies_hold_half_the_rows(spark):
    """One conversation that half of all ids have and one of 3,000 turns."""
    rows = [(20 * c + 3, t, "user", f"turn {t}") for c in range(600) for t in range(2)]
    rows += [(20 * c + 7, 0, "user", f"own {c % 50}") for c in range(600)] + [(40_001, t, "user", "more of it") for t in range(3000)]
    check(spark, rows)


def test_empty_and_clashing_columns(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, 0, "user", "hi there", "p", 3)], SCHEMA + ", path string, first int")
    assert [tuple(r) for r in prefix_trie.trie(df).collect()][0][0] == 1


def test_long_text(spark):
    check(spark, [(1, 0, "user", "w " * 300_000), (21, 0, "user", "w " * 300_000), (2, None, None, None)])
