"""Lanes ahead against a plain search, and relations without a join of ticks with themselves."""

import random

import pytest

from clipspans.operators import lanes

SCHEMA = "map_id string, lane_id string, center array<struct<x: double, y: double>>, next array<string>, left array<string>, right array<string>"


def drawn(r, n=25):
    names = [f"l{i}" for i in range(n)]
    some = lambda most: r.sample(names + ["-1", "gone"], r.randint(0, most))
    return [(m, name, [(0.0, float(i)), (5.0, float(i))], None if r.random() < 0.1 else some(3), some(2), some(2)) for m in ("a", "b") for i, name in enumerate(names)]


def ahead(rows, m, lane, depth):
    step = {x[1]: set(x[3] or []) - {"-1"} for x in rows if x[0] == m}
    seen, edge = set(), {lane}
    for _ in range(depth):
        edge = set().union(*(step.get(x, set()) for x in edge)) - seen
        seen |= edge
    return seen


@pytest.mark.parametrize("depth", [1, 2, 3, 5, 6, 7])
def test_lanes_within_steps(spark, depth):
    rows = drawn(random.Random(depth))
    got = {}
    for r in lanes.next_lanes(spark.createDataFrame(rows, SCHEMA), depth).collect():
        got.setdefault((r.map_id, r.lane_id), []).append(r.next_id)
    assert all(len(v) == len(set(v)) for v in got.values())
    assert {k: set(v) for k, v in got.items()} == {(m, n): a for m, n, *_ in rows if (a := ahead(rows, m, n, depth))}


def test_relations_of_every_tick(spark):
    """Ticks far from any lane and without a pose stay; the stored neighbours give the same as the lanes."""
    r = random.Random(3)
    rows = drawn(r)
    poses = [(c, "ego", t, m, None if t == 5 else 2.5, r.uniform(-5, 30), 0.0, f"{c}{t}") for c, m in (("c", "a"), ("d", "b"), ("e", "none")) for t in range(30)]
    maps = spark.createDataFrame(rows, SCHEMA)
    df = spark.createDataFrame(poses, "clip_id string, agent_id string, tick int, map_id string, x double, y double, heading double, extra string")
    matched = lanes.match_lanes(df, maps)
    got = lanes.lane_relations(matched, maps)
    assert got.columns == [*df.columns, "candidates", "lane_id", "lane_offset", "current_lanes", "next_lanes", "left_lanes", "right_lanes"]
    found = {(x.clip_id, x.tick): x for x in got.collect()}
    assert len(found) == len(poses)
    by = {(x[0], x[1]): x for x in rows}
    for c, _, t, m, x, y, _, extra in poses:
        row = found[c, t]
        own = sorted(f"l{i}" for i in range(25) if m != "none" and x is not None and abs(y - i) <= 2)
        near = set().union(*(ahead(rows, m, i, 5) for i in own)) if own else set()
        around = [by[m, n] for n in {z for i in own for z in ahead(rows, m, i, 5) | {i}} if (m, n) in by]
        assert (row.extra, row.current_lanes, row.next_lanes) == (extra, own, sorted(near))
        assert row.left_lanes == sorted({z for a in around for z in a[4]}) and row.right_lanes == sorted({z for a in around for z in a[5]})
    again = lanes.lane_relations(matched, None, neighbours=lanes.lane_neighbours(maps))
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))
