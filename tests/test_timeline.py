"""Timelines and agreement of spans against one label per frame."""

import random

from clipspans.operators import intervals, keyframes

SCHEMA = "clip_id string, track string, tag string, start int, end int, line_no int"


def drawn(r, n, tags):
    return [(r.choice("ab"), r.choice(["longitudinal", "lane"]), r.choice(tags), s := r.randint(-10, 60), s + r.randint(-3, 25), i) for i in range(n)]


def frames_of(rows, frames):
    out = {}
    for clip, track, tag, start, end, line in sorted(rows, key=lambda x: x[5]):
        for f in range(max(0, start), min(frames, end)):
            out[clip, track, f] = tag
    return out


def test_pieces_and_agreement(spark):
    for seed in range(12):
        r = random.Random(seed)
        p, t = drawn(r, r.choice([0, 1, 8, 40]), ["x", "y", "z"]), drawn(r, r.choice([1, 8, 40]), ["x", "y"])
        one, two = frames_of(p, 70), frames_of(t, 70)
        pieces = intervals.timeline(spark.createDataFrame(p, SCHEMA), 70).collect()
        got = {}
        for x in pieces:
            for f in range(x.start, x.end):
                assert (x.clip_id, x.track, f) not in got
                got[x.clip_id, x.track, f] = x.tag
        assert got == one
        both = [k for k in one if k in two]
        want = {}
        for k in both:
            n, e = want.get(k[1], (0, 0))
            want[k[1]] = n + 1, e + (one[k] == two[k])
        found = intervals.span_agreement(spark.createDataFrame(p, SCHEMA), spark.createDataFrame(t, SCHEMA), 70)
        assert {x.track: (x.frames, x.equal) for x in found.collect()} == want


def test_agreement_of_long_spans(spark):
    """A million frames in a few spans: the cost is that of the spans."""
    s = spark.createDataFrame([("a", "lane", "x", 0, 1_000_000, 0), ("a", "lane", "y", 10, 20, 1)], SCHEMA)
    t = spark.createDataFrame([("a", "lane", "x", 5, 2_000_000, 0)], SCHEMA)
    assert [tuple(r) for r in intervals.span_agreement(s, t, None).collect()] == [("lane", 999_995, 999_985)]


def test_same_as_frames(spark):
    r = random.Random(5)
    rows = [(c, "longitudinal", tag, s, s + r.randint(1, 40), i) for i, (c, tag, s) in enumerate((r.choice("abc"), r.choice(["Stop", "MaintainSpeed", "Reverse"]), r.randint(0, 190)) for _ in range(60))]
    df = spark.createDataFrame(rows, SCHEMA)
    late = df.selectExpr("clip_id", "track", "tag", "start + 3 as start", "`end` + 3 as `end`", "line_no")
    frames = lambda d: intervals.expand_to_frames(d.drop("track"), d).where("longitudinal <> 'Not Available'")
    want = keyframes.agreement(frames(df), frames(late), ("longitudinal",)).first()
    assert tuple(intervals.span_agreement(df, late).first()) == tuple(want)
