"""Index documents of any shape against a plain walk."""

import json
import random

import pytest

from clipspans.sources import tables


def plain(data, bucket=None):
    """(bucket, entry) pairs by recursion."""
    if isinstance(data, list):
        return [(bucket, x) for x in data]
    if not isinstance(data, dict):
        return []
    if "clip_id" in data or "filename" in data:
        return [(bucket, data)]
    out = []
    for k, v in data.items():
        out += [(k, x) for x in v] if isinstance(v, list) else plain(v, k) if isinstance(v, dict) else []
    return out


def drawn(r, depth):
    kind = r.random()
    if depth and kind < 0.45:
        return {r.choice(["stop", "Stop", "x.y", "", "clip_id" if r.random() < 0.1 else "b", "é\"q"]): drawn(r, depth - 1) for _ in range(r.randint(0, 4))}
    if depth and kind < 0.7:
        return [drawn(r, depth - 1) for _ in range(r.randint(0, 4))]
    return r.choice([None, True, 7, 1.5, "a/c1.mp4", "", {"filename": "f.txt", "action": "go"}, {"file_name": "g.json"}, {"clip_id": None}, {"video_id": 12}])


def docs_of(spark, values):
    return spark.createDataFrame([(json.dumps(v),) for v in values], "value string")


def test_entries(spark):
    r = random.Random(12)
    values = [drawn(r, r.randint(0, 6)) for _ in range(200)] + [{}, [], None, 3, "x", {"a": {"b": {"c": {"d": {"e": {"clip_id": 1}}}}}}]
    from pyspark.sql import functions as F

    got = tables.index_entries(docs_of(spark, values)).select("bucket", F.to_json("entry").alias("e")).collect()
    key = lambda b, e: json.dumps([b, e], sort_keys=True)
    assert sorted(key(x.bucket, json.loads(x.e)) for x in got) == sorted(key(b, e) for v in values for b, e in plain(v))


def test_too_deep_and_broken_documents(spark):
    deep = {"clip_id": "c"}
    for _ in range(30):
        deep = {"b": deep}
    assert tables.index_entries(docs_of(spark, [deep])).count() == 1
    with pytest.raises(Exception, match="more than 20 buckets"):
        tables.index_entries(docs_of(spark, [deep]), levels=20).collect()
    with pytest.raises(Exception, match="MALFORMED|parse"):
        tables.index_entries(spark.createDataFrame([('{"a": [',)], "value string")).collect()


def test_clip_ids(spark):
    index = {"stop": ["a/c1.mp4", {"clip_id": " ", "file_name": "c2.json"}, 5, None], "Go": {"more": [{"video_id": 12}], "one": {"filename": "x/c3.txt", "action": "STOP"}}, "n": 4}
    ids = lambda *names: sorted(x.clip_id for x in tables.index_clip_ids(docs_of(spark, [index, ["c9.mp4", {"clip_id": "c8", "meta_action": "Stop"}]]), *names).collect())
    assert ids() == ["12", "c1", "c2", "c3", "c8", "c9"]
    assert ids(["Stop"]) == ["c1", "c2", "c3", "c8"] and ids(["more"]) == ["12"] and ids([]) == []


def test_keyframes_of_odd_records(spark):
    index = {
        "stop": [
            {"clip_id": "a", "event_start_frame": 3, "event_end_frame": 9}, {"filename": "b.txt", "start": "4", "duration": 5}, {"clip_id": "c", "event_start_frame": "x", "event_end_frame": 9},
            {"clip_id": "d", "event_start_frame": None, "start": 3, "end": 4}, {"clip_id": "e", "start": 1}, {"clip_id": "f", "start": 1, "end": "soon", "duration": 3}, {"clip_id": "g", "start": 1.0, "end": 2.9, "action": "Go", "meta_action": None}, "h", 7,
        ],
        "deep": {"er": {"clip_id": "i", "start": 0, "end": 0}},
    }
    got = sorted(tuple(x)[:5] for x in tables.parse_keyframes(docs_of(spark, [index, [{"clip_id": "j", "start": 1, "end": 2}]])).collect() if x.meta_action)
    assert got == [("Go", "g", 1, 2, 1), ("er", "i", 0, 0, 0), ("stop", "a", 3, 9, 6), ("stop", "b", 4, 9, 5)]
