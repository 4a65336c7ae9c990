"""Lane cleaning on small lists of segments."""

import random

from clipspans.operators import lane_cleaning as lc


def row(caption, start, duration, **more):
    base = dict.fromkeys(lc.NUMBERS, 0.0) | dict.fromkeys(lc.TICKS, round(duration * 10)) | dict.fromkeys(lc.FLAGS, False)
    return base | {"caption": caption, "lane_decision": "keep_lane", "pulse_dir": "none", "start_time": start, "duration": duration, "observable_ratio": 1.0, "lane_confidence": 0.9} | more


def brief(rows):
    return [(r["caption"], round(r["start_time"], 6), round(r["duration"], 6)) for r in rows]


def test_short_pieces_join_a_neighbour():
    assert brief(lc.clean([row("LaneKeep", 0, 3), row("TurnLeft", 3, 0.4), row("LaneKeep", 3.4, 2)])) == [("LaneKeep", 0, 5.4)]
    assert brief(lc.clean([row("TurnLeft", 0, 0.4), row("LaneKeep", 0.4, 2)])) == [("LaneKeep", 0, 2.4)]
    assert brief(lc.clean([row("TurnLeft", 0, 0.2)])) == [("TurnLeft", 0, 0.2)] and lc.clean([]) == []


def test_flicker_and_settling():
    rows = [row("RightLaneChange", 0, 2), row("LeftLaneChange", 2, 1, lane_confidence=0.6), row("LaneKeep", 3, 2)]
    assert brief(lc.clean(rows)) == [("RightLaneChange", 0, 3), ("LaneKeep", 3, 2)]
    rows[1]["lane_confidence"] = 0.8
    assert len(lc.clean(rows)) == 3
    assert brief(lc.clean([row("LeftLaneChange", 0, 2), row("SlightlyShiftLeft", 2, 1), row("TurnLeft", 3, 2)])) == [("LeftLaneChange", 0, 2), ("LaneKeep", 2, 1), ("TurnLeft", 3, 2)]


def test_strong_short_shift_is_widened_and_kept():
    shift = row("SlightlyShiftLeft", 2, 0.3, distance=1.0, average_lateral_rate=0.08)
    assert brief(lc.clean([row("LaneKeep", 0, 2), shift, row("LaneKeep", 2.3, 2)])) == [("LaneKeep", 0, 1.8), ("SlightlyShiftLeft", 1.8, 0.5), ("LaneKeep", 2.3, 2)]


def test_long_weak_shifts():
    long = row("SlightlyShiftLeft", 0, 11, lane_changed=True)
    assert brief(lc.clean([long, row("LaneKeep", 11, 1), row("TurnLeft", 12, 2)]))[0] == ("SlightlyShiftLeft", 9, 2)
    got = brief(lc.clean([row("SlightlyShiftRight", 0, 20, lane_changed=True, right_step_ratio=0.7)]))
    assert got == [("SlightlyShiftRight", 0, 2), ("LaneKeep", 2, 7), ("SlightlyShiftRight", 9, 2), ("LaneKeep", 11, 9)]


def test_time_is_kept():
    r = random.Random(0)
    for _ in range(200):
        at, rows = 0.0, []
        for _ in range(r.randint(1, 14)):
            d = r.randint(1, 25) / 10
            rows.append(row(r.choice(["LaneKeep", "TurnLeft", *lc.CHANGES, *lc.SHIFTS]), at, d, distance=d))
            at += d
        out = lc.clean(rows)
        assert abs(sum(x["duration"] for x in out) - at) < 1e-6 and abs(sum(x["distance"] for x in out) - at) < 1e-6
        assert all(a["caption"] != b["caption"] for a, b in zip(out, out[1:]))
