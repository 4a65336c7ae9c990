"""Cleaning of captioned lane segments, clip by clip: artefacts are cut back, flicker is smoothed, short pieces join a neighbour."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipspans.operators.features import DT
from clipspans.operators.lanes import KEEP, LEFT, RIGHT, confidence_label
from clipspans.operators.segments import KEYS, run_typed

Row = dict
MEANS = ("average_lane_offset", "average_heading_rate", "average_lateral_rate", "observable_ratio", "lane_confidence")
SUMS, TICKS, FLAGS = ("heading_change", "distance"), ("unavailable_ticks", "lane_ticks"), ("lane_changed", "map_unavailable")
OWN = ("net_left", "max_lateral_rate", "min_lateral_rate", "left_step_ratio", "right_step_ratio", "pulse_rise", "pulse_fall")
NUMBERS = ("start_time", "duration", *MEANS, "max_abs_offset", *SUMS, *OWN)
TEXTS = ("caption", "lane_decision", "pulse_dir")

CHANGES = {"LeftLaneChange": LEFT, "RightLaneChange": RIGHT}
SHIFTS = ("SlightlyShiftLeft", "SlightlyShiftRight")
# fixed values: least ticks by caption
LEAST, DEFAULT_LEAST = {"LeftLaneChange": 5, "RightLaneChange": 5}, 6


def _n(row: Row, name: str, missing: float = 0.0) -> float:
    value = row.get(name)
    return missing if value is None or value != value else float(value)


def join(a: Row, b: Row, caption_of: Row) -> Row:
    """Two neighbours as one: means by duration, sums and ticks added, the rest from ``caption_of``."""
    d, e = _n(a, "duration"), _n(b, "duration")
    out = dict(caption_of, start_time=min(_n(a, "start_time"), _n(b, "start_time")), duration=d + e, max_abs_offset=max(_n(a, "max_abs_offset"), _n(b, "max_abs_offset")))
    for name in MEANS:
        missing = 0.5 if name == "lane_confidence" else 0.0
        out[name] = (_n(a, name, missing) * d + _n(b, name, missing) * e) / (d + e) if d + e > 0 else 0.0
    out |= {name: _n(a, name) + _n(b, name) for name in SUMS} | {name: a[name] + b[name] for name in TICKS} | {name: bool(a[name] or b[name]) for name in FLAGS}
    out["kept"] = caption_of.get("kept", False)
    return out


def part(row: Row, start: float, duration: float, **new) -> Row:
    """A piece of a segment in time, with its share of what adds up."""
    share = duration / max(_n(row, "duration"), 1e-6)
    return dict(row, start_time=start, duration=duration, **{n: _n(row, n) * share for n in (*SUMS, "net_left")}, **{n: round(row[n] * share) for n in TICKS}, **new)


def merge_equal(rows: list[Row]) -> list[Row]:
    out: list[Row] = []
    for r in rows:
        if out and out[-1]["caption"] == r["caption"]:
            out[-1] = join(out[-1], r, out[-1])
        else:
            out.append(r)
    return out


# fixed values: all thresholds of the rules from here to the end of the file
def _late_cut(row: Row, after: Row) -> bool:
    """A very long, hardly moving shift whose end was cut late: a short LaneKeep follows."""
    return (
        row["caption"] in SHIFTS and after["caption"] == "LaneKeep" and _n(row, "duration") >= 10.0 and bool(row["lane_changed"]) and abs(_n(row, "average_lateral_rate")) <= 0.01
        and abs(_n(row, "heading_change")) <= 0.10 and abs(_n(row, "max_abs_offset")) <= 0.60 and 0.5 <= _n(after, "duration") <= 1.2
    )


def _windows(row: Row) -> list[Row]:
    """A very long, hardly moving shift as short windows of it between LaneKeep; any other segment as it is."""
    start, d = _n(row, "start_time"), _n(row, "duration")
    if row["caption"] not in SHIFTS or d < 12.0 or abs(_n(row, "average_lateral_rate")) > 0.005 or not row["lane_changed"]:
        return [row]
    windows = []
    if row["caption"] == "SlightlyShiftRight" and _n(row, "right_step_ratio") >= 0.6:
        windows = [(start, min(2.0, d)), (start + 0.45 * d, 2.0)]
    elif row["caption"] == "SlightlyShiftLeft" and _n(row, "left_step_ratio") <= 0.1 and _n(row, "right_step_ratio") <= 0.15:
        windows = [(start + 0.10 * d, min(3.5, 0.35 * d))]
    if not windows:
        return [row]
    out, at = [], start
    for begin, length in windows:
        end = min(start + d, begin + length)
        out += [part(row, at, begin - at, caption="LaneKeep", lane_decision=KEEP), part(row, begin, end - begin, lane_decision=KEEP)]
        at = end
    out.append(part(row, at, start + d - at, caption="LaneKeep", lane_decision=KEEP))
    return [r for r in out if r["duration"] > 1e-6]


def strong_short_shift(row: Row) -> bool:
    return (
        row["caption"] in SHIFTS and 0.25 <= _n(row, "duration") <= 0.65 and _n(row, "distance") >= 0.5 and abs(_n(row, "average_lateral_rate")) >= 0.06
        and abs(_n(row, "heading_change")) <= 0.18 and _n(row, "observable_ratio", 1.0) >= 0.9
    )


def _smooth(rows: list[Row]) -> None:
    """Lane changes that flip for a moment with little confidence, and shifts just after a lane change, take what came before."""
    for before, row in zip(rows, rows[1:]):
        if before["caption"] in CHANGES and row["caption"] in CHANGES and before["caption"] != row["caption"] and _n(row, "duration") <= 1.5 and _n(row, "lane_confidence", 1.0) < 0.70:
            row["caption"], row["lane_decision"] = before["caption"], CHANGES[before["caption"]]
    for before, row in zip(rows, rows[1:]):
        gap = _n(row, "start_time") - _n(before, "start_time") - _n(before, "duration")
        if before["caption"] in CHANGES and row["caption"] in SHIFTS and _n(row, "duration") <= 1.5 and gap <= 0.3 and abs(_n(row, "average_lateral_rate")) <= 0.18 and abs(_n(row, "heading_change")) <= 0.18:
            row["caption"], row["lane_decision"] = "LaneKeep", KEEP


def _widen(rows: list[Row]) -> list[Row]:
    """Shifts of 0.28 s to 0.5 s borrow up to 0.2 s from LaneKeep before them, then after them, in pieces of at least 0.09 s."""
    out: list[Row] = []
    rest = rows[::-1]
    while rest:
        row = rest.pop()
        if row["caption"] in SHIFTS:
            row["kept"] = row.get("kept", False) or strong_short_shift(row)
            need = min(0.5 - _n(row, "duration"), 0.2) if 0.28 <= _n(row, "duration") < 0.5 else 0.0
            for lender, front in ((out, True), (rest, False)):
                if need <= 1e-6 or not lender or lender[-1]["caption"] != "LaneKeep":
                    continue
                own = lender[-1]
                start, have = _n(own, "start_time"), _n(own, "duration")
                take = min(need, have)
                if take < 0.09:
                    continue
                left = have - take
                if front:
                    row, remains = join(part(own, start + left, take), row, row), part(own, start, left, lane_decision=KEEP)
                else:
                    row, remains = join(row, part(own, start, take), row), part(own, start + take, left, lane_decision=KEEP)
                lender.pop()
                if left > 1e-6:
                    lender.append(remains)
                need -= take
        out.append(row)
    return out


def _absorb(rows: list[Row]) -> list[Row]:
    """Pieces that are too short go to the one before them, the first to the one after; strong short shifts stay."""
    out: list[Row] = []
    rest = rows[::-1]
    while rest:
        row = rest.pop()
        enough = _n(row, "duration") >= LEAST.get(row["caption"], DEFAULT_LEAST) * DT or row.get("kept") or strong_short_shift(row)
        if enough or not out and not rest:
            out.append(row)
        elif out:
            out[-1] = join(out[-1], row, out[-1])
        else:
            after = rest.pop()
            rest.append(join(row, after, after))
    return out


def clean(rows: list[Row]) -> list[Row]:
    rows = [dict(r) for r in rows]
    rows = [part(r, _n(r, "start_time") + _n(r, "duration") - 2.0, 2.0) if a is not None and _late_cut(r, a) else r for r, a in zip(rows, [*rows[1:], None])]
    rows = merge_equal([w for r in rows for w in _windows(r)])
    _smooth(rows)
    return merge_equal(_absorb(_widen(rows)))


def clean_lane(segments: DataFrame) -> DataFrame:
    """Cleaned lane segments; a clip's segments are one list, many clips share a batch. Captions aren't decided anew."""
    columns = [*NUMBERS, *TICKS, *FLAGS, *TEXTS]
    kind = ", ".join([*[f"{c}: double" for c in NUMBERS], *[f"{c}: bigint" for c in TICKS], *[f"{c}: boolean" for c in FLAGS], *[f"{c}: string" for c in TEXTS]])
    lists = segments.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("rows"))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[{c: r[c] for c in columns} for r in clean(list(rows))] for rows in batch])

    out = lists.select(*KEYS, F.inline(F.pandas_udf(run_typed(run), f"array<struct<{kind}>>")("rows")))
    return out.withColumn("lane_confidence_label", confidence_label(F.coalesce("lane_confidence", F.lit(0.5))))
