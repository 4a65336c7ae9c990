"""Map matching, lane decisions per tick, and lane segments.

lanes: (map_id, lane_id, center array<struct<x, y>>, next, left, right array<string>); poses and ticks carry map_id."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipspans.operators.features import DT, add_lane_kinematics, by_clip, by_tick, wrap
from clipspans.operators.segments import KEYS, cut_on_state_change, run_typed, state_code

CELL = 16.0
HORIZONS = (5, 10, 15, 20)
LEFT, RIGHT, KEEP = "left_lane_change", "right_lane_change", "keep_lane"
NONE = "array<string>"


def _empty() -> Column:
    return F.array().cast(NONE)


def match_lanes(poses: DataFrame, lanes: DataFrame, max_dist: float = 2.0, max_heading_error: float = math.pi / 3) -> DataFrame:
    """Poses with ``candidates``: lanes within both limits as struct(dist, lane_id, offset), nearest first, then by id.

    Each centre-line piece goes to the grid cells that its box, widened by max_dist, meets; a pose to its own cell; so the join
    is an equi-join on (map, cell). A pose's pieces all lie in its cell's task, so its candidates are found there, and no pair of a pose
    and a piece is ever exchanged. Pieces, like all that is unfolded from maps here, are merged and never broadcast: Spark's
    estimate of their size doesn't know what ``explode`` adds. A pose with a missing or infinite coordinate has no candidates. offset is left-positive."""
    piece = lanes.select("map_id", "lane_id", F.explode(F.arrays_zip(F.slice("center", 1, F.greatest(F.size("center") - 1, F.lit(0))).alias("a"), F.slice("center", 2, F.greatest(F.size("center") - 1, F.lit(0))).alias("b"))).alias("s"))
    piece = piece.select(F.col("map_id").alias("_map"), F.col("lane_id").alias("_lane"), F.col("s.a.x").alias("ax"), F.col("s.a.y").alias("ay"), (F.col("s.b.x") - F.col("s.a.x")).alias("sx"), (F.col("s.b.y") - F.col("s.a.y")).alias("sy"))

    def cells(at: str, step: str) -> Column:
        a, b = F.col(at), F.col(at) + F.col(step)
        return F.sequence(F.floor((F.least(a, b) - max_dist) / CELL), F.floor((F.greatest(a, b) + max_dist) / CELL))

    piece = piece.withColumn("_px", F.explode(cells("ax", "sx"))).withColumn("_py", F.explode(cells("ay", "sy")))
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < 1e300)
    good = finite("x") & finite("y") & finite("heading")
    cell = lambda c: F.when(good, F.floor(F.col(c) / CELL))
    here = poses.select(*poses.columns, cell("x").alias("_cx"), cell("y").alias("_cy"))
    px, py = F.col("x") - F.col("ax"), F.col("y") - F.col("ay")
    norm = F.greatest(F.col("sx") * F.col("sx") + F.col("sy") * F.col("sy"), F.lit(1e-9))
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (px * F.col("sx") + py * F.col("sy")) / norm))
    dx, dy = px - share * F.col("sx"), py - share * F.col("sy")
    dist = F.sqrt(dx * dx + dy * dy)
    # poses without a piece stay; of a lane only pieces within the limit count, as its nearest one is among them if any is
    near = (F.col("map_id") == F.col("_map")) & (F.col("_cx") == F.col("_px")) & (F.col("_cy") == F.col("_py")) & (dist <= max_dist)
    pairs = here.join(piece.hint("merge"), near, "left")
    found = F.struct(F.col("_lane").alias("lane_id"), dist.alias("dist"), F.signum(F.col("sx") * py - F.col("sy") * px).alias("side"), F.abs(wrap(F.col("heading") - F.atan2("sy", "sx"))).alias("turn"))
    rows = pairs.groupBy("map_id", "_cx", "_cy", *KEYS, "tick").agg(F.array_sort(F.collect_list(F.when(F.col("_lane").isNotNull(), found))).alias("_all"), _rest(poses))
    nearest = F.filter("_all", lambda m, i: (i == 0) | (F.get("_all", i - 1)["lane_id"] != m["lane_id"]))
    fits = F.filter(nearest, lambda m: m["turn"] <= max_heading_error)
    one = F.array_sort(F.transform(fits, lambda m: F.struct(m["dist"].alias("dist"), m["lane_id"].alias("lane_id"), (m["side"] * m["dist"]).alias("offset"))))
    lists = rows.select(*_columns(poses), one.alias("candidates"))
    out = lists.select(*poses.columns, F.when(F.size("candidates") > 0, F.col("candidates")).alias("candidates"))
    first = F.try_element_at("candidates", F.lit(1))
    return out.withColumns({"lane_id": first["lane_id"], "lane_offset": first["offset"], "current_lanes": F.coalesce(F.array_sort(F.transform("candidates", lambda c: c["lane_id"])), _empty())})


def _rest(rows: DataFrame) -> Column:
    """All columns of one row of a (clip, agent, tick), as the aggregate ``_rest``."""
    return F.first(F.struct(*rows.columns)).alias("_rest")


def _columns(rows: DataFrame) -> list[Column]:
    return [F.col("_rest")[c].alias(c) for c in rows.columns]


Keep = Callable[[DataFrame], DataFrame]


def _reach(lanes: DataFrame, depth: int, keep: Keep = lambda df: df) -> DataFrame:
    """(map_id, lane_id, reach): the sorted lanes within ``depth`` steps ahead; "-1" is no lane. By doubling: lanes within 2n steps are
    those within n and those within n of these, so 5 steps take three joins.
    ``keep`` may store what it gets and return it read back: every doubling takes its input three times."""
    names = ("map_id", "lane_id", "next_id")
    one = lanes.select("map_id", "lane_id", F.explode("next").alias("next_id")).where("next_id <> '-1'").distinct()
    one = keep(one)

    def after(a: DataFrame, b: DataFrame) -> DataFrame:
        """Pairs within as many steps as a and b have together."""
        far = a.withColumnRenamed("next_id", "mid").join(b.select("map_id", F.col("lane_id").alias("mid"), "next_id").hint("merge"), ["map_id", "mid"]).select(*names)
        return a.unionByName(far).distinct()

    reach = one
    for bit in bin(depth)[3:]:
        reach = keep(after(reach, reach))
        if bit == "1":
            reach = after(one, reach)
    return reach.groupBy("map_id", "lane_id").agg(F.array_sort(F.collect_set("next_id")).alias("reach"))


def next_lanes(lanes: DataFrame, depth: int = 5, keep: Keep = lambda df: df) -> DataFrame:
    """(map_id, lane_id, next_id): lanes within ``depth`` steps ahead; "-1" is no lane."""
    return _reach(lanes, depth, keep).select("map_id", "lane_id", F.explode("reach").alias("next_id"))


def lane_neighbours(lanes: DataFrame, depth: int = 5, of: DataFrame | None = None) -> DataFrame:
    """Per lane: next_lanes, and the left and right lanes of itself and of those, once per map. ``of``: (map_id, lane_id) of the lanes
    that are asked for; else all are.

    A step ahead is one join of the lanes reached so far with the map's lanes, which are exchanged once for all steps."""
    step = F.filter("next", lambda n: n != "-1")
    look = lanes.select("map_id", F.col("lane_id").alias("_at"), F.struct(step.alias("next"), "left", "right").alias("_r"))
    at = (lanes if of is None else of).select("map_id", "lane_id").distinct().withColumn("_at", F.col("lane_id"))
    seen = []
    for k in range(depth + 1):
        met = at.repartition("map_id", "_at").distinct().join(look.hint("merge"), ["map_id", "_at"], "left")
        seen.append(met.select("map_id", "lane_id", (F.col("_at") if k else F.lit(None).cast("string")).alias("next_id"), F.col("_r.left").alias("left"), F.col("_r.right").alias("right")))
        at = met.select("map_id", "lane_id", F.explode("_r.next").alias("_at"))
    sides = reduce(DataFrame.unionByName, seen)
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce(F.col(c), _empty())))))
    return sides.groupBy("map_id", "lane_id").agg(flat("left").alias("left_lanes"), flat("right").alias("right_lanes"), F.array_sort(F.collect_set("next_id")).alias("next_lanes"))


def current_lanes(matched: DataFrame) -> DataFrame:
    """(clip_id, agent_id, map_id, lane_id): the lanes that each clip's ticks are on."""
    return matched.select(*KEYS, "map_id", F.explode("current_lanes").alias("lane_id")).distinct()


def lane_relations(matched: DataFrame, lanes: DataFrame | None, depth: int = 5, neighbours: DataFrame | None = None) -> DataFrame:
    """Matched ticks with the sets next_lanes, left_lanes and right_lanes of their current lanes. ``neighbours``: the result of
    ``lane_neighbours``, where it is there; else it is found from ``lanes``.

    A clip gets its lanes' neighbours as one list, once, and its ticks pick from it."""
    names = ("next_lanes", "left_lanes", "right_lanes")
    own = current_lanes(matched)
    near = lane_neighbours(lanes, depth, own) if neighbours is None else neighbours
    lists = own.join(near.hint("merge"), ["map_id", "lane_id"]).groupBy(*KEYS).agg(F.collect_list(F.struct("map_id", "lane_id", *names)).alias("_near"))
    rows = matched.join(lists.hint("merge"), KEYS, "left")
    rows = rows.withColumn("_near", F.filter("_near", lambda n: (n["map_id"] == F.col("map_id")) & F.array_contains("current_lanes", n["lane_id"])))
    flat = lambda c: F.coalesce(F.array_sort(F.array_distinct(F.flatten(F.transform("_near", lambda n: n[c])))), _empty()).alias(c)
    return rows.select(*matched.columns, *[flat(n) for n in names])


def instant_decision() -> Column:
    """By the current lanes among the left and right ones; among both, by the chosen lane, else left."""
    left, right = F.size(F.array_intersect("current_lanes", "left_lanes")) > 0, F.size(F.array_intersect("current_lanes", "right_lanes")) > 0
    chosen_right = F.coalesce(F.array_contains("right_lanes", F.col("lane_id")) & ~F.array_contains("left_lanes", F.col("lane_id")), F.lit(False))
    return F.when(left & ~right, LEFT).when(right & ~left, RIGHT).when(left & right, F.when(chosen_right, RIGHT).otherwise(LEFT)).otherwise(KEEP)


def _resolve(left: Column, right: Column, instant: Column, otherwise: Column) -> Column:
    return F.when((left > 0) & (right == 0), LEFT).when((right > 0) & (left == 0), RIGHT).when((left > 0) & (right > 0), F.when(instant != KEEP, instant).when(left >= right, LEFT).otherwise(RIGHT)).otherwise(otherwise)


def look_ahead(ticks: DataFrame, horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    """Matched ticks with ``ahead``, the current lanes of a look at each horizon, and ``goal``, the lane LOOK_AHEAD ticks ahead. A look past
    the end takes the last tick. Before ``lane_relations`` this sorts narrow rows, after it those with all sets."""
    seen = F.struct("current_lanes", "lane_id")
    last = F.last(seen).over(by_clip_ordered())
    look = lambda h: F.coalesce(F.lead(seen, h).over(by_tick()), last)
    t = ticks.withColumns({**{f"_e{h}": look(h) for h in horizons}, "_goal": look(LOOK_AHEAD)})
    return t.select(*ticks.columns, F.array(*[F.col(f"_e{h}.current_lanes") for h in horizons]).alias("ahead"), F.col("_goal.lane_id").alias("goal"))


def temporal_vote(ticks: DataFrame, horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    """Ticks with instant, left_hits, right_hits and voted: how many looks ahead end in a left or right lane of this tick. by_goal is what
    the lane LOOK_AHEAD ticks ahead says: left or right if it is such a lane and neither a current nor a next one, else the instant decision.

    A look past the end takes the last tick; a look at a tick without lanes votes the instant decision. Where ticks have ``ahead`` and ``goal``
    of ``look_ahead`` for the same horizons, these are taken."""
    t = ticks if {"ahead", "goal"} <= set(ticks.columns) else look_ahead(ticks, horizons)
    t = t.withColumn("instant", instant_decision()).withColumns({f"_e{h}": F.get("ahead", F.lit(i)) for i, h in enumerate(horizons)})
    votes = []
    for h in horizons:
        new = F.filter(f"_e{h}", lambda e: ~F.array_contains("current_lanes", e) & ~F.array_contains("next_lanes", e))
        left = F.size(F.filter(new, lambda e: F.array_contains("left_lanes", e)))
        right = F.size(F.filter(new, lambda e: F.array_contains("right_lanes", e) & ~F.array_contains("left_lanes", e)))
        votes.append(F.when(F.size(f"_e{h}") == 0, F.col("instant")).otherwise(_resolve(left, right, F.col("instant"), F.lit(KEEP))))
    # one array of votes, so that none is worked out once for each side
    t = t.withColumn("_votes", F.array(*votes))
    count = lambda side: F.size(F.filter("_votes", lambda v: v == side))
    t = t.withColumns({"left_hits": count(LEFT), "right_hits": count(RIGHT)})
    has = lambda c: F.array_contains(c, F.col("goal"))
    by_goal = F.when(F.col("goal").isNull() | has("current_lanes") | has("next_lanes"), F.col("instant")).when(has("left_lanes"), LEFT).when(has("right_lanes"), RIGHT).otherwise(F.col("instant"))
    t = t.withColumns({"voted": _resolve(F.col("left_hits"), F.col("right_hits"), F.col("instant"), F.col("instant")), "by_goal": by_goal})
    return t.drop("ahead", "goal", "_votes", *[f"_e{h}" for h in horizons])


def by_clip_ordered():
    return by_tick().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


# fixed values: metres and ticks of the run rules
MIN_SHIFT_M, SHORT_RUN, LONG_RUN, MIN_RUN, LOOK_AHEAD = 0.35, 24, 60, 4, 20


class _Clip:
    """One clip's arrays, for the rules that look at runs of ticks."""

    def __init__(self, x: np.ndarray, y: np.ndarray, heading: np.ndarray, lane: list, offset: np.ndarray, voted: list, by_goal: list, hits: np.ndarray) -> None:
        self.x, self.y, self.heading, self.offset = (np.asarray(v, float) for v in (x, y, heading, offset))
        self.lane, self.voted, self.by_goal, self.hits = list(lane), list(voted), list(by_goal), np.asarray(hits)

    def shift(self, a: int, b: int) -> float | None:
        """Metres to the left from tick a to b in the frame of a; by the lane offsets where poses are missing."""
        if b <= a:
            return 0.0
        moved = -(self.x[b] - self.x[a]) * math.sin(self.heading[a]) + (self.y[b] - self.y[a]) * math.cos(self.heading[a])
        return float(moved) if np.isfinite(moved) else self.offset_shift(a, b)

    def offset_shift(self, a: int, b: int) -> float | None:
        known = np.flatnonzero(np.isfinite(self.offset[a : b + 1]))
        return float(self.offset[a + known[0]] - self.offset[a + known[-1]]) if len(known) > 1 or len(known) == 1 else None

    def first_change(self, a: int, last: int) -> int | None:
        """The first tick after a, up to last, in another known lane than a's."""
        if self.lane[a] is None:
            return None
        return next((j for j in range(a + 1, last + 1) if self.lane[j] is not None and self.lane[j] != self.lane[a]), None)

    def decide(self, i: int) -> str:
        """The vote; one without hits goes by the movement up to the next lane, then by the lane some ticks ahead."""
        if self.voted[i] == KEEP or self.hits[i]:
            return self.voted[i]
        last = min(i + LOOK_AHEAD, len(self.lane) - 1)
        to = self.first_change(i, last)
        to = last if to is None else to
        if self.lane[i] is not None and self.lane[to] is not None:
            for moved in (self.shift(i, to), self.offset_shift(i, to)):
                if moved is not None and abs(moved) >= MIN_SHIFT_M:
                    return LEFT if moved > 0 else RIGHT
        return self.by_goal[i]

    def align(self, decisions: list[str]) -> tuple[list[str], list[str]]:
        """Runs of lane changes in which no tick has a hit take one direction, or are suppressed; with a reason per tick."""
        out, reasons = list(decisions), ["not_lane_change"] * len(decisions)
        for a, b in _runs([d != KEEP for d in decisions], True):
            label, reason = None, ""
            lanes = self.lane[a], self.lane[b - 1]
            change = self.first_change(a, b - 1)
            local = None if change is None else self.shift(a, change)
            moved = self.shift(a, b - 1)
            if local is not None and abs(local) >= abs(moved or 0.0):
                moved = local
            if self.hits[a:b].any():
                reason = "kept_has_temporal_hits"
            elif b - a >= LONG_RUN:
                label, reason = KEEP, "suppressed_long_zero_evidence_run"
            elif b - a <= SHORT_RUN:
                signal = moved if local is None else local
                reason = "kept_short_zero_evidence_no_signal"
                if signal is not None:
                    label, reason = LEFT if signal > 0 else RIGHT, "short_zero_evidence_direction_from_displacement"
            elif moved is None or abs(moved) < MIN_SHIFT_M:
                label, reason = KEEP, "suppressed_medium_weak_displacement"
            elif None in lanes or lanes[0] == lanes[1]:
                label, reason = KEEP, "suppressed_medium_no_lane_transition"
            else:
                label, reason = LEFT if moved > 0 else RIGHT, "medium_zero_evidence_direction_from_displacement"
            reasons[a:b] = [reason] * (b - a)
            if label:
                out[a:b] = [label] * (b - a)
        return out, reasons


def _runs(values: list, of) -> list[tuple[int, int]]:
    """Half-open ranges of equal neighbours; only those that equal ``of`` unless it is None."""
    cuts = [0, *[i for i in range(1, len(values)) if values[i] != values[i - 1]], len(values)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b and (of is None or values[a] == of)]


def drop_short_runs(decisions: list[str], least: int = MIN_RUN) -> list[str]:
    """Lane-change runs under ``least`` ticks take their neighbours' label where both agree, else keep_lane, from the left."""
    out = list(decisions)
    for a, b in _runs(decisions, None):
        if out[a] != KEEP and b - a < least:
            before, after = out[a - 1] if a else None, out[b] if b < len(out) else None
            out[a:b] = [before if before is not None and before == after else KEEP] * (b - a)
    return out


def lane_decisions(ticks: DataFrame) -> DataFrame:
    """Voted ticks with lane_decision and reason. A clip's ticks are one list, many clips share a batch; the list is unfolded again, so ticks
    aren't joined with themselves, and Python gets only the numbers and labels that the rules use."""
    lists = ticks.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("tick", F.struct(*ticks.columns).alias("r")))).alias("rows"))
    each = lambda of: F.transform("rows", lambda x: of(x["r"]))
    names = ("x", "y", "heading", "lane_id", "lane_offset", "voted", "by_goal")
    given = [*[each(lambda r, c=c: r[c]) for c in names], each(lambda r: r["left_hits"] + r["right_hits"])]

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for arrays in zip(*batch):
                clip = _Clip(*arrays)
                aligned, reasons = clip.align([clip.decide(i) for i in range(len(clip.lane))])
                out.append((drop_short_runs(aligned), reasons))
            yield pd.DataFrame(out, columns=["lane_decision", "reason"])

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.DataFrame]}
    decide = F.pandas_udf(run, "lane_decision array<string>, reason array<string>")
    done = lists.withColumn("d", decide(*given)).select(F.inline(F.arrays_zip("rows", F.col("d.lane_decision").alias("lane_decision"), F.col("d.reason").alias("reason"))))
    return done.select("rows.r.*", "lane_decision", "reason")


def lane_confidence(ticks: DataFrame) -> DataFrame:
    """Ticks with lane_confidence (0.05 to 0.99) and its label; needs lateral_rate and step_distance."""
    ok = F.col("lane_id").isNotNull() & F.col("lane_offset").isNotNull() & ~F.isnan("lane_offset")
    change = F.col("lane_decision") != KEEP
    moved = F.abs(F.coalesce("lateral_rate", F.lit(0.0))) * F.greatest(F.coalesce("step_distance", F.lit(0.0)), F.lit(0.0))
    by = lambda good, bad: F.when(ok, good).otherwise(bad)
    has = lambda text: F.contains("reason", F.lit(text))
    score = (
        F.when(change & (F.col("left_hits") + F.col("right_hits") > 0), by(0.92, 0.80))
        .when(change & has("direction_from_displacement"), by(0.78, 0.70) + F.when(moved >= 0.35, 0.05).otherwise(0.0))
        .when(change, by(0.66, 0.56) - F.when(moved < 0.10, 0.08).otherwise(0.0))
        .when(has("suppressed_"), F.greatest(by(0.86, 0.62), F.lit(0.74))).otherwise(by(0.86, 0.62))
    )
    score = F.greatest(F.lit(0.05), F.least(F.lit(0.99), score))
    return ticks.withColumn("lane_confidence", score).withColumn("lane_confidence_label", confidence_label(F.col("lane_confidence")))


def confidence_label(score: Column) -> Column:
    return F.when(score >= 0.80, "high").when(score >= 0.60, "medium").otherwise("low")


SETS = ("candidates", "current_lanes", "next_lanes", "left_lanes", "right_lanes")


def label_lane_ticks(poses: DataFrame | None, lanes: DataFrame | None, neighbours: DataFrame | None = None, matched: DataFrame | None = None, sets: bool = True) -> DataFrame:
    """All per-tick lane columns: match, relations, vote, decision, kinematics and confidence. This is also the debug table; without
    ``sets`` it lacks the lists of lanes, and rows stay narrow. ``neighbours`` as in ``lane_relations``; ``matched``: the result of
    ``match_lanes``, where it is stored. Ticks are known by clip, agent and number, of which each has one pose."""
    matched = match_lanes(poses, lanes) if matched is None else matched
    voted = temporal_vote(lane_relations(look_ahead(add_lane_kinematics(matched)), lanes, neighbours=neighbours))
    return lane_confidence(lane_decisions(voted if sets else voted.drop(*SETS))).drop("by_goal")


def offset_pulse(offsets: Column) -> Column:
    """struct(rise, fall, first_dir) of an array of offsets, nulls skipped: the largest gain of a rising or falling stretch, and
    which one first goes on for 4 steps and 0.12 m; left on ties."""
    known = F.filter(offsets, lambda v: v.isNotNull() & ~F.isnan(v))
    steps = F.transform(F.when(F.size(known) > 1, F.sequence(F.lit(1), F.size(known) - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.get(known, i) - F.get(known, i - 1))
    zero, no = F.lit(0.0), F.lit(None).cast("int")
    names = ("up", "down", "ups", "downs", "rise", "fall", "left", "right", "i")
    begin = F.struct(*[v.alias(n) for n, v in zip(names, (zero, zero, F.lit(0), F.lit(0), zero, zero, no, no, F.lit(0)))])

    def step(a: Column, d: Column) -> Column:
        up, down = F.when(d > 0, a["up"] + d).otherwise(zero), F.when(d < 0, a["down"] - d).otherwise(zero)
        ups, downs = F.when(d > 0, a["ups"] + 1).otherwise(0), F.when(d < 0, a["downs"] + 1).otherwise(0)
        left = F.coalesce(a["left"], F.when((ups >= 4) & (up >= 0.12), a["i"]))
        right = F.coalesce(a["right"], F.when((downs >= 4) & (down >= 0.12), a["i"]))
        return F.struct(*[v.alias(n) for n, v in zip(names, (up, down, ups, downs, F.greatest(a["rise"], up), F.greatest(a["fall"], down), left, right, a["i"] + 1))])

    def finish(a: Column) -> Column:
        first = F.when(a["left"].isNull() & a["right"].isNull(), "none").when(a["right"].isNull() | (a["left"] <= a["right"]), "left").otherwise("right")
        return F.struct(a["rise"].alias("rise"), a["fall"].alias("fall"), first.alias("first_dir"))

    return F.aggregate(steps, begin, step, finish)


def segment_lane(ticks: DataFrame) -> DataFrame:
    """Lane segments of labelled lane ticks, with the features that the rules use; missing values are left out of all of them."""
    code = F.when(F.col("lane_decision") == LEFT, 4).when(F.col("lane_decision") == RIGHT, 8).otherwise(0)
    t = ticks.withColumn("state", state_code([F.col("heading_rate") >= 0.01, F.col("heading_rate") >= -0.01]) + code)
    carried = ("lane_offset", "heading_rate", "heading_delta", "lateral_rate", "step_left", "step_distance", "lane_decision", "lane_id", "lane_confidence")
    spans = cut_on_state_change(t, first_gap=3, carry=carried)
    rows = spans.select(*KEYS, "seg", "start", "end", F.posexplode(F.slice("rows", F.lit(1), F.col("end") - F.col("start"))).alias("i", "r")).select(*KEYS, "seg", "start", "end", "i", "r.*")
    known = lambda c: F.when(~F.isnan(c), F.col(c))
    lane = F.coalesce("lane_id", F.lit(""))
    agg = rows.groupBy(*KEYS, "seg", "start", "end").agg(
        F.avg(known("lane_offset")).alias("average_lane_offset"), F.max(F.abs(known("lane_offset"))).alias("max_abs_offset"), F.avg("heading_rate").alias("average_heading_rate"), F.sum("heading_delta").alias("heading_change"),
        F.avg(known("lateral_rate")).alias("average_lateral_rate"), F.coalesce(F.max(known("lateral_rate")), F.lit(0.0)).alias("max_lateral_rate"), F.coalesce(F.min(known("lateral_rate")), F.lit(0.0)).alias("min_lateral_rate"),
        F.sum("step_left").alias("net_left"), F.avg((F.col("step_left") > 1e-3).cast("int")).alias("left_step_ratio"), F.avg((F.col("step_left") < -1e-3).cast("int")).alias("right_step_ratio"), F.sum("step_distance").alias("distance"),
        F.min_by("lane_decision", "i").alias("lane_decision"), (F.min(lane) != F.max(lane)).alias("lane_changed"), F.count("lane_id").alias("seen"), F.count(F.lit(1)).alias("lane_ticks"), F.avg("lane_confidence").alias("lane_confidence"),
        offset_pulse(F.transform(F.array_sort(F.collect_list(F.struct("i", "lane_offset"))), lambda x: x["lane_offset"])).alias("pulse"),
    )
    ratio = F.col("seen") / F.col("lane_ticks")
    return agg.withColumns({
        "start_time": F.col("start") * DT, "duration": (F.col("end") - F.col("start")) * DT, "observable_ratio": ratio, "unavailable_ticks": F.col("lane_ticks") - F.col("seen"), "map_unavailable": ratio < 0.5,
        "pulse_rise": F.col("pulse.rise"), "pulse_fall": F.col("pulse.fall"), "pulse_dir": F.col("pulse.first_dir"), "lane_confidence_label": confidence_label(F.coalesce("lane_confidence", F.lit(0.5))),
    }).drop("pulse", "seen", "seg", "start", "end")


# fixed values: all thresholds of the rules in classify_lane
def classify_lane(segments: DataFrame) -> DataFrame:
    """Lane captions, by the first of: lane change, turn, slight shift, else LaneKeep. A missing number counts as 0."""
    n = lambda c: F.coalesce(F.when(~F.isnan(c), F.col(c)), F.lit(0.0))
    rate, distance, duration, offset = n("average_lateral_rate"), F.greatest(n("distance"), F.lit(0.0)), n("duration"), F.abs(n("max_abs_offset"))
    bend, turn, seen = F.abs(n("average_heading_rate")), F.abs(n("heading_change")), n("observable_ratio")
    rise, fall, first = n("pulse_rise"), n("pulse_fall"), F.coalesce("pulse_dir", F.lit("none"))
    changed, decision = F.coalesce("lane_changed", F.lit(False)), F.coalesce("lane_decision", F.lit(KEEP))
    keep = decision == KEEP
    moving = (offset >= 1.0) | ((F.abs(rate) >= 0.02) & (F.abs(rate) * distance >= 0.5))
    straight = (bend < 0.02) & (turn < 0.10)
    net = straight & (F.abs(rate) * distance >= 0.20)

    def peak(sign: int) -> Column:
        top = n("max_lateral_rate") if sign > 0 else -n("min_lateral_rate")
        return keep & ~changed & (seen >= 0.90) & (duration <= 1.2) & (n("distance") >= 0.8) & (bend < 0.02) & (turn < 0.14) & (top >= 0.095) & (sign * rate >= 0.03)

    def weak(side: str) -> Column:
        return ~moving & (duration <= 0.7) & (seen >= 0.90) & (offset <= 0.35) & straight & decision.isin(KEEP, side)

    def pulse(side: str, gain: Column, other: Column, more: Column) -> Column:
        return keep & changed & (seen >= 0.90) & (duration >= 1.0) & (bend < 0.02) & (turn < 0.34) & more & (first == side) & (gain >= 0.5) & (gain >= 0.8 * other)

    curved = keep & changed & (seen >= 0.90) & (rate >= 0.055) & (rate < 0.0895) & duration.between(1.0, 3.0) & (n("distance") >= 2.0) & (bend <= 0.16) & turn.between(0.12, 0.35) & (offset <= 1.35) & (first == "left") & (rise >= 0.3) & (rise >= 1.5 * fall)
    middle = keep & changed & (seen >= 0.90) & (rate >= 0.05) & (rate < 0.075) & duration.between(2.0, 3.2) & n("distance").between(3.0, 6.0) & (bend <= 0.07) & turn.between(0.12, 0.22) & (n("left_step_ratio") >= 0.08) & (rise >= 0.3) & (offset <= 0.45)
    right_ok = ~changed | (duration < 5.0) | (offset > 0.40) | (n("right_step_ratio") >= 0.20)
    shift_left = (
        F.when(rate >= 0.095, n("distance") >= 0.8).when(rate >= 0.0895, net).when(rate < 0.06, peak(1) | pulse("left", rise, fall, F.lit(True)) | middle).when(changed, weak(LEFT) | curved | middle).otherwise(net)
    )
    shift_right = (
        F.when(rate <= -0.095, (n("distance") >= 0.8) & right_ok).when(rate <= -0.0895, net).when(rate > -0.06, peak(-1) | pulse("right", fall, rise, turn >= 0.10)).when(changed, weak(RIGHT)).otherwise(net)
    )
    turning = lambda sign: (sign * n("average_heading_rate") >= 0.04) & (sign * n("heading_change") >= 0.2) & changed & (F.abs(rate) <= 0.06) & (sign * rate >= -0.02)
    caption = (
        F.when((decision == LEFT) & moving, "LeftLaneChange").when((decision == RIGHT) & moving, "RightLaneChange").when(turning(1), "TurnLeft").when(turning(-1), "TurnRight")
        .when(shift_left, "SlightlyShiftLeft").when(shift_right, "SlightlyShiftRight").otherwise("LaneKeep")
    )
    return segments.withColumn("caption", caption)
