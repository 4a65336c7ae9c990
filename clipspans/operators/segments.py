"""State-change segmentation of ticks, segment features, and cleaning of captioned segments."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipspans.operators import classify
from clipspans.operators.features import DT, add_acceleration, add_speed, add_turn_rate, hysteresis, rolling_mean

KEYS = ["clip_id", "agent_id"]


def state_code(conditions: list[Column]) -> Column:
    """The conditions as the bits of one number; null counts as false."""
    out = F.lit(0)
    for bit, c in enumerate(conditions):
        out = out + F.when(c, 1 << bit).otherwise(0)
    return out


def cut_on_state_change(ticks: DataFrame, state: str = "state", first_gap: int = 1, gap: int = 3, tail: int = 3, closed: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Spans (clip_id, agent_id, seg, start, end) of each clip's ticks, counted from 0.

    With carry, each span also has ``rows``: those columns of its ticks in order, the end tick included where it is one.

    A span is cut at the first tick, at least first_gap (the first span) or gap ticks after its start, whose state isn't that
    of the span's start, unless no more than ``tail`` ticks are left there. The last span ends at the last tick (closed) or
    behind it. States are one array per clip, and the cuts are found in one pass over it."""
    rows = F.array_sort(F.collect_list(F.struct("tick", F.col(state).cast("int").alias("s"), F.struct(*(carry or ("tick",))).alias("r"))))
    clips = ticks.groupBy(*KEYS).agg(rows.alias("rows")).select(*KEYS, F.transform("rows", lambda x: x["s"]).alias("states"), F.transform("rows", lambda x: x["r"]).alias("rows"))
    n = F.size("states")
    begin = F.struct(F.lit(0).alias("start"), F.element_at("states", 1).alias("s"), F.lit(first_gap).alias("gap"), F.array().cast("array<int>").alias("cuts"))

    def step(acc: Column, i: Column) -> Column:
        now = F.get("states", i)
        cut = (now != acc["s"]) & (i >= acc["start"] + acc["gap"])
        return F.when(cut, F.struct(i.alias("start"), now.alias("s"), F.lit(gap).alias("gap"), F.concat(acc["cuts"], F.array(i)).alias("cuts"))).otherwise(acc)

    inner = F.when(n - tail - 1 >= 1, F.sequence(F.lit(1), n - tail - 1)).otherwise(F.array().cast("array<int>"))
    cuts = F.aggregate(inner, begin, step, lambda acc: acc["cuts"])
    starts = F.concat(F.array(F.lit(0)), F.col("cuts"))
    ends = F.concat(F.col("cuts"), F.array(n - 1 if closed else n))
    bounds = F.transform(F.arrays_zip(starts.alias("start"), ends.alias("end")), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.slice("rows", x["start"] + 1, x["end"] - x["start"] + 1).alias("rows")))
    spans = clips.withColumn("cuts", cuts).select(*KEYS, F.posexplode(bounds).alias("seg", "x"))
    return spans.select(*KEYS, "seg", F.col("x.start").alias("start"), F.col("x.end").alias("end"), *([F.col("x.rows").alias("rows")] if carry else [])).where("end > start")


def _total(column: str) -> Column:
    """Sum of a carried column over a span's ticks, without the end tick."""
    return F.aggregate(F.slice("rows", F.lit(1), F.col("end") - F.col("start")), F.lit(0.0), lambda total, r: total + r[column])


def longitudinal_states(ticks: DataFrame) -> DataFrame:
    """Ticks with speed, acceleration and the state of the six thresholds."""
    t = rolling_mean(add_acceleration(add_speed(ticks)), "acceleration", "smooth")
    along = [F.col("speed_along") >= v for v in (0.3, -0.3)]
    acc = [hysteresis("smooth", v) for v in (0.1, -0.1, 1.25, -1.25)]
    return t.withColumn("state", state_code(along + acc))


def segment_longitudinal(ticks: DataFrame) -> DataFrame:
    s = cut_on_state_change(longitudinal_states(ticks), carry=("speed", "speed_along"))
    n = F.col("end") - F.col("start")
    change = F.element_at("rows", -1)["speed"] - F.element_at("rows", 1)["speed"]
    rows = s.select(*KEYS, (F.col("start") * DT).alias("start_time"), (n * DT).alias("duration"), change.alias("delta_velocity"), (_total("speed") / n).alias("average_speed"), (_total("speed_along") / n).alias("average_speed_along_heading"))
    return rows.withColumn("average_acceleration", F.col("delta_velocity") / F.col("duration"))


def lateral_states(ticks: DataFrame) -> DataFrame:
    t = add_turn_rate(add_speed(ticks))
    return t.withColumn("state", state_code([F.col("speed_along") >= -0.1, *[F.col("turn_rate") >= v for v in (0.001, -0.001, 0.05, -0.05)]]))


def segment_lateral(ticks: DataFrame) -> DataFrame:
    s = cut_on_state_change(lateral_states(ticks), closed=False, carry=("turn", "distance", "speed_along"))
    n = F.col("end") - F.col("start")
    rows = s.select(*KEYS, (F.col("start") * DT).alias("start_time"), (n * DT).alias("duration"), _total("turn").alias("total_heading_change"), _total("distance").alias("total_distance"), (_total("speed_along") / n).alias("average_speed_along_heading"))
    return rows.withColumn("average_turn_rate", F.when(F.col("total_distance") > 1e-6, F.col("total_heading_change") / F.col("total_distance")).otherwise(0.0))


@dataclass(frozen=True)
class Span:
    """A captioned piece of time. sums grow with every piece that joins; means are weighted by duration; kept values aren't touched."""

    start: float
    duration: float
    caption: str
    sums: tuple[float, ...]
    means: tuple[float, ...] = ()
    kept: tuple = ()

    def plus(self, other: Span, share: float = 1.0) -> Span:
        """This span with a share of the other one added; caption and start stay."""
        more = other.duration * share
        total = self.duration + more
        return replace(
            self, duration=total, sums=tuple(a + share * b for a, b in zip(self.sums, other.sums)), means=tuple((a * self.duration + b * more) / total if total > 0 else 0.0 for a, b in zip(self.means, other.means))
        )


def merge_equal(spans: list[Span]) -> list[Span]:
    out: list[Span] = []
    for s in spans:
        if out and out[-1].caption == s.caption:
            out[-1] = out[-1].plus(s)
        else:
            out.append(s)
    return out


def clean(spans: list[Span], least: dict[str, int], default: int) -> list[Span]:
    """Equal neighbours merge; then, from the left, spans shorter than their caption allows go to their neighbours; then merge again.

    Between equal neighbours a short span fuses all three, and the fused one is looked at again; between different ones each
    takes half; at an end the only neighbour takes all; a lone span stays."""
    done: list[Span] = []  # looked at, long enough so far as known
    todo = merge_equal(spans)[::-1]  # the next one is last
    while todo:
        now = todo.pop()
        if now.duration >= least.get(now.caption, default) * DT or not done and not todo:
            done.append(now)
        elif done and todo:
            if done[-1].caption == todo[-1].caption != "":
                todo.append(done.pop().plus(now).plus(todo.pop()))
            else:
                done[-1] = done[-1].plus(now, 0.5)
                ahead = todo.pop()
                todo.append(replace(ahead.plus(now, 0.5), start=ahead.start - 0.5 * now.duration))
        elif done:
            done[-1] = done[-1].plus(now)
        else:
            todo.append(replace(todo.pop().plus(now), start=now.start))
    return merge_equal(done)


def _clean_clips(segments: DataFrame, sums: list[str], means: list[str], kept: list[str], least: dict[str, int], default: int) -> DataFrame:
    """Runs ``clean`` on each clip's sorted list; many clips share a batch."""
    columns = ["start_time", "duration", "caption", *sums, *means, *kept]
    lists = segments.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("rows"))
    kind = "array<struct<start_time: double, duration: double, caption: string, " + ", ".join(f"{c}: double" for c in [*sums, *means, *kept]) + ">>"
    a, b = 3 + len(sums), 3 + len(sums) + len(means)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for rows in batch:
                spans = [Span(r[0], r[1], r[2], tuple(r[3:a]), tuple(r[a:b]), tuple(r[b:])) for r in ([x[c] for c in columns] for x in rows)]
                out.append([dict(zip(columns, (s.start, s.duration, s.caption, *s.sums, *s.means, *s.kept))) for s in clean(spans, least, default)])
            yield pd.Series(out)

    cleaned = lists.select(*KEYS, F.inline(F.pandas_udf(run_typed(run), kind)("rows")))
    return cleaned


def run_typed(run):
    """pandas_udf reads these hints."""
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return run


# fixed values: least ticks by caption
LONGITUDINAL_LEAST, LONGITUDINAL_DEFAULT = {"MaintainSpeed": 12}, 8
LATERAL_DEFAULT = 10


def clean_longitudinal(segments: DataFrame, least: dict[str, int] = LONGITUDINAL_LEAST, default: int = LONGITUDINAL_DEFAULT) -> DataFrame:
    """The captions aren't decided anew, and the speed along the heading stays that of the piece that took the others in."""
    out = _clean_clips(segments, ["delta_velocity"], ["average_speed"], ["average_speed_along_heading"], least, default)
    return out.withColumn("average_acceleration", F.when(F.col("duration") > 0, F.col("delta_velocity") / F.col("duration")).otherwise(0.0))


def clean_lateral(segments: DataFrame, least: dict[str, int] | None = None, default: int = LATERAL_DEFAULT) -> DataFrame:
    out = _clean_clips(segments, ["total_heading_change", "total_distance"], [], ["average_speed_along_heading"], least or {}, default)
    return out.withColumn("average_turn_rate", F.when(F.col("total_distance") > 1e-6, F.col("total_heading_change") / F.col("total_distance")).otherwise(0.0))


def label_clips(ticks: DataFrame, clean_up: bool = True) -> DataFrame:
    """Segments of both families with captions: (clip_id, agent_id, family, tag, start_time, duration)."""
    lon, lat = classify.classify_longitudinal(segment_longitudinal(ticks)), classify.classify_lateral(segment_lateral(ticks))
    if clean_up:
        lon, lat = clean_longitudinal(lon), clean_lateral(lat)
    pick = lambda df, family: df.select(*KEYS, F.lit(family).alias("family"), F.col("caption").alias("tag"), "start_time", "duration")
    return pick(lon, "longitudinal").unionByName(pick(lat, "lateral"))
