"""Feature windows over ticks, per clip and agent in tick order. Every function adds columns and keeps the rest.

All windows use the same keys, so after one shuffle by (clip_id, agent_id) none of them shuffles again."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

DT = 0.1


def by_tick() -> WindowSpec:
    return Window.partitionBy("clip_id", "agent_id").orderBy("tick")


def by_clip() -> WindowSpec:
    return Window.partitionBy("clip_id", "agent_id")


def wrap(angle: Column) -> Column:
    """The angle brought to [-pi, pi)."""
    return F.pmod(angle + math.pi, F.lit(2 * math.pi)) - math.pi


def add_speed(ticks: DataFrame) -> DataFrame:
    return ticks.withColumns({
        "speed": F.sqrt(F.col("vx") * F.col("vx") + F.col("vy") * F.col("vy")),
        "speed_along": F.col("vx") * F.cos("heading") + F.col("vy") * F.sin("heading"),
    })


def to_world(ticks: DataFrame, clips: DataFrame) -> DataFrame:
    """Positions and headings in the world frame; clips: (clip_id, world_tf of 9 or 16 values, row by row)."""
    n = F.when(F.size("world_tf") == 9, 3).otherwise(4)
    m = lambda row, col: F.element_at("world_tf", F.lit(row) * n + F.lit(col + 1))
    last = n - 1
    out = ticks.join(clips.select("clip_id", "world_tf"), "clip_id")
    shift = lambda row: F.element_at("world_tf", F.lit(row) * n + last + 1)
    return out.withColumns({
        "x": m(0, 0) * F.col("x") + m(0, 1) * F.col("y") + shift(0),
        "y": m(1, 0) * F.col("x") + m(1, 1) * F.col("y") + shift(1),
        "heading": F.col("heading") + F.atan2(m(1, 0), m(0, 0)),
    }).drop("world_tf")


def add_acceleration(ticks: DataFrame, speed: str = "speed", name: str = "acceleration") -> DataFrame:
    back = (F.col(speed) - F.lag(speed).over(by_tick())) / DT
    ahead = (F.lead(speed).over(by_tick()) - F.col(speed)) / DT
    return ticks.withColumn(name, F.coalesce(back, ahead, F.lit(0.0)))


def rolling_mean(ticks: DataFrame, column: str, name: str, size: int = 5) -> DataFrame:
    """Centred mean, over fewer values at the ends."""
    return ticks.withColumn(name, F.avg(column).over(by_tick().rowsBetween(-(size // 2), size // 2)))


def hysteresis(column: str, threshold: float, fraction: float = 0.15) -> Column:
    """Sticky state: on at T(1 + f), off below T(1 - f) (T below 0: the other way round); the first value uses T itself."""
    near, far = threshold * (1 - fraction), threshold * (1 + fraction)
    on, off = (far, near) if threshold >= 0 else (near, far)
    value = F.col(column)
    marker = F.when(F.row_number().over(by_tick()) == 1, value >= threshold).when(value >= on, True).when(value < off, False)
    return F.last(marker, ignorenulls=True).over(by_tick())


def mirrored_mean(values: Column, size: int = 5) -> Column:
    """Centred mean of an array with the ends mirrored (the end values themselves aren't repeated). An even size grows by one."""
    half = (size + 1 - size % 2) // 2
    n = F.size(values)
    period = F.greatest(F.lit(1), 2 * (n - 1))

    def at(i: Column) -> Column:
        k = F.pmod(i, period)
        return F.get(values, F.when(k < n, k).otherwise(period - k).cast("int"))

    def mean(x: Column, i: Column) -> Column:
        total = at(i - half)
        for d in range(1 - half, half + 1):
            total = total + at(i + d)
        return total / (2 * half + 1)

    return F.transform(values, mean)


def add_turn_rate(ticks: DataFrame, size: int = 5) -> DataFrame:
    """Steps between ticks: distance, smoothed heading change, and their quotient; the last tick has no step and is dropped."""
    step = ticks.withColumns({
        "distance": F.sqrt(F.pow(F.lead("x").over(by_tick()) - F.col("x"), 2) + F.pow(F.lead("y").over(by_tick()) - F.col("y"), 2)),
        "turn": wrap(F.lead("heading").over(by_tick()) - F.col("heading")),
        "_n": F.count(F.lit(1)).over(by_clip()), "_i": F.row_number().over(by_tick()),
    }).where("_i < _n")
    half = (size + 1 - size % 2) // 2
    n = F.col("_n") - 1
    terms = []
    for d in range(-half, half + 1):
        # position of the mirrored neighbour relative to this row; only the first and last ``half`` rows are mirrored
        k = F.col("_i") - 1 + d
        period = F.greatest(F.lit(1), 2 * (n - 1))
        k = F.pmod(k, period)
        k = F.when(k < n, k).otherwise(period - k)
        terms.append((k - (F.col("_i") - 1)).cast("int"))
    near = {d: F.lag("turn", -d).over(by_tick()) if d else F.col("turn") for d in range(-2 * half, 2 * half + 1)}
    total = F.lit(0.0)
    for term in terms:
        value = F.lit(None).cast("double")
        for d, c in near.items():
            value = F.when(term == d, c).otherwise(value)
        total = total + value
    smooth = total / (2 * half + 1)
    out = step.withColumn("turn", smooth)
    return out.withColumn("turn_rate", F.when(F.col("distance") > 1e-6, F.col("turn") / F.col("distance")).otherwise(0.0)).drop("_n", "_i")


def add_lane_kinematics(ticks: DataFrame) -> DataFrame:
    """Heading change and rate from the tick before (the first copies the second), step ahead and its part to the left (0 at
    the last), and with ``lane_offset`` its change per metre, null where an offset is."""
    dx, dy = F.lead("x").over(by_tick()) - F.col("x"), F.lead("y").over(by_tick()) - F.col("y")
    out = ticks.withColumns({
        "_turn": wrap(F.col("heading") - F.lag("heading").over(by_tick())),
        "step_distance": F.coalesce(F.sqrt(dx * dx + dy * dy), F.lit(0.0)),
        "step_left": F.coalesce(-dx * F.sin("heading") + dy * F.cos("heading"), F.lit(0.0)),
    })
    before = F.lag("step_distance").over(by_tick())
    first = F.row_number().over(by_tick()) == 1
    out = out.withColumn("_rate", F.when(before > 1e-6, F.col("_turn") / before).otherwise(0.0))
    padded = lambda c: F.coalesce(F.when(first, F.lead(c).over(by_tick())).otherwise(F.col(c)), F.lit(0.0))
    new = {"heading_delta": padded("_turn"), "heading_rate": padded("_rate")}
    if "lane_offset" in ticks.columns:
        out = out.withColumn("_side", F.when(before > 1e-6, (F.col("lane_offset") - F.lag("lane_offset").over(by_tick())) / before).otherwise(0.0))
        new["lateral_rate"] = F.when(first, F.lead("_side").over(by_tick())).otherwise(F.col("_side"))
    return out.withColumns(new).drop("_turn", "_rate", "_side")


def downsample(ticks: DataFrame, rate: int, history: int, future: int) -> DataFrame:
    """Every rate-th of the ``history`` first ticks, and of the ``future`` ones after them from the rate-th on."""
    past = (F.col("tick") < history) & (F.col("tick") % rate == 0)
    k = F.col("tick") - history
    return ticks.where(past | (k.between(rate - 1, future - 1) & ((k - (rate - 1)) % rate == 0)))


def rotate_axes(ticks: DataFrame) -> DataFrame:
    """A quarter turn to the left: x' = -y, y' = x for positions, velocities and accelerations there are."""
    new = {"heading": F.pmod(F.col("heading") + math.pi / 2, F.lit(2 * math.pi))}
    for x, y in (("x", "y"), ("vx", "vy"), ("ax", "ay")):
        if x in ticks.columns and y in ticks.columns:
            new |= {x: -F.col(y), y: F.col(x)}
    return ticks.withColumns(new)


def angular_velocity(ticks: DataFrame, fps: float = 10.0) -> DataFrame:
    """Heading change to the next tick times fps; the last tick repeats the one before."""
    ahead = wrap(F.lead("heading").over(by_tick()) - F.col("heading")) * fps
    back = wrap(F.col("heading") - F.lag("heading").over(by_tick())) * fps
    return ticks.withColumn("angular_velocity", F.coalesce(ahead, back, F.lit(0.0)))


def long_lat_speed(ticks: DataFrame) -> DataFrame:
    c, s = F.cos("heading"), F.sin("heading")
    return ticks.withColumns({"lon_speed": F.col("vx") * c + F.col("vy") * s, "lat_speed": -F.col("vx") * s + F.col("vy") * c})


def ego_state(ticks: DataFrame, now: int) -> DataFrame:
    """(clip_id, vx, vy, ax, ay, yaw_rate, length, width, speed) of each clip's ego at one tick."""
    own = angular_velocity(ticks.where("agent_id = 'ego'")).where(F.col("tick") == now)
    return own.select("clip_id", "vx", "vy", "ax", "ay", F.col("angular_velocity").alias("yaw_rate"), "length", "width", F.sqrt(F.col("vx") * F.col("vx") + F.col("vy") * F.col("vy")).alias("speed"))


def object_rows(ticks: DataFrame, now: int, rate: int = 1, future_ticks: int | None = None) -> DataFrame:
    """One row per agent other than ego that is there at ``now``: running_id from 0 by name, id_global (the number that its name ends
    with), type, box, and its past and future path, every ``rate`` ticks, the future up to ``future_ticks``.

    Paths have x to the right and y to the front. box: x, y, z, width, length, height, heading and two zeros, in the same axes."""
    point = F.struct("tick", (-F.col("y")).alias("x"), F.col("x").alias("y"))
    ordered = lambda cond: F.array_sort(F.collect_list(F.when(cond, point)))
    state = F.max(F.when(F.col("tick") == now, F.struct("x", "y", "z", "heading", "length", "width", "height", "type")))
    rows = ticks.where("agent_id <> 'ego'").groupBy("clip_id", "agent_id").agg(ordered(F.col("tick") <= now).alias("past"), ordered(F.col("tick") > now).alias("future"), state.alias("s")).where("s is not null")
    pick = lambda name, keep: F.transform(F.filter(name, keep), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias(name)
    s, zero = F.col("s"), F.lit(0.0)
    box = F.array(*[c.cast("double") for c in (-s["y"], s["x"], s["z"], s["width"], s["length"], s["height"], s["heading"], zero, zero)])
    last = F.lit(1 << 30) if future_ticks is None else F.lit(future_ticks)
    running = F.row_number().over(Window.partitionBy("clip_id").orderBy("agent_id")) - 1
    return rows.select(
        "clip_id", "agent_id", running.alias("running_id"), F.element_at(F.split("agent_id", "_"), -1).try_cast("int").alias("id_global"), s["type"].alias("type"), box.alias("box"),
        pick("past", lambda p, i: i % rate == 0), pick("future", lambda p, i: (i % rate == rate - 1) & (i < last)),
    )


def resample_linear(ticks: DataFrame, columns: list[str], fps: int = 30, frames: int | None = None) -> DataFrame:
    """Values at video-frame times by linear interpolation, the end values beyond the ends: (clip_id, agent_id, frame, columns)."""
    lo, hi = F.min("tick").over(by_clip()), F.max("tick").over(by_clip())
    pairs = ticks.select("clip_id", "agent_id", "tick", *columns, *[F.lead(c).over(by_tick()).alias(f"_{c}") for c in columns], F.coalesce(F.lead("tick").over(by_tick()), F.col("tick")).alias("_next"), lo.alias("_lo"), hi.alias("_hi"))
    per = fps * DT
    first = F.when(F.col("tick") == F.col("_lo"), F.lit(0).cast("bigint")).otherwise(F.ceil(F.col("tick") * per))
    after = F.when(F.col("_next") == F.col("tick"), F.lit(frames if frames else 0) if frames else F.floor(F.col("tick") * per) + 1).otherwise(F.ceil(F.col("_next") * per))
    out = pairs.where(first < after).withColumn("frame", F.explode(F.sequence(first.cast("int"), after.cast("int") - 1)))
    t = (F.col("frame") / per - F.col("tick")) / F.greatest(F.lit(1), F.col("_next") - F.col("tick"))
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return out.select("clip_id", "agent_id", "frame", *[(F.col(c) + F.coalesce(F.col(f"_{c}") - F.col(c), F.lit(0.0)) * share).alias(c) for c in columns])


def heading_rate_by_speed(frames: DataFrame, fps: int = 30) -> DataFrame:
    """Heading change per metre at video frames; 0 at the first."""
    w = Window.partitionBy("clip_id", "agent_id").orderBy("frame")
    d = F.col("heading") - F.lag("heading").over(w)
    way = F.greatest(F.greatest(F.col("speed"), F.lit(0.0)) / fps, F.lit(1e-6))
    return frames.withColumn("heading_rate", F.coalesce(F.atan2(F.sin(d), F.cos(d)) / way, F.lit(0.0)))
