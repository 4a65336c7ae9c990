"""Rule tables that give a segment its caption: the first rule whose thresholds all hold, in the order listed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Threshold:
    column: str
    kind: str  # min (>=), max (<=) or equal
    value: float | str | bool


def threshold(rule: Threshold) -> Column:
    column, value = F.col(rule.column), F.lit(rule.value)
    return {"min": column >= value, "max": column <= value, "equal": column == value}[rule.kind]


def classify(segments: DataFrame, rules: list[tuple[str, list[Threshold]]], default: str, name: str = "caption") -> DataFrame:
    out = F.lit(default)
    for tag, thresholds in reversed(rules):
        holds = F.lit(True)
        for t in thresholds:
            holds = holds & threshold(t)
        out = F.when(holds, tag).otherwise(out)
    return segments.withColumn(name, out)


def low(column: str, value: float) -> Threshold:
    return Threshold(column, "min", value)


def high(column: str, value: float) -> Threshold:
    return Threshold(column, "max", value)


# fixed values: longitudinal rules
LONGITUDINAL = [
    ("Reverse", [high("average_speed_along_heading", -0.12)]),
    ("Stop", [high("average_speed", 0.12)]),
    ("StrongAcceleration", [low("average_acceleration", 1.4), low("delta_velocity", 0.8)]),
    ("GentleAcceleration", [low("average_acceleration", 0.15), high("average_acceleration", 1.4), low("delta_velocity", 0.8)]),
    ("StrongDeceleration", [high("average_acceleration", -1.4), high("delta_velocity", -0.8)]),
    ("GentleDeceleration", [high("average_acceleration", -0.15), low("average_acceleration", -1.4), high("delta_velocity", -0.8)]),
]
# fixed values: lateral rules
LATERAL = [
    ("ReverseRight", [high("average_speed_along_heading", -0.1), high("average_turn_rate", -0.002), high("total_heading_change", -0.2)]),
    ("ReverseLeft", [high("average_speed_along_heading", -0.1), low("average_turn_rate", 0.002), low("total_heading_change", 0.2)]),
    ("SharpSteerRight", [high("average_turn_rate", -0.05), high("total_heading_change", -0.2)]),
    ("SharpSteerLeft", [low("average_turn_rate", 0.05), low("total_heading_change", 0.2)]),
    ("SteerRight", [high("average_turn_rate", -0.0015), high("total_heading_change", -0.015)]),
    ("SteerLeft", [low("average_turn_rate", 0.0015), low("total_heading_change", 0.015)]),
]


def classify_longitudinal(segments: DataFrame, rules: list = LONGITUDINAL) -> DataFrame:
    return classify(segments, rules, "MaintainSpeed")


def classify_lateral(segments: DataFrame, rules: list = LATERAL) -> DataFrame:
    return classify(segments, rules, "GoStraight")
