"""Gold in mergeable parts: what is stored per key and window, how parts are merged, and gold from them.

A part has, for each measured column, the number of values, their sum, minimum and
maximum, and the number of events.  Parts of disjoint rows merge into the part of all
of them, so late days, or days computed anew, are added without reading the others,
and longer windows are made of shorter ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorline.contracts import LAYERS
from floorline.functions.scores import danger_zone_flag
from floorline.operators.gold import MACHINE_WINDOW, WORKER_WINDOW

LENGTHS = {"machine": MACHINE_WINDOW, "worker": WORKER_WINDOW}
KEYS = {"machine": "machine_id", "worker": "worker_id"}
EVENTS = "events"
# How each number of a part is made of values, and how two of them become one.
MAKES: dict[str, Callable[[Column], Column]] = {"n": F.count, "sum": F.sum, "min": F.min, "max": F.max}
MERGES: dict[str, Callable[[Column], Column]] = {"n": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def measures(domain: str) -> dict[str, Column]:
    """The measured columns, all as doubles, from silver."""
    if domain == "machine":
        names = ("temperature", "rpm", "vibration", "power_kw", "health_score", "risk_score", "fault_flag", "running_flag")
        found = {name: F.col(name) for name in names}
    else:
        found = {"safety_violation_flag": F.col("safety_violation_flag"), "danger_zone_flag": danger_zone_flag(),
                 "fatigue_score": F.col("fatigue_score")}
    return {name: value.cast("double") for name, value in found.items()}


def part_columns(domain: str) -> list[str]:
    """Numbers of a part, in order: those of each measure, then the events."""
    return [f"{name}_{kind}" for name in measures(domain) for kind in MAKES] + [EVENTS]


def windowed_measures(silver: DataFrame, domain: str, *others: str) -> DataFrame:
    """Key, ``window_start``, ``window_end`` and measures of each event, and other columns of silver."""
    window = F.window("timestamp", LENGTHS[domain])
    return silver.select(F.col(KEYS[domain]), window["start"].alias("window_start"), window["end"].alias("window_end"),
                         *(value.alias(name) for name, value in measures(domain).items()), *others)


def gold_parts(silver: DataFrame, domain: str) -> DataFrame:
    """A part per key and window."""
    numbers = [make(F.col(name)).alias(f"{name}_{kind}") for name in measures(domain) for kind, make in MAKES.items()]
    return windowed_measures(silver, domain).groupBy(KEYS[domain], "window_start", "window_end").agg(
        *numbers, F.count("*").alias(EVENTS))


def merge_parts(parts: DataFrame, domain: str, length: str | None = None) -> DataFrame:
    """One part per key and window of all that there are, of windows of ``length`` if given, a multiple of theirs."""
    if length:
        window = F.window("window_start", length)
        parts = parts.withColumns({"window_start": window["start"], "window_end": window["end"]})
    numbers = [MERGES[kind](F.col(f"{name}_{kind}")).alias(f"{name}_{kind}") for name in measures(domain) for kind in MAKES]
    return parts.groupBy(KEYS[domain], "window_start", "window_end").agg(*numbers, F.sum(EVENTS).alias(EVENTS))


def gold_from_parts(parts: DataFrame, domain: str) -> DataFrame:
    """Gold columns from merged parts; a mean or sum of no values is null."""

    def mean(name: str) -> Column:
        return F.col(f"{name}_sum") / F.when(F.col(f"{name}_n") > 0, F.col(f"{name}_n"))

    def total(name: str) -> Column:
        return F.when(F.col(f"{name}_n") > 0, F.col(f"{name}_sum")).cast("long")

    events = F.col(EVENTS)
    if domain == "machine":
        found = {
            "avg_temp": mean("temperature"), "avg_rpm": mean("rpm"), "avg_vibration": mean("vibration"), "avg_power": mean("power_kw"),
            "avg_health_score": mean("health_score"), "min_health_score": F.col("health_score_min"), "fault_count": total("fault_flag"),
            "fault_percentage": total("fault_flag") * 100.0 / events, "total_events": events, "max_temp": F.col("temperature_max"),
            "max_vibration": F.col("vibration_max"), "peak_power": F.col("power_kw_max"), "avg_risk_score": mean("risk_score"),
            "uptime_percentage": total("running_flag") / events * 100,
        }
    else:
        found = {"violations_per_window": total("safety_violation_flag"), "workers_in_danger_zone": total("danger_zone_flag"),
                 "avg_fatigue_score": mean("fatigue_score")}
    return parts.select(*(found.get(name, F.col(name)).alias(name) for name in LAYERS[domain, "gold"]))
