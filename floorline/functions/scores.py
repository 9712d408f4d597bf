"""Flags and scores computed from one event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from floorline.functions.labels import first_match, flag

# Weights and limits of the scores.
HEALTH_START = 100
HEALTH_PER_DEGREE = 0.3
HEALTH_PER_VIBRATION = 5
RISK_PER_DEGREE = 0.4
RISK_PER_VIBRATION = 10
ANOMALY_ABOVE_DEGREES = 90
EXHAUSTED_ABOVE_FATIGUE = 80
RUNNING = "running"


def fault_flag() -> Column:
    return flag(F.col("is_fault"))


def running_flag() -> Column:
    return flag(F.col("status") == RUNNING)


def anomaly_flag() -> Column:
    return flag(F.col("temperature") > ANOMALY_ABOVE_DEGREES)


def health_score() -> Column:
    """0 for a faulty machine, else what heat and vibration leave of 100.

    ``greatest`` skips nulls, so an unknown vibration scores 0 as well.
    """
    left = (
        F.lit(HEALTH_START)
        - F.col("temperature") * HEALTH_PER_DEGREE
        - F.col("vibration") * HEALTH_PER_VIBRATION
    )
    return F.when(F.col("is_fault"), 0.0).otherwise(F.greatest(F.lit(0.0), left))


def risk_score() -> Column:
    return F.col("temperature") * RISK_PER_DEGREE + F.col("vibration") * RISK_PER_VIBRATION


def safety_violation_flag() -> Column:
    """1 if a piece of safety gear is known to be missing."""
    return flag(~F.col("helmet_on") | ~F.col("safety_vest_on"))


def danger_zone_flag() -> Column:
    return flag(F.col("danger_zone"))


def _exhausted_in_danger_zone() -> Column:
    return F.col("danger_zone") & (F.col("fatigue_score") > EXHAUSTED_ABOVE_FATIGUE)


def worker_risk_level() -> Column:
    return first_match(
        [(_exhausted_in_danger_zone(), "Critical"), (F.col("danger_zone"), "High")], "Normal"
    )


def alert_level() -> Column:
    return first_match(
        [(_exhausted_in_danger_zone(), "CRITICAL"), (safety_violation_flag() == 1, "WARNING")],
        "NORMAL",
    )
