"""Silver -> gold: key x tumbling window aggregates.

All aggregates are algebraic, so Spark combines rows before the one shuffle on
(key, window) and a key that holds most of the rows costs no more than any other.
With ``watermark`` set the same plan runs as a stateful stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floorline.contracts import MACHINE_GOLD, WORKER_GOLD
from floorline.functions.scores import danger_zone_flag

# Window lengths and how long a window waits for late events.
MACHINE_WINDOW = "1 minute"
WORKER_WINDOW = "5 minutes"
WATERMARK = "1 minute"


def _windowed(
    silver: DataFrame,
    key: str,
    length: str,
    watermark: str | None,
    aggregates: dict[str, Column],
    layer: tuple[str, ...],
) -> DataFrame:
    rows = silver.withWatermark("timestamp", watermark) if watermark else silver
    grouped = rows.groupBy(key, F.window("timestamp", length)).agg(
        *(value.alias(name) for name, value in aggregates.items())
    )
    bounds = {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
    return grouped.select(*(bounds.get(name, F.col(name)).alias(name) for name in layer))


def machine_gold(silver: DataFrame, watermark: str | None = None) -> DataFrame:
    """Per machine and minute: means, extremes, faults and uptime."""
    events = F.count("*")
    faults = F.sum("fault_flag")
    return _windowed(
        silver,
        "machine_id",
        MACHINE_WINDOW,
        watermark,
        {
            "avg_temp": F.avg("temperature"),
            "avg_rpm": F.avg("rpm"),
            "avg_vibration": F.avg("vibration"),
            "avg_power": F.avg("power_kw"),
            "avg_health_score": F.avg("health_score"),
            "min_health_score": F.min("health_score"),
            "fault_count": faults,
            "fault_percentage": faults * 100.0 / events,
            "total_events": events,
            "max_temp": F.max("temperature"),
            "max_vibration": F.max("vibration"),
            "peak_power": F.max("power_kw"),
            "avg_risk_score": F.avg("risk_score"),
            "uptime_percentage": F.sum("running_flag") / events * 100,
        },
        MACHINE_GOLD,
    )


def worker_gold(silver: DataFrame, watermark: str | None = None) -> DataFrame:
    """Per worker and five minutes: violations, events in a danger zone, fatigue.

    ``workers_in_danger_zone`` counts the events of this worker in a danger zone,
    not distinct workers.
    """
    return _windowed(
        silver,
        "worker_id",
        WORKER_WINDOW,
        watermark,
        {
            "violations_per_window": F.sum("safety_violation_flag"),
            "workers_in_danger_zone": F.sum(danger_zone_flag()),
            "avg_fatigue_score": F.avg("fatigue_score"),
        },
        WORKER_GOLD,
    )
