"""The median series shown on the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame

from floorline.operators.series import median_series

# Panel -> (domain, layer, time column, reading).
PANELS = {
    "median_temperature": ("machine", "silver", "timestamp", "temperature"),
    "median_vibration": ("machine", "gold", "window_start", "avg_vibration"),
    "median_fatigue": ("worker", "gold", "window_start", "avg_fatigue_score"),
    "median_heart_rate": ("worker", "silver", "timestamp", "heart_rate"),
}


def panel(rows: DataFrame, name: str, interval: str = "1 hour", **options) -> DataFrame:
    """Series of one panel over its layer; ``options`` as for ``median_series``."""
    _, _, ts, reading = PANELS[name]
    return median_series(rows, ts, reading, interval, **options)
