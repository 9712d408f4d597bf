"""Views over stored tables that add the plant's local time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorline.contracts import relational_columns
from floorline.functions.clock import wall_clock

# View -> table, last instant column before the local times, and the
# local-time column of each instant.
VIEWS = {
    "worker_events_quarantine_view": ("worker_events_quarantine", "timestamp", {"timestamp": "cairo_time"}),
    "machine_events_quarantine_view": ("machine_events_quarantine", "timestamp", {"timestamp": "cairo_time"}),
    "worker_events_bronze_view": ("worker_events_bronze", "timestamp", {"timestamp": "cairo_time"}),
    "worker_events_silver_view": ("worker_events_silver", "timestamp", {"timestamp": "cairo_time"}),
    "worker_safety_gold_view": (
        "worker_safety_gold",
        "window_end",
        {"window_start": "cairo_window_start", "window_end": "cairo_window_end"},
    ),
}


def local_time_view(stored: DataFrame, view: str) -> DataFrame:
    """The view's columns: the table's, with local times after the instants."""
    table, after, local = VIEWS[view]
    columns = []
    for name, _ in relational_columns(table):
        columns.append(F.col(name))
        if name == after:
            columns += [wall_clock(instant).alias(alias) for instant, alias in local.items()]
    return stored.select(*columns)


def register_views(read_table: Callable[[str], DataFrame]) -> None:
    """Create or replace all views as temporary views over ``read_table(name)``."""
    for view, (table, _, _) in VIEWS.items():
        local_time_view(read_table(table), view).createOrReplaceTempView(view)
