from __future__ import annotations

import json
from datetime import datetime

import pytest
from conftest import SMALL, machine, worker

from checks.queries import layer_of
from floorline.contracts import LAYERS, RELATIONAL_TABLES, SEARCH_INDEXES, relational_columns
from floorline.functions.text import to_json_value
from floorline.operators.contract import ContractError, require_columns
from floorline.operators.revisions import latest_revision
from floorline.plans.dashboards import PANELS, panel
from floorline.plans.layers import build_layer
from floorline.plans.layouts import relational_layout, search_layout, text_column_types
from floorline.plans.views import VIEWS, local_time_view, register_views
from floorline.streaming.datasets import DATASETS


def stored(raw, table):
    target = next(d for d in DATASETS if d.target == table)
    document = {"machine": machine(), "worker": worker()}[target.domain]
    if target.layer == "quarantine":
        document["timestamp"] = None
    return relational_layout(build_layer(raw(document), target.domain, target.layer), table)


@pytest.mark.parametrize("table", RELATIONAL_TABLES)
def test_relational_columns_cover_the_layer(table):
    target = next(d for d in DATASETS if d.target == table)
    names = [name for name, _ in relational_columns(table)]
    assert sorted(names) == sorted(LAYERS[target.domain, target.layer])


def test_relational_types(raw):
    rows = stored(raw, "worker_events_silver")
    types = dict(rows.dtypes)
    assert types["fatigue_score"] == "double" and types["heart_rate"] == "int"
    assert rows.columns.index("heart_rate_status") == rows.columns.index("heart_rate") + 1
    assert dict(stored(raw, "worker_safety_gold").dtypes)["violations_per_window"] == "bigint"
    assert text_column_types("worker_safety_gold") == "worker_id VARCHAR(50)"


def test_search_readings_are_32_bit(raw):
    rows = search_layout(build_layer(raw(machine(temperature=74.3)), "machine", "silver"), "machine-events")
    assert "double" not in dict(rows.dtypes).values()
    assert rows.first().temperature == pytest.approx(74.30000305175781, abs=1e-12)
    assert tuple(rows.columns) == SEARCH_INDEXES["machine-events"]


@pytest.mark.parametrize(
    ("utc", "local"),
    [("2024-01-09T10:00:00Z", datetime(2024, 1, 9, 12)), ("2026-06-09T10:00:00Z", datetime(2026, 6, 9, 13))],
)
def test_local_time_follows_summer_time(raw, utc, local):
    silver = build_layer(raw(worker(timestamp=utc)), "worker", "silver")
    view = local_time_view(relational_layout(silver, "worker_events_silver"), "worker_events_silver_view")
    assert view.first().cairo_time == local
    assert view.columns[:3] == ["worker_id", "timestamp", "cairo_time"]


def test_gold_view_has_both_window_bounds(raw):
    view = local_time_view(stored(raw, "worker_safety_gold"), "worker_safety_gold_view")
    assert view.columns[:5] == [
        "worker_id", "window_start", "window_end", "cairo_window_start", "cairo_window_end",
    ]
    row = view.first()
    assert (row.cairo_window_start, row.cairo_window_end) == (datetime(2024, 1, 1, 2), datetime(2024, 1, 1, 2, 5))


def test_views_can_be_queried_with_sql(spark, raw):
    register_views(lambda table: stored(raw, table))
    for view, (table, _, local) in VIEWS.items():
        rows = spark.sql(f"SELECT * FROM {view}")
        assert rows.count() == 1
        assert len(rows.columns) == len(relational_columns(table)) + len(local)


def test_json_documents_leave_out_nulls_and_truncate_times(raw):
    silver = build_layer(raw(machine(timestamp="2024-01-01T00:00:00.123456Z")), "machine", "silver")
    document = json.loads(to_json_value(silver).first().value)
    assert document["timestamp"] == "2024-01-01T00:00:00.123Z"
    assert "error_code" not in document and "cnc_oil" not in document
    assert document["health_score"] == 74.0 and document["event_date"] == "2024-01-01"


def test_missing_columns_are_named(raw):
    rows = build_layer(raw(worker()), "worker", "bronze").drop("floor", "zone_id")
    with pytest.raises(ContractError, match="worker_events: missing columns floor, zone_id"):
        require_columns(rows, LAYERS["worker", "bronze"], "worker_events")


def test_latest_revision_takes_the_newest_batch(spark):
    changelog = spark.createDataFrame(
        [("a", 1, 10, 0), ("a", 1, 12, 10), ("a", 1, 11, 9), ("b", 1, 5, 2)],
        "machine_id STRING, window_start INT, n INT, revision INT",
    )
    rows = latest_revision(changelog, ["machine_id", "window_start"]).orderBy("machine_id").collect()
    assert [(r.machine_id, r.n) for r in rows] == [("a", 12), ("b", 5)]


@pytest.mark.parametrize("name", PANELS)
@pytest.mark.parametrize("interval", ["30 minutes", "1 day"])
def test_panels_accept_any_interval(spark, name, interval):
    domain, layer, _, reading = PANELS[name]
    rows = panel(layer_of(spark, SMALL, domain, layer), name, interval).orderBy("bucket").collect()
    steps = {b.bucket - a.bucket for a, b in zip(rows, rows[1:])}
    assert len(steps) == 1 and rows[0][f"median_{reading}"] is not None
