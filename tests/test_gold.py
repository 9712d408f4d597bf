from __future__ import annotations

import math
from datetime import datetime

import pytest
from conftest import SMALL, machine, worker

from checks.queries import layer_of
from floorline.contracts import MACHINE_GOLD, WORKER_GOLD
from floorline.plans.layers import build_layer


def executed_plan(rows):
    rows.collect()
    return rows._jdf.queryExecution().executedPlan().toString()


def test_machine_window(raw):
    rows = build_layer(
        raw(
            machine(timestamp="2024-01-01T00:00:00Z", temperature=60, vibration=2, rpm=900, power_kw=1),
            machine(timestamp="2024-01-01T00:00:30Z", temperature=80, vibration=None, rpm=1100, power_kw=4,
                    status="idle"),
            machine(timestamp="2024-01-01T00:00:59.999Z", temperature=100, vibration=4, rpm=1000, power_kw=7,
                    status="fault", is_fault=True),
            machine(timestamp="2024-01-01T00:01:00Z"),
        ),
        "machine", "gold",
    )
    assert tuple(rows.columns) == MACHINE_GOLD
    first, second = rows.orderBy("window_start").collect()
    assert (first.window_start, first.window_end) == (datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1))
    assert (first.avg_temp, first.max_temp, first.avg_rpm) == (80, 100, 1000)
    assert (first.avg_vibration, first.max_vibration) == (3, 4)
    assert (first.avg_power, first.peak_power) == (4, 7)
    assert first.avg_health_score == pytest.approx((72 + 0 + 0) / 3)
    assert first.min_health_score == 0
    assert first.avg_risk_score == pytest.approx((44 + 80) / 2)
    assert (first.fault_count, first.total_events) == (1, 3)
    assert first.fault_percentage == pytest.approx(100 / 3)
    assert first.uptime_percentage == pytest.approx(100 / 3)
    assert (second.window_start, second.total_events) == (datetime(2024, 1, 1, 0, 1), 1)


def test_nan_rpm_spreads_into_the_average(raw):
    row = build_layer(raw(machine(rpm=float("nan")), machine(rpm=1.0)), "machine", "gold").first()
    assert math.isnan(row.avg_rpm)


def test_worker_window_edges_and_counts(raw):
    rows = build_layer(
        raw(
            worker(timestamp="2024-01-01T00:04:59.999999Z", helmet_on=False, danger_zone=True, fatigue_score=10),
            worker(timestamp="2024-01-01T00:00:00Z", danger_zone=True, fatigue_score=None),
            worker(timestamp="2024-01-01T00:05:00Z", danger_zone=None, fatigue_score=30),
        ),
        "worker", "gold",
    )
    assert tuple(rows.columns) == WORKER_GOLD
    first, second = rows.orderBy("window_start").collect()
    assert tuple(first)[3:] == (1, 2, 10.0)
    assert tuple(second)[3:] == (0, 0, 30.0)
    assert second.window_start == datetime(2024, 1, 1, 0, 5)


@pytest.mark.parametrize(("domain", "rows"), [("machine", 851), ("worker", 924)])
def test_windows_on_the_event_log(spark, domain, rows):
    assert layer_of(spark, SMALL, domain, "gold").count() == rows


def test_events_are_not_deduplicated(raw):
    assert build_layer(raw(machine(), machine()), "machine", "gold").first().total_events == 2


@pytest.mark.parametrize("domain", ["machine", "worker"])
def test_plan_parses_once_and_shuffles_partial_aggregates_once(raw, domain):
    document = {"machine": machine, "worker": worker}[domain]()
    plan = executed_plan(build_layer(raw(document), domain, "gold"))
    final = plan.split("Initial Plan")[0]
    assert final.count("from_json(") == 1
    assert final.count("Exchange hashpartitioning") == 1
    assert "partial_" in final[final.index("Exchange hashpartitioning"):]


@pytest.mark.parametrize("domain", ["machine", "worker"])
@pytest.mark.parametrize("layer", ["bronze", "quarantine", "silver"])
def test_stateless_layers_do_not_shuffle(raw, domain, layer):
    document = {"machine": machine, "worker": worker}[domain]()
    plan = executed_plan(build_layer(raw(document), domain, layer))
    assert "Exchange" not in plan and plan.split("Initial Plan")[0].count("from_json(") == 1
