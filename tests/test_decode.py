from __future__ import annotations

from datetime import datetime

import pytest
from conftest import machine, worker

from floorline.contracts import MACHINE_BRONZE, WORKER_BRONZE
from floorline.operators.decode import machine_bronze, worker_bronze
from floorline.plans.layers import build_layer


def test_machine_fields_are_flattened_and_renamed(raw):
    document = {
        **machine(event_id="x"),
        "cnc_sensors": {"oil_level_pct": 1.0, "coolant_pressure_bar": 2.0},
        "robot_sensors": {"joint_torque_nm": 3.0, "end_effector_force_n": 4.0},
        "conveyor_sensors": {"belt_tension_n": 5.0, "load_weight_kg": 6.0},
        "pump_sensors": {"oil_level_pct": 99.0, "flow_rate_lpm": 7.0, "inlet_pressure_bar": 8.0},
        "unknown": "dropped",
    }
    rows = machine_bronze(raw(document))
    assert tuple(rows.columns) == MACHINE_BRONZE
    row = rows.first()
    assert row.timestamp == datetime(2024, 1, 1)
    readings = (row.cnc_oil, row.coolant_pressure, row.joint_torque, row.force,
                row.belt_tension, row.load_weight, row.flow_rate, row.inlet_pressure)
    assert readings == (1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0)


def test_pump_oil_level_is_not_kept(raw):
    row = machine_bronze(raw({**machine(), "pump_sensors": {"oil_level_pct": 50.0}})).first()
    assert row.cnc_oil is None and 50.0 not in row


def test_worker_columns(raw):
    rows = worker_bronze(raw(worker(heart_rate=77)))
    assert tuple(rows.columns) == WORKER_BRONZE
    assert rows.first().heart_rate == 77


def test_unreadable_payloads_become_null_rows(raw):
    rows = machine_bronze(raw("not json", "{\"event_id\": \"cut", "")).collect()
    assert len(rows) == 3
    assert all(value is None for row in rows for value in row)


def test_null_payload_becomes_a_null_row(spark):
    row = machine_bronze(spark.createDataFrame([(None,)], "value BINARY")).first()
    assert set(row) == {None}


def test_text_payloads_decode_like_binary_ones(spark, raw):
    text = raw(worker()).selectExpr("CAST(value AS STRING) AS value")
    assert worker_bronze(text).collect() == worker_bronze(raw(worker())).collect()


def test_a_field_of_the_wrong_type_is_null_alone(raw):
    row = worker_bronze(raw(worker(heart_rate=88.5, helmet_on="true"))).first()
    assert (row.heart_rate, row.helmet_on, row.worker_id) == (None, None, "W001")


def test_time_zones_and_bad_times(raw):
    times = ["2024-01-01T02:00:00+02:00", "2024-01-01T00:00:00.123456Z", "garbage", None]
    rows = worker_bronze(raw(*(worker(timestamp=t) for t in times))).collect()
    assert [row.timestamp for row in rows] == [
        datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 123456), None, None,
    ]


@pytest.mark.parametrize("domain", ["machine", "worker"])
def test_gold_parses_only_what_it_reads(raw, domain):
    """One parse, of the gold inputs alone."""
    document = {"machine": machine, "worker": worker}[domain]()
    gold = build_layer(raw(document), domain, "gold")
    plan = gold._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    assert not any(name in plan for name in ("sensors", "error_code", "shift", "zone_id", "event_id"))
    assert gold.count() == 1


def test_pruned_columns_keep_their_types(raw):
    whole, part = machine_bronze(raw(machine())), machine_bronze(raw(machine()), ("machine_id", "rpm"))
    assert whole.dtypes == part.dtypes
    row = part.first()
    assert (row.machine_id, row.rpm, row.temperature, row.timestamp) == ("CNC_01", 1000.0, None, None)
