from __future__ import annotations

from datetime import date

import pytest
from conftest import machine, worker

from floorline.contracts import MACHINE_SILVER, WORKER_SILVER
from floorline.plans.layers import bronze_layer, silver_layer


@pytest.fixture
def silver_row(raw):
    def build(domain, document):
        return silver_layer(bronze_layer(raw(document), domain), domain).first()

    return build


def test_layer_columns_and_types(raw):
    machines = silver_layer(bronze_layer(raw(machine()), "machine"), "machine")
    workers = silver_layer(bronze_layer(raw(worker()), "worker"), "worker")
    assert tuple(machines.columns) == MACHINE_SILVER
    assert tuple(workers.columns) == WORKER_SILVER
    types = dict(machines.dtypes)
    assert (types["health_score"], types["fault_flag"], types["event_date"], types["event_hour"]) == (
        "double", "int", "date", "int",
    )


@pytest.mark.parametrize(
    ("column", "reading", "labels"),
    [
        ("temperature_status", "temperature", {80: "Normal", 80.01: "Warning", 90: "Warning", 90.01: "Critical"}),
        ("anomaly_flag", "temperature", {90: 0, 90.01: 1}),
        ("vibration_status", "vibration", {3: "Normal", 3.01: "Warning", 5: "Warning", 5.01: "Critical", None: "Normal"}),
        ("power_status", "power_kw", {3: "Low", 3.01: "Normal", 5: "Normal", 5.01: "High"}),
        ("running_flag", "status", {"running": 1, "idle": 0, "fault": 0}),
        ("fault_flag", "is_fault", {True: 1, False: 0, None: 0}),
        ("fault_category", "error_code", {
            "E001": "Overheat", "E002": "Vibration", "E003": "Overheat", "E004": "Vibration",
            "E005": "RPM Drop", "E006": "None", None: "None",
        }),
    ],
)
def test_machine_labels(silver_row, column, reading, labels):
    for value, label in labels.items():
        assert silver_row("machine", machine(**{reading: value}))[column] == label, value


@pytest.mark.parametrize(
    ("time", "bucket"),
    [
        ("05:59:59", "Night"), ("06:00:00", "Morning"), ("13:59:59", "Morning"),
        ("14:00:00", "Evening"), ("21:59:59", "Evening"), ("22:00:00", "Night"),
    ],
)
def test_parts_of_the_day(silver_row, time, bucket):
    row = silver_row("machine", machine(timestamp=f"2024-01-01T{time}Z"))
    assert (row.time_bucket, row.event_hour, row.event_date) == (bucket, int(time[:2]), date(2024, 1, 1))


def test_calendar_parts_are_utc(silver_row):
    row = silver_row("machine", machine(timestamp="2024-01-01T01:00:00+02:00"))
    assert (row.event_date, row.event_hour) == (date(2023, 12, 31), 23)


@pytest.mark.parametrize(
    ("changes", "health", "risk"),
    [
        ({"temperature": 10, "vibration": 1, "is_fault": None}, 92.0, 14.0),
        ({"temperature": 10, "vibration": 1, "is_fault": True}, 0.0, 14.0),
        ({"temperature": 150, "vibration": 12}, 0.0, 180.0),
        ({"temperature": 10, "vibration": None}, 0.0, None),
        ({"temperature": -20, "vibration": 0}, 106.0, -8.0),
    ],
)
def test_scores(silver_row, changes, health, risk):
    row = silver_row("machine", machine(**changes))
    assert row.health_score == pytest.approx(health)
    assert row.risk_score == (None if risk is None else pytest.approx(risk))


@pytest.mark.parametrize(
    ("helmet", "vest", "flag"),
    [(True, True, 0), (False, True, 1), (True, False, 1), (None, True, 0), (None, False, 1), (None, None, 0)],
)
def test_missing_gear(silver_row, helmet, vest, flag):
    assert silver_row("worker", worker(helmet_on=helmet, safety_vest_on=vest)).safety_violation_flag == flag


@pytest.mark.parametrize(
    ("column", "reading", "labels"),
    [
        ("fatigue_status", "fatigue_score", {50: "Low", 51: "Medium", 80: "Medium", 81: "High", None: "Low"}),
        ("heart_rate_status", "heart_rate", {90: "Normal", 91: "Elevated", 120: "Elevated", 121: "High"}),
    ],
)
def test_worker_labels(silver_row, column, reading, labels):
    for value, label in labels.items():
        assert silver_row("worker", worker(**{reading: value}))[column] == label, value


@pytest.mark.parametrize(
    ("zone", "fatigue", "helmet", "risk", "alert"),
    [
        (True, 81, True, "Critical", "CRITICAL"),
        (True, 80, True, "High", "NORMAL"),
        (True, None, False, "High", "WARNING"),
        (True, 81, False, "Critical", "CRITICAL"),
        (False, 99, False, "Normal", "WARNING"),
        (None, 99, True, "Normal", "NORMAL"),
    ],
)
def test_risk_and_alert(silver_row, zone, fatigue, helmet, risk, alert):
    row = silver_row("worker", worker(danger_zone=zone, fatigue_score=fatigue, helmet_on=helmet))
    assert (row.worker_risk_level, row.alert_level) == (risk, alert)
