from __future__ import annotations

import pytest
from conftest import SMALL, machine, worker

from checks.queries import raw_of
from floorline.operators.decode import machine_bronze, worker_bronze
from floorline.operators.quality import MACHINE_RULES, RULES, WORKER_RULES, quarantine, unrouted, valid
from floorline.plans.layers import bronze_layer


def routed(bronze, rules):
    """Where each single row goes: its reason, 'valid' or 'unrouted'."""
    found = [row.validation_reason for row in quarantine(bronze, rules).collect()]
    found += ["valid"] * valid(bronze, rules).count()
    found += ["unrouted"] * unrouted(bronze, rules).count()
    return found


@pytest.mark.parametrize(
    ("changes", "expected"),
    [
        ({}, "valid"),
        ({"timestamp": None}, "NULL_TIMESTAMP"),
        ({"timestamp": "garbage"}, "NULL_TIMESTAMP"),
        ({"temperature": None}, "NULL_TEMPERATURE"),
        ({"temperature": -20}, "valid"),
        ({"temperature": 150}, "valid"),
        ({"temperature": -20.01}, "TEMPERATURE_OUT_OF_RANGE"),
        ({"temperature": 150.01}, "TEMPERATURE_OUT_OF_RANGE"),
        ({"temperature": float("nan")}, "TEMPERATURE_OUT_OF_RANGE"),
        ({"rpm": -1}, "INVALID_RPM"),
        ({"rpm": 0}, "valid"),
        ({"rpm": float("nan")}, "valid"),
        ({"rpm": None}, "unrouted"),
        ({"power_kw": -0.1}, "INVALID_POWER"),
        ({"power_kw": None}, "unrouted"),
        ({"status": "BROKEN_STATUS"}, "INVALID_STATUS"),
        ({"status": "Running"}, "INVALID_STATUS"),
        ({"status": None}, "unrouted"),
        ({"machine_id": ""}, "EMPTY_MACHINE_ID"),
        ({"machine_id": None}, "unrouted"),
        ({"timestamp": None, "rpm": -1}, "NULL_TIMESTAMP"),
        ({"rpm": None, "machine_id": ""}, "EMPTY_MACHINE_ID"),
        ({"vibration": None, "is_fault": None, "error_code": None}, "valid"),
    ],
)
def test_machine_rules(raw, changes, expected):
    assert routed(machine_bronze(raw(machine(**changes))), MACHINE_RULES) == [expected]


@pytest.mark.parametrize(
    ("changes", "expected"),
    [
        ({}, "valid"),
        ({"timestamp": None}, "NULL_TIMESTAMP"),
        ({"worker_id": ""}, "EMPTY_WORKER_ID"),
        ({"worker_id": None}, "unrouted"),
        ({"heart_rate": -20}, "INVALID_HEART_RATE"),
        ({"heart_rate": 0}, "valid"),
        ({"heart_rate": None}, "unrouted"),
        ({"movement_status": "FLYING"}, "INVALID_MOVEMENT_STATUS"),
        ({"movement_status": None}, "unrouted"),
        ({"worker_id": "", "heart_rate": -1}, "EMPTY_WORKER_ID"),
    ],
)
def test_worker_rules(raw, changes, expected):
    assert routed(worker_bronze(raw(worker(**changes))), WORKER_RULES) == [expected]


@pytest.mark.parametrize("domain", ["machine", "worker"])
def test_every_row_goes_to_exactly_one_place(spark, domain):
    bronze = bronze_layer(raw_of(spark, SMALL, domain), domain)
    rules = RULES[domain]
    parts = [valid(bronze, rules), quarantine(bronze, rules).drop("validation_reason"), unrouted(bronze, rules)]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert together.count() == bronze.count()
    assert together.exceptAll(bronze).isEmpty() and bronze.exceptAll(together).isEmpty()


@pytest.mark.parametrize(
    ("domain", "expected"),
    [
        ("machine", {
            "NULL_TIMESTAMP": 25, "NULL_TEMPERATURE": 33, "TEMPERATURE_OUT_OF_RANGE": 36, "INVALID_RPM": 8,
            "INVALID_POWER": 8, "INVALID_STATUS": 7, "EMPTY_MACHINE_ID": 14,
        }),
        ("worker", {
            "NULL_TIMESTAMP": 25, "EMPTY_WORKER_ID": 14, "INVALID_HEART_RATE": 8, "INVALID_MOVEMENT_STATUS": 7,
        }),
    ],
)
def test_reasons_on_the_event_log(spark, domain, expected):
    bronze = bronze_layer(raw_of(spark, SMALL, domain), domain)
    counted = quarantine(bronze, RULES[domain]).groupBy("validation_reason").count().collect()
    assert {row.validation_reason: row["count"] for row in counted} == expected
