from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from floorline.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw payloads from dicts (as JSON) or text."""

    def build(*documents):
        texts = [d if isinstance(d, str) else json.dumps(d) for d in documents]
        return spark.createDataFrame([(t.encode(),) for t in texts], "value BINARY")

    return build


def machine(**changes):
    """A good machine document; ``metrics`` entries can be given by name."""
    metrics = {"temperature": 70.0, "vibration": 1.0, "rpm": 1000.0, "power_kw": 2.0}
    document = {
        "event_id": "e", "timestamp": "2024-01-01T00:00:00+00:00", "machine_id": "CNC_01",
        "machine_type": "cnc_machine", "floor": "A", "shift": "night", "status": "running",
        "error_code": None, "is_fault": False,
    }
    for name, value in changes.items():
        (metrics if name in metrics else document)[name] = value
    return {**document, "metrics": metrics}


def worker(**changes):
    return {
        "worker_id": "W001", "timestamp": "2024-01-01T00:00:00+00:00", "floor": "A",
        "zone_id": "ZONE_1", "helmet_on": True, "safety_vest_on": True, "heart_rate": 80,
        "movement_status": "ACTIVE", "danger_zone": False, "fatigue_score": 20, **changes,
    }
