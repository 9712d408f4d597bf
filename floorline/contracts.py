"""Names, types and layouts shared by every layer.

Everything in this module is a fixed value: wire formats, layer columns, target
names and store layouts are agreed with producers and consumers of the data and
must not be changed on their own.  The module holds text only, so importing it
needs no Spark session.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# Wire formats (JSON documents, every field nullable)
# --------------------------------------------------------------------------

MACHINE_WIRE = """
    event_id STRING, timestamp STRING, machine_id STRING, machine_type STRING,
    floor STRING, shift STRING, status STRING, error_code STRING, is_fault BOOLEAN,
    metrics STRUCT<temperature: DOUBLE, vibration: DOUBLE, rpm: DOUBLE, power_kw: DOUBLE>,
    cnc_sensors STRUCT<oil_level_pct: DOUBLE, coolant_pressure_bar: DOUBLE>,
    robot_sensors STRUCT<joint_torque_nm: DOUBLE, end_effector_force_n: DOUBLE>,
    conveyor_sensors STRUCT<belt_tension_n: DOUBLE, load_weight_kg: DOUBLE>,
    pump_sensors STRUCT<oil_level_pct: DOUBLE, flow_rate_lpm: DOUBLE, inlet_pressure_bar: DOUBLE>
"""

WORKER_WIRE = """
    worker_id STRING, timestamp STRING, floor STRING, zone_id STRING,
    helmet_on BOOLEAN, safety_vest_on BOOLEAN, heart_rate INT,
    movement_status STRING, danger_zone BOOLEAN, fatigue_score INT
"""

# --------------------------------------------------------------------------
# Bronze columns and the wire field each one is read from
# --------------------------------------------------------------------------

MACHINE_BRONZE_FIELDS = {
    "event_id": "event_id",
    "timestamp": "timestamp",
    "machine_id": "machine_id",
    "machine_type": "machine_type",
    "floor": "floor",
    "shift": "shift",
    "status": "status",
    "error_code": "error_code",
    "is_fault": "is_fault",
    "temperature": "metrics.temperature",
    "vibration": "metrics.vibration",
    "rpm": "metrics.rpm",
    "power_kw": "metrics.power_kw",
    "cnc_oil": "cnc_sensors.oil_level_pct",
    "coolant_pressure": "cnc_sensors.coolant_pressure_bar",
    "joint_torque": "robot_sensors.joint_torque_nm",
    "force": "robot_sensors.end_effector_force_n",
    "belt_tension": "conveyor_sensors.belt_tension_n",
    "load_weight": "conveyor_sensors.load_weight_kg",
    "flow_rate": "pump_sensors.flow_rate_lpm",
    "inlet_pressure": "pump_sensors.inlet_pressure_bar",
}

WORKER_BRONZE_FIELDS = {
    name: name
    for name in (
        "worker_id", "timestamp", "floor", "zone_id", "helmet_on", "safety_vest_on",
        "heart_rate", "movement_status", "danger_zone", "fatigue_score",
    )
}

# --------------------------------------------------------------------------
# Layer columns, in layer order
# --------------------------------------------------------------------------

REASON = "validation_reason"

MACHINE_BRONZE = tuple(MACHINE_BRONZE_FIELDS)
MACHINE_QUARANTINE = (*MACHINE_BRONZE, REASON)
MACHINE_SILVER = (
    *MACHINE_BRONZE,
    "temperature_status", "vibration_status", "fault_flag", "event_date", "event_hour",
    "health_score", "risk_score", "running_flag", "fault_category", "power_status",
    "time_bucket", "anomaly_flag",
)
MACHINE_GOLD = (
    "machine_id", "window_start", "window_end",
    "avg_temp", "avg_rpm", "avg_vibration", "avg_power",
    "avg_health_score", "min_health_score",
    "fault_count", "fault_percentage", "total_events",
    "max_temp", "max_vibration", "peak_power", "avg_risk_score", "uptime_percentage",
)

WORKER_BRONZE = tuple(WORKER_BRONZE_FIELDS)
WORKER_QUARANTINE = (*WORKER_BRONZE, REASON)
WORKER_SILVER = (
    *WORKER_BRONZE,
    "safety_violation_flag", "fatigue_status", "worker_risk_level", "alert_level",
    "heart_rate_status",
)
WORKER_GOLD = (
    "worker_id", "window_start", "window_end",
    "violations_per_window", "workers_in_danger_zone", "avg_fatigue_score",
)

LAYERS = {
    ("machine", "bronze"): MACHINE_BRONZE,
    ("machine", "quarantine"): MACHINE_QUARANTINE,
    ("machine", "silver"): MACHINE_SILVER,
    ("machine", "gold"): MACHINE_GOLD,
    ("worker", "bronze"): WORKER_BRONZE,
    ("worker", "quarantine"): WORKER_QUARANTINE,
    ("worker", "silver"): WORKER_SILVER,
    ("worker", "gold"): WORKER_GOLD,
}

# The columns that identify one gold row, whatever its revision.
GOLD_KEYS = {
    "machine": ("machine_id", "window_start"),
    "worker": ("worker_id", "window_start"),
}

# --------------------------------------------------------------------------
# Relational tables (name, then one "column type" per line)
# --------------------------------------------------------------------------

_MACHINE_EVENT_COLUMNS = """
    event_id VARCHAR(100)
    timestamp TIMESTAMP
    machine_id VARCHAR(50)
    machine_type VARCHAR(50)
    floor VARCHAR(10)
    shift VARCHAR(20)
    status VARCHAR(20)
    error_code VARCHAR(20)
    is_fault BOOLEAN
    temperature DOUBLE
    vibration DOUBLE
    rpm DOUBLE
    power_kw DOUBLE
    cnc_oil DOUBLE
    coolant_pressure DOUBLE
    joint_torque DOUBLE
    force DOUBLE
    belt_tension DOUBLE
    load_weight DOUBLE
    flow_rate DOUBLE
    inlet_pressure DOUBLE
"""

_WORKER_EVENT_COLUMNS = """
    worker_id VARCHAR(50)
    timestamp TIMESTAMP
    floor VARCHAR(10)
    zone_id VARCHAR(50)
    helmet_on BOOLEAN
    safety_vest_on BOOLEAN
    heart_rate INTEGER
    movement_status VARCHAR(20)
    danger_zone BOOLEAN
    fatigue_score DOUBLE
"""

RELATIONAL_TABLES = {
    "machine_events_bronze": _MACHINE_EVENT_COLUMNS,
    "machine_events_quarantine": _MACHINE_EVENT_COLUMNS + "validation_reason VARCHAR(255)",
    "machine_events_silver": _MACHINE_EVENT_COLUMNS.replace("floor VARCHAR(10)", "floor VARCHAR(20)") + """
        temperature_status VARCHAR(20)
        vibration_status VARCHAR(20)
        fault_flag INTEGER
        event_date DATE
        event_hour INTEGER
        health_score DOUBLE
        risk_score DOUBLE
        running_flag INTEGER
        fault_category VARCHAR(50)
        power_status VARCHAR(20)
        time_bucket VARCHAR(20)
        anomaly_flag INTEGER
    """,
    "machine_aggregates_gold": """
        machine_id VARCHAR(50)
        window_start TIMESTAMP
        window_end TIMESTAMP
        avg_temp DOUBLE
        max_temp DOUBLE
        avg_rpm DOUBLE
        avg_vibration DOUBLE
        max_vibration DOUBLE
        avg_power DOUBLE
        peak_power DOUBLE
        avg_health_score DOUBLE
        min_health_score DOUBLE
        avg_risk_score DOUBLE
        uptime_percentage DOUBLE
        fault_count BIGINT
        total_events BIGINT
        fault_percentage DOUBLE
    """,
    "worker_events_bronze": _WORKER_EVENT_COLUMNS,
    "worker_events_quarantine": _WORKER_EVENT_COLUMNS + "validation_reason VARCHAR(255)",
    "worker_events_silver": """
        worker_id VARCHAR(50)
        timestamp TIMESTAMP
        floor VARCHAR(10)
        zone_id VARCHAR(50)
        helmet_on BOOLEAN
        safety_vest_on BOOLEAN
        heart_rate INTEGER
        heart_rate_status VARCHAR(20)
        movement_status VARCHAR(20)
        danger_zone BOOLEAN
        fatigue_score DOUBLE
        safety_violation_flag INTEGER
        fatigue_status VARCHAR(20)
        worker_risk_level VARCHAR(20)
        alert_level VARCHAR(20)
    """,
    "worker_safety_gold": """
        worker_id VARCHAR(50)
        window_start TIMESTAMP
        window_end TIMESTAMP
        violations_per_window BIGINT
        workers_in_danger_zone BIGINT
        avg_fatigue_score DOUBLE
    """,
}

# --------------------------------------------------------------------------
# Search indexes.  Columns as the layer in the listed order,
# readings held as 32-bit floats.
# --------------------------------------------------------------------------

SEARCH_INDEXES = {
    "machine-events": MACHINE_SILVER,
    "machine-aggregates": MACHINE_GOLD,
    "worker-events": (
        "worker_id", "timestamp", "floor", "zone_id", "helmet_on", "safety_vest_on",
        "heart_rate", "heart_rate_status", "movement_status", "danger_zone", "fatigue_score",
        "safety_violation_flag", "fatigue_status", "worker_risk_level", "alert_level",
    ),
    "worker-safety": WORKER_GOLD,
}


def relational_columns(table: str) -> list[tuple[str, str]]:
    """``(column, SQL type)`` pairs of a relational table, in table order."""
    rows = (line.split(maxsplit=1) for line in RELATIONAL_TABLES[table].splitlines())
    return [(name, sql_type) for name, sql_type in (row for row in rows if row)]
