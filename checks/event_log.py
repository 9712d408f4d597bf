"""Raw payloads derived from a generic event log.

Turns an ``events(event_id, ts, user_id, event_type, value, props)`` table into
the JSON documents machines and workers send, dirty ones included, so that the
whole decode path can be run on any such table.  Every field is a function of the
row alone: no shuffle, no ordering, any number of files.  The event time is
``ts``; users share a fleet of ``UNITS`` machines or workers, so windows become
denser as a log grows.

``n`` is the event id, ``u`` the unit, ``k`` the number in ``props`` and ``at``
the event time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorline.functions.once import expand_once

# Some values of ``k`` stand for one kind of dirt each.
UNITS = 20
_K = "CAST(get_json_object(props, '$.k') AS INT)"

_WIRE_TIME = """
    CASE k WHEN 11 THEN NULL WHEN 12 THEN 'yesterday'
           ELSE date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX") END"""

_MACHINE = f"""named_struct(
    'event_id', concat('EV_', n),
    'timestamp', {_WIRE_TIME},
    'machine_id', CASE k WHEN 9 THEN '' WHEN 10 THEN NULL
                  ELSE concat('UNIT_', u) END,
    'machine_type', element_at(array('mill', 'arm', 'belt', 'pump'), CAST(u % 4 + 1 AS INT)),
    'floor', element_at(array('north', 'south', 'east'), CAST(u % 3 + 1 AS INT)),
    'shift', element_at(array('early', 'day', 'late'), CAST(hour(at) div 8 + 1 AS INT)),
    'status', CASE WHEN k = 8 THEN 'melted' WHEN event_type = 'error' THEN 'fault'
                   WHEN event_type = 'view' THEN 'idle' ELSE 'running' END,
    'error_code', CASE WHEN event_type = 'error' THEN concat('E00', 1 + user_id % 8) END,
    'is_fault', CASE WHEN k <> 56 THEN event_type = 'error' END,
    'metrics', named_struct(
        'temperature', CASE WHEN k IN (0, 1, 2) THEN NULL WHEN k IN (3, 4) THEN 400D ELSE 50D + value * 0.5D END,
        'vibration', CASE WHEN k <> 55 THEN 1.5D + k % 50 / 10D END,
        'rpm', CASE k WHEN 5 THEN -1D WHEN 6 THEN NULL ELSE CAST(900 + n % 600 AS DOUBLE) END,
        'power_kw', CASE k WHEN 7 THEN -2.5D ELSE 1.5D + n % 50 / 10D END),
    'cnc_sensors', CASE u % 4 WHEN 0 THEN named_struct(
        'oil_level_pct', CAST(k AS DOUBLE), 'coolant_pressure_bar', CAST(n % 100 AS DOUBLE)) END,
    'robot_sensors', CASE u % 4 WHEN 1 THEN named_struct(
        'joint_torque_nm', CAST(k AS DOUBLE), 'end_effector_force_n', CAST(n % 100 AS DOUBLE)) END,
    'conveyor_sensors', CASE u % 4 WHEN 2 THEN named_struct(
        'belt_tension_n', CAST(k AS DOUBLE), 'load_weight_kg', CAST(n % 100 AS DOUBLE)) END,
    'pump_sensors', CASE u % 4 WHEN 3 THEN named_struct(
        'oil_level_pct', CAST(k AS DOUBLE), 'flow_rate_lpm', CAST(k AS DOUBLE),
        'inlet_pressure_bar', CAST(n % 100 AS DOUBLE)) END)"""

_WORKER = f"""named_struct(
    'worker_id', CASE k WHEN 9 THEN '' WHEN 10 THEN NULL ELSE concat('HAND_', u) END,
    'timestamp', {_WIRE_TIME},
    'floor', element_at(array('north', 'south', 'east'), CAST(u % 3 + 1 AS INT)),
    'zone_id', concat('AREA_', u % 5),
    'helmet_on', value >= 2,
    'safety_vest_on', CASE WHEN k <> 55 THEN value < 150 END,
    'heart_rate', CASE k WHEN 5 THEN -7 WHEN 6 THEN NULL ELSE 60 + k % 70 END,
    'movement_status', CASE k WHEN 8 THEN 'SWIMMING'
                       ELSE element_at(array('ACTIVE', 'IDLE', 'WALKING'), CAST(n % 3 + 1 AS INT)) END,
    'danger_zone', CASE WHEN k <> 56 THEN event_type = 'error' END,
    'fatigue_score', CASE WHEN k <> 57 THEN 10 + n * 7 % 91 END)"""


def _payloads(events: DataFrame, document: str, delay: str | None) -> DataFrame:
    keyed = expand_once(events, F.expr(f"""named_struct(
        'n', event_id, 'u', user_id % {UNITS}, 'user_id', user_id, 'event_type', event_type, 'value', value, 'k', {_K},
        'ts', CAST(ts AS TIMESTAMP))"""))
    timed = keyed.selectExpr("*", f"ts - {delay} AS at" if delay else "ts AS at")
    return timed.selectExpr(
        "n AS event_id", f"CAST(CASE k WHEN 13 THEN 'not json' ELSE to_json({document}) END AS BINARY) AS value"
    )


def machine_payloads(events: DataFrame, delay: str | None = None) -> DataFrame:
    """``(event_id, value)``: one machine document per event.

    ``delay`` is an interval in SQL, possibly a function of ``n`` and ``k``, by
    which an event happened earlier than it arrives.
    """
    return _payloads(events, _MACHINE, delay)


def worker_payloads(events: DataFrame, delay: str | None = None) -> DataFrame:
    """``(event_id, value)``: one worker document per event; ``delay`` as above."""
    return _payloads(events, _WORKER, delay)


PAYLOADS = {"machine": machine_payloads, "worker": worker_payloads}
