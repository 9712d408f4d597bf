"""DuckDB SQL for every registered query, written straight against ``events``.

The SQL states the expected result on its own: it shares no code, constants or
JSON step with the library.
"""

from __future__ import annotations

EVENTS = """
ev AS (
  SELECT event_id AS n, user_id % 20 AS u, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, ts AS event_time
  FROM events
)"""

# Events of the late-data query happened up to 95 hours before they arrive.
LATE_EVENTS = """
punctual AS (
  SELECT event_id AS n, user_id % 20 AS u, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, ts AS event_time
  FROM events
),
ev AS (
  SELECT n, u, user_id, event_type, value, k,
         event_time - to_hours(CASE WHEN k >= 80 THEN (k - 80) * 5 ELSE 0 END) AS event_time
  FROM punctual
)"""

MACHINE_BRONZE = """
parsed AS (
  SELECT n, 'EV_' || n AS event_id,
         CASE WHEN k IN (11, 12) THEN NULL ELSE event_time END AS "timestamp",
         CASE WHEN k = 9 THEN '' WHEN k = 10 THEN NULL
              ELSE 'UNIT_' || u END AS machine_id,
         ['mill', 'arm', 'belt', 'pump'][u % 4 + 1] AS machine_type,
         ['north', 'south', 'east'][u % 3 + 1] AS floor,
         ['early', 'day', 'late'][hour(event_time) // 8 + 1] AS shift,
         CASE WHEN k = 8 THEN 'melted' WHEN event_type = 'error' THEN 'fault'
              WHEN event_type = 'view' THEN 'idle' ELSE 'running' END AS status,
         CASE WHEN event_type = 'error' THEN 'E00' || (1 + user_id % 8) END AS error_code,
         CASE WHEN k <> 56 THEN event_type = 'error' END AS is_fault,
         CASE WHEN k <= 2 THEN NULL WHEN k <= 4 THEN 400.0::DOUBLE
              ELSE 50.0::DOUBLE + value * 0.5::DOUBLE END AS temperature,
         CASE WHEN k <> 55 THEN 1.5::DOUBLE + (k % 50) / 10.0::DOUBLE END AS vibration,
         CASE WHEN k = 5 THEN -1.0::DOUBLE WHEN k = 6 THEN NULL
              ELSE (900 + n % 600)::DOUBLE END AS rpm,
         CASE WHEN k = 7 THEN -2.5::DOUBLE ELSE 1.5::DOUBLE + (n % 50) / 10.0::DOUBLE END AS power_kw,
         CASE WHEN u % 4 = 0 THEN k::DOUBLE END AS cnc_oil,
         CASE WHEN u % 4 = 0 THEN (n % 100)::DOUBLE END AS coolant_pressure,
         CASE WHEN u % 4 = 1 THEN k::DOUBLE END AS joint_torque,
         CASE WHEN u % 4 = 1 THEN (n % 100)::DOUBLE END AS force,
         CASE WHEN u % 4 = 2 THEN k::DOUBLE END AS belt_tension,
         CASE WHEN u % 4 = 2 THEN (n % 100)::DOUBLE END AS load_weight,
         CASE WHEN u % 4 = 3 THEN k::DOUBLE END AS flow_rate,
         CASE WHEN u % 4 = 3 THEN (n % 100)::DOUBLE END AS inlet_pressure
  FROM ev WHERE k <> 13
),
bronze AS (
  SELECT * FROM parsed UNION ALL BY NAME SELECT n FROM ev WHERE k = 13
)"""

MACHINE_VALID = """
valid AS (
  SELECT * FROM bronze
  WHERE "timestamp" IS NOT NULL AND temperature >= -20 AND temperature <= 150
    AND rpm >= 0 AND power_kw >= 0 AND status IN ('running', 'idle', 'fault') AND machine_id <> ''
)"""

MACHINE_SILVER = """
silver AS (
  SELECT *,
    CASE WHEN temperature > 90 THEN 'Critical' WHEN temperature > 80 THEN 'Warning' ELSE 'Normal' END
      AS temperature_status,
    CASE WHEN vibration > 5 THEN 'Critical' WHEN vibration > 3 THEN 'Warning' ELSE 'Normal' END
      AS vibration_status,
    CAST(CASE WHEN is_fault THEN 1 ELSE 0 END AS INTEGER) AS fault_flag,
    CAST("timestamp" AS DATE) AS event_date,
    CAST(hour("timestamp") AS INTEGER) AS event_hour,
    CASE WHEN is_fault THEN 0.0::DOUBLE
         ELSE greatest(0.0::DOUBLE, 100 - temperature * 0.3::DOUBLE - vibration * 5) END AS health_score,
    temperature * 0.4::DOUBLE + vibration * 10 AS risk_score,
    CAST(CASE WHEN status = 'running' THEN 1 ELSE 0 END AS INTEGER) AS running_flag,
    CASE WHEN error_code IN ('E001', 'E003') THEN 'Overheat' WHEN error_code IN ('E002', 'E004') THEN 'Vibration'
         WHEN error_code = 'E005' THEN 'RPM Drop' ELSE 'None' END AS fault_category,
    CASE WHEN power_kw > 5 THEN 'High' WHEN power_kw > 3 THEN 'Normal' ELSE 'Low' END AS power_status,
    CASE WHEN hour("timestamp") BETWEEN 6 AND 13 THEN 'Morning'
         WHEN hour("timestamp") BETWEEN 14 AND 21 THEN 'Evening' ELSE 'Night' END AS time_bucket,
    CAST(CASE WHEN temperature > 90 THEN 1 ELSE 0 END AS INTEGER) AS anomaly_flag
  FROM valid
)"""

MACHINE_GOLD = """
gold AS (
  SELECT machine_id,
    date_trunc('minute', "timestamp") AS window_start,
    date_trunc('minute', "timestamp") + INTERVAL 1 MINUTE AS window_end,
    avg(temperature) AS avg_temp, avg(rpm) AS avg_rpm, avg(vibration) AS avg_vibration,
    avg(power_kw) AS avg_power, avg(health_score) AS avg_health_score,
    min(health_score) AS min_health_score,
    CAST(sum(fault_flag) AS BIGINT) AS fault_count,
    sum(fault_flag) * 100.0::DOUBLE / count(*) AS fault_percentage,
    count(*) AS total_events,
    max(temperature) AS max_temp, max(vibration) AS max_vibration, max(power_kw) AS peak_power,
    avg(risk_score) AS avg_risk_score,
    sum(running_flag)::DOUBLE / count(*) * 100 AS uptime_percentage
  FROM silver GROUP BY ALL
)"""

WORKER_BRONZE = """
parsed AS (
  SELECT n,
         CASE WHEN k = 9 THEN '' WHEN k = 10 THEN NULL ELSE 'HAND_' || u END AS worker_id,
         CASE WHEN k IN (11, 12) THEN NULL ELSE event_time END AS "timestamp",
         ['north', 'south', 'east'][u % 3 + 1] AS floor,
         'AREA_' || (u % 5) AS zone_id,
         value >= 2 AS helmet_on,
         CASE WHEN k <> 55 THEN value < 150 END AS safety_vest_on,
         CAST(CASE WHEN k = 5 THEN -7 WHEN k = 6 THEN NULL ELSE 60 + k % 70 END AS INTEGER) AS heart_rate,
         CASE WHEN k = 8 THEN 'SWIMMING' ELSE ['ACTIVE', 'IDLE', 'WALKING'][n % 3 + 1] END AS movement_status,
         CASE WHEN k <> 56 THEN event_type = 'error' END AS danger_zone,
         CAST(CASE WHEN k <> 57 THEN 10 + (n * 7) % 91 END AS INTEGER) AS fatigue_score
  FROM ev WHERE k <> 13
),
bronze AS (
  SELECT * FROM parsed UNION ALL BY NAME SELECT n FROM ev WHERE k = 13
)"""

WORKER_VALID = """
valid AS (
  SELECT * FROM bronze
  WHERE "timestamp" IS NOT NULL AND worker_id <> '' AND heart_rate >= 0
    AND movement_status IN ('ACTIVE', 'IDLE', 'WALKING')
)"""

WORKER_SILVER = """
silver AS (
  SELECT *,
    CAST(CASE WHEN NOT helmet_on OR NOT safety_vest_on THEN 1 ELSE 0 END AS INTEGER) AS safety_violation_flag,
    CASE WHEN fatigue_score > 80 THEN 'High' WHEN fatigue_score > 50 THEN 'Medium' ELSE 'Low' END
      AS fatigue_status,
    CASE WHEN danger_zone AND fatigue_score > 80 THEN 'Critical' WHEN danger_zone THEN 'High'
         ELSE 'Normal' END AS worker_risk_level,
    CASE WHEN danger_zone AND fatigue_score > 80 THEN 'CRITICAL'
         WHEN NOT helmet_on OR NOT safety_vest_on THEN 'WARNING' ELSE 'NORMAL' END AS alert_level,
    CASE WHEN heart_rate > 120 THEN 'High' WHEN heart_rate > 90 THEN 'Elevated' ELSE 'Normal' END
      AS heart_rate_status
  FROM valid
)"""

WORKER_GOLD = """
gold AS (
  SELECT worker_id,
    time_bucket(INTERVAL 5 MINUTE, "timestamp") AS window_start,
    time_bucket(INTERVAL 5 MINUTE, "timestamp") + INTERVAL 5 MINUTE AS window_end,
    CAST(sum(safety_violation_flag) AS BIGINT) AS violations_per_window,
    CAST(sum(CASE WHEN danger_zone THEN 1 ELSE 0 END) AS BIGINT) AS workers_in_danger_zone,
    avg(fatigue_score) AS avg_fatigue_score
  FROM silver GROUP BY ALL
)"""

QUARANTINE = {
    "machine": """
quarantine AS (
  SELECT * FROM (
    SELECT *,
      CASE WHEN "timestamp" IS NULL THEN 'NULL_TIMESTAMP'
           WHEN temperature IS NULL THEN 'NULL_TEMPERATURE'
           WHEN temperature < -20 OR temperature > 150 THEN 'TEMPERATURE_OUT_OF_RANGE'
           WHEN rpm < 0 THEN 'INVALID_RPM'
           WHEN power_kw < 0 THEN 'INVALID_POWER'
           WHEN status NOT IN ('running', 'idle', 'fault') THEN 'INVALID_STATUS'
           WHEN machine_id = '' THEN 'EMPTY_MACHINE_ID' END AS validation_reason
    FROM bronze)
  WHERE validation_reason IS NOT NULL
)""",
    "worker": """
quarantine AS (
  SELECT * FROM (
    SELECT *,
      CASE WHEN "timestamp" IS NULL THEN 'NULL_TIMESTAMP'
           WHEN worker_id = '' THEN 'EMPTY_WORKER_ID'
           WHEN heart_rate < 0 THEN 'INVALID_HEART_RATE'
           WHEN movement_status NOT IN ('ACTIVE', 'IDLE', 'WALKING') THEN 'INVALID_MOVEMENT_STATUS'
      END AS validation_reason
    FROM bronze)
  WHERE validation_reason IS NOT NULL
)""",
}

UNROUTED = """
unrouted AS (
  SELECT * FROM bronze
  WHERE n NOT IN (SELECT n FROM valid) AND n NOT IN (SELECT n FROM quarantine)
)"""

# Valid rows that are not late: the windows that ended a minute or more before the
# newest valid event of earlier starts are closed.  A slice here is what one start
# finds; of its micro-batches the second still goes by the watermark of the first.
NOT_LATE = """
bounds AS (SELECT min(event_id) AS first, max(event_id) - min(event_id) + 1 AS width FROM events),
sliced AS (SELECT valid.*, (n - first) * 3 // width AS slice FROM valid, bounds),
newest AS (SELECT slice, max("timestamp") AS newest FROM sliced GROUP BY slice),
closing AS (
  SELECT slice, max(newest) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                - INTERVAL 1 MINUTE AS closed_until
  FROM newest
),
on_time AS (
  SELECT sliced.* FROM sliced JOIN closing USING (slice)
  WHERE closed_until IS NULL OR date_trunc('minute', "timestamp") + INTERVAL 1 MINUTE > closed_until
)"""

# The closing stream goes by the newest event of all earlier micro-batches, six in all.
BATCH_LATE = NOT_LATE.replace("* 3 // width", "* 6 // width") + """,
too_late AS (SELECT * FROM sliced WHERE n NOT IN (SELECT n FROM on_time)),
final AS (SELECT max("timestamp") - INTERVAL 1 MINUTE AS closed_until FROM sliced)"""

STEPS = {
    "machine": {
        "bronze": [MACHINE_BRONZE],
        "valid": [MACHINE_BRONZE, MACHINE_VALID],
        "quarantine": [MACHINE_BRONZE, QUARANTINE["machine"]],
        "unrouted": [MACHINE_BRONZE, MACHINE_VALID, QUARANTINE["machine"], UNROUTED],
        "silver": [MACHINE_BRONZE, MACHINE_VALID, MACHINE_SILVER],
        "gold": [MACHINE_BRONZE, MACHINE_VALID, MACHINE_SILVER, MACHINE_GOLD],
    },
    "worker": {
        "bronze": [WORKER_BRONZE],
        "valid": [WORKER_BRONZE, WORKER_VALID],
        "quarantine": [WORKER_BRONZE, QUARANTINE["worker"]],
        "unrouted": [WORKER_BRONZE, WORKER_VALID, QUARANTINE["worker"], UNROUTED],
        "silver": [WORKER_BRONZE, WORKER_VALID, WORKER_SILVER],
        "gold": [WORKER_BRONZE, WORKER_VALID, WORKER_SILVER, WORKER_GOLD],
    },
}

MACHINE_EVENT = (
    'event_id, "timestamp", machine_id, machine_type, floor, shift, status, error_code, is_fault, '
    "round(temperature, 7) AS temperature, round(vibration, 7) AS vibration, round(rpm, 7) AS rpm, "
    "round(power_kw, 7) AS power_kw, cnc_oil, coolant_pressure, joint_torque, force, belt_tension, "
    "load_weight, flow_rate, inlet_pressure"
)
MACHINE_EXTRA = (
    "temperature_status, vibration_status, fault_flag, event_date, event_hour, "
    "round(health_score, 7) AS health_score, round(risk_score, 7) AS risk_score, running_flag, "
    "fault_category, power_status, time_bucket, anomaly_flag"
)
MACHINE_AGGREGATES = (
    "machine_id, window_start, window_end, round(avg_temp, 7) AS avg_temp, round(avg_rpm, 7) AS avg_rpm, "
    "round(avg_vibration, 7) AS avg_vibration, round(avg_power, 7) AS avg_power, "
    "round(avg_health_score, 7) AS avg_health_score, round(min_health_score, 7) AS min_health_score, "
    "fault_count, round(fault_percentage, 7) AS fault_percentage, total_events, "
    "round(max_temp, 7) AS max_temp, round(max_vibration, 7) AS max_vibration, "
    "round(peak_power, 7) AS peak_power, round(avg_risk_score, 7) AS avg_risk_score, "
    "round(uptime_percentage, 7) AS uptime_percentage"
)
WORKER_EVENT = (
    'worker_id, "timestamp", floor, zone_id, helmet_on, safety_vest_on, heart_rate, movement_status, '
    "danger_zone, fatigue_score"
)
WORKER_EXTRA = "safety_violation_flag, fatigue_status, worker_risk_level, alert_level, heart_rate_status"
WORKER_AGGREGATES = (
    "worker_id, window_start, window_end, violations_per_window, workers_in_danger_zone, "
    "round(avg_fatigue_score, 7) AS avg_fatigue_score"
)

# Relational tables keep the fatigue score as a double.
WORKER_STORED = WORKER_EVENT.replace("fatigue_score", "fatigue_score::DOUBLE AS fatigue_score")

COLUMNS = {
    ("machine", "bronze"): MACHINE_EVENT,
    ("machine", "valid"): MACHINE_EVENT,
    ("machine", "unrouted"): MACHINE_EVENT,
    ("machine", "quarantine"): f"{MACHINE_EVENT}, validation_reason",
    ("machine", "silver"): f"{MACHINE_EVENT}, {MACHINE_EXTRA}",
    ("machine", "gold"): MACHINE_AGGREGATES,
    ("worker", "bronze"): WORKER_EVENT,
    ("worker", "valid"): WORKER_EVENT,
    ("worker", "unrouted"): WORKER_EVENT,
    ("worker", "quarantine"): f"{WORKER_EVENT}, validation_reason",
    ("worker", "silver"): f"{WORKER_EVENT}, {WORKER_EXTRA}",
    ("worker", "gold"): WORKER_AGGREGATES,
}


def layer_sql(domain: str, layer: str, columns: str | None = None) -> str:
    """SELECT over one layer of one domain."""
    steps = ",".join([EVENTS, *STEPS[domain][layer]])
    return f"WITH {steps}\nSELECT {columns or COLUMNS[domain, layer]} FROM {layer}"


def as_floats(columns: str) -> str:
    """Readings as a search index holds them: 32-bit floats of the unrounded doubles."""
    return ", ".join(f"{name}::FLOAT AS {name}" if name in FLOATS else name for name in _names(columns))


def _names(columns: str) -> list[str]:
    """Output names of a column list in which only ``round(x, 7) AS x`` holds commas."""
    return [part.split(" AS ")[-1] for part in columns.replace(", 7)", ")").split(", ")]


FLOATS = {
    "temperature", "vibration", "rpm", "power_kw", "cnc_oil", "coolant_pressure", "joint_torque",
    "force", "belt_tension", "load_weight", "flow_rate", "inlet_pressure", "health_score", "risk_score",
    "avg_temp", "avg_rpm", "avg_vibration", "avg_power", "avg_health_score", "min_health_score",
    "fault_percentage", "max_temp", "max_vibration", "peak_power", "avg_risk_score",
    "uptime_percentage", "avg_fatigue_score",
}


def local(instant: str) -> str:
    """Wall clock of the plant for a UTC date-time."""
    return f"timezone('Africa/Cairo', timezone('UTC', {instant}))"


CAIRO_TIME = local('"timestamp"') + " AS cairo_time"


def series_sql(domain: str, layer: str, ts: str, reading: str, out: str) -> str:
    """Median per hour, hours without events included."""
    steps = ",".join([EVENTS, *STEPS[domain][layer]])
    return f"""WITH {steps},
medians AS (
  SELECT date_trunc('hour', {ts}) AS bucket, round(median({reading}::DOUBLE), 7) AS {out} FROM {layer} GROUP BY 1
),
spine AS (
  SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL 1 HOUR)) AS bucket FROM medians
)
SELECT spine.bucket, {out} FROM spine LEFT JOIN medians USING (bucket)"""


def machine_json_sql() -> str:
    nullable = (
        "error_code", "is_fault", "vibration", "risk_score", "cnc_oil", "coolant_pressure", "joint_torque",
        "force", "belt_tension", "load_weight", "flow_rate", "inlet_pressure",
    )
    absent = " - ".join(f"({name} IS NULL)::INTEGER" for name in nullable)
    columns = f"{MACHINE_EVENT}, {MACHINE_EXTRA}".replace(
        '"timestamp"', """strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%gZ') AS "timestamp\""""
    ).replace("event_date", "strftime(event_date, '%Y-%m-%d') AS event_date")
    return layer_sql("machine", "silver", f"CAST(33 - {absent} AS INTEGER) AS n_fields, {columns}")


def late_gold_sql() -> str:
    """Gold over the rows that are not late."""
    silver = MACHINE_SILVER.replace("FROM valid", "FROM on_time")
    steps = ",".join([LATE_EVENTS, MACHINE_BRONZE, MACHINE_VALID, NOT_LATE, silver, MACHINE_GOLD])
    return f"WITH {steps}\nSELECT {MACHINE_AGGREGATES} FROM gold"


def closing_sql(source: str, columns: str) -> str:
    """Late events, or windows over the others that the last watermark has closed."""
    silver = MACHINE_SILVER.replace("FROM valid", f"FROM {source}")
    steps = ",".join([LATE_EVENTS, MACHINE_BRONZE, MACHINE_VALID, BATCH_LATE, silver, MACHINE_GOLD])
    closed = " WHERE window_end <= (SELECT closed_until FROM final)" if source == "on_time" else ""
    return f"WITH {steps}\nSELECT {columns} FROM {'gold' if closed else 'silver'}{closed}"


def outcomes_sql(domain: str) -> str:
    steps = ",".join([EVENTS, *dict.fromkeys([*STEPS[domain]["quarantine"], *STEPS[domain]["unrouted"]])])
    return f"""WITH {steps}
SELECT outcome, count(*) AS n FROM (
  SELECT validation_reason AS outcome FROM quarantine UNION ALL SELECT 'VALID' FROM valid UNION ALL SELECT 'UNROUTED' FROM unrouted
) GROUP BY 1"""


def sketched_sql(domain: str, reading: str) -> str:
    steps = ",".join([EVENTS, *STEPS[domain]["silver"]])
    return f"""WITH {steps}
SELECT date_trunc('day', "timestamp") AS bucket, count({reading}) AS readings, true AS close FROM silver WHERE {reading} IS NOT NULL GROUP BY 1"""


def bulk_sql(domain: str, columns: str) -> str:
    """An index's fields with times as documents hold them."""
    shown = columns.replace('"timestamp"', """strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%gZ') AS "timestamp\"""").replace(
        "event_date", "strftime(event_date, '%Y-%m-%d') AS event_date")
    return layer_sql(domain, "silver", shown)


def unknown_sql() -> str:
    """The one field of the payloads that bronze has no column for."""
    steps = ",".join([EVENTS, *STEPS["machine"]["bronze"]])
    return f"""WITH {steps}
SELECT event_id, flow_rate, CASE WHEN k = 13 THEN 'not json' END AS unread,
  CASE WHEN k <> 13 AND u % 4 = 3 THEN k::DOUBLE END AS pump_sensors_oil_level_pct
FROM bronze JOIN (SELECT n, u, k FROM ev) USING (n)"""


def computed_sql(domain: str, columns: str) -> str:
    identity = {"machine": "event_id", "worker": 'worker_id, "timestamp"'}[domain]
    return layer_sql(domain, "silver", f"{identity}, {columns}")


def oracle() -> dict[str, str]:
    temperature = "round(temperature, 7) AS temperature"
    vibration = "round(vibration, 7) AS vibration"
    worker_silver_stored = f"{WORKER_STORED}, {WORKER_EXTRA}"
    return {
        "machine_decode_bronze": layer_sql("machine", "bronze"),
        "worker_decode_bronze": layer_sql("worker", "bronze"),
        "machine_quarantine": layer_sql("machine", "quarantine"),
        "worker_quarantine": layer_sql("worker", "quarantine"),
        "machine_valid": layer_sql("machine", "valid"),
        "worker_valid": layer_sql("worker", "valid"),
        "machine_unrouted": layer_sql("machine", "unrouted"),
        "worker_unrouted": layer_sql("worker", "unrouted"),
        "machine_temperature_status": computed_sql("machine", f"{temperature}, temperature_status"),
        "machine_vibration_status": computed_sql("machine", f"{vibration}, vibration_status"),
        "machine_fault_flag": computed_sql("machine", "is_fault, fault_flag"),
        "machine_event_date_hour": computed_sql("machine", '"timestamp", event_date, event_hour'),
        "machine_health_score": computed_sql(
            "machine", f"is_fault, {temperature}, {vibration}, round(health_score, 7) AS health_score"
        ),
        "machine_risk_score": computed_sql(
            "machine", f"{temperature}, {vibration}, round(risk_score, 7) AS risk_score"
        ),
        "machine_running_flag": computed_sql("machine", "status, running_flag"),
        "machine_fault_category": computed_sql("machine", "error_code, fault_category"),
        "machine_power_status": computed_sql("machine", "round(power_kw, 7) AS power_kw, power_status"),
        "machine_time_bucket": computed_sql("machine", '"timestamp", time_bucket'),
        "machine_anomaly_flag": computed_sql("machine", f"{temperature}, anomaly_flag"),
        "worker_safety_violation": computed_sql("worker", "helmet_on, safety_vest_on, safety_violation_flag"),
        "worker_fatigue_status": computed_sql("worker", "fatigue_score, fatigue_status"),
        "worker_risk_level": computed_sql("worker", "danger_zone, fatigue_score, worker_risk_level"),
        "worker_alert_level": computed_sql(
            "worker", "danger_zone, fatigue_score, helmet_on, safety_vest_on, alert_level"
        ),
        "worker_heart_rate_status": computed_sql("worker", "heart_rate, heart_rate_status"),
        "machine_silver": layer_sql("machine", "silver"),
        "worker_silver": layer_sql("worker", "silver"),
        "machine_gold": layer_sql("machine", "gold"),
        "worker_gold": layer_sql("worker", "gold"),
        "machine_silver_json": machine_json_sql(),
        "relational_machine_events_bronze": layer_sql("machine", "bronze"),
        "relational_machine_events_quarantine": layer_sql("machine", "quarantine"),
        "relational_machine_events_silver": layer_sql("machine", "silver"),
        "relational_machine_aggregates_gold": layer_sql("machine", "gold"),
        "relational_worker_events_bronze": layer_sql("worker", "bronze", WORKER_STORED),
        "relational_worker_events_quarantine": layer_sql(
            "worker", "quarantine", f"{WORKER_STORED}, validation_reason"
        ),
        "relational_worker_events_silver": layer_sql("worker", "silver", worker_silver_stored),
        "relational_worker_safety_gold": layer_sql("worker", "gold"),
        "machine_events_index": layer_sql("machine", "silver", as_floats(f"{MACHINE_EVENT}, {MACHINE_EXTRA}")),
        "machine_aggregates_index": layer_sql("machine", "gold", as_floats(MACHINE_AGGREGATES)),
        "worker_events_index": layer_sql("worker", "silver"),
        "worker_safety_index": layer_sql("worker", "gold", as_floats(WORKER_AGGREGATES)),
        "worker_events_quarantine_view": layer_sql(
            "worker", "quarantine", f'{WORKER_STORED}, validation_reason, {CAIRO_TIME}'
        ),
        "machine_events_quarantine_view": layer_sql(
            "machine", "quarantine", f'{MACHINE_EVENT}, validation_reason, {CAIRO_TIME}'
        ),
        "worker_events_bronze_view": layer_sql(
            "worker", "bronze", f'{WORKER_STORED}, {CAIRO_TIME}'
        ),
        "worker_events_silver_view": layer_sql(
            "worker", "silver", f'{worker_silver_stored}, {CAIRO_TIME}'
        ),
        "worker_safety_gold_view": layer_sql(
            "worker",
            "gold",
            f"{WORKER_AGGREGATES}, {local('window_start')} AS cairo_window_start, "
            f"{local('window_end')} AS cairo_window_end",
        ),
        "median_temperature": series_sql("machine", "silver", '"timestamp"', "temperature", "median_temperature"),
        "median_vibration": series_sql("machine", "gold", "window_start", "avg_vibration", "median_avg_vibration"),
        "median_fatigue": series_sql(
            "worker", "gold", "window_start", "avg_fatigue_score", "median_avg_fatigue_score"
        ),
        "median_heart_rate": series_sql("worker", "silver", '"timestamp"', "heart_rate", "median_heart_rate"),
        "stream_machine_gold_update": layer_sql("machine", "gold"),
        "stream_worker_gold_update": layer_sql("worker", "gold"),
        "stream_late_data": late_gold_sql(),
        "stream_silver_append": layer_sql("machine", "silver"),
        "stream_bronze_append": layer_sql("worker", "bronze"),
        "stream_worker_silver_append": layer_sql("worker", "silver"),
        "stream_domain_gold_view": layer_sql(
            "worker", "gold",
            f"{WORKER_AGGREGATES}, {local('window_start')} AS cairo_window_start, {local('window_end')} AS cairo_window_end",
        ),
        "stream_gold_panel": series_sql("machine", "gold", "window_start", "avg_vibration", "median_avg_vibration"),
        "parquet_sink_roundtrip": layer_sql("machine", "bronze"),
        "lake_compaction_roundtrip": layer_sql("machine", "bronze"),
        "lake_compacted_gold": layer_sql("worker", "gold"),
        "stream_closed_windows": closing_sql("on_time", MACHINE_AGGREGATES),
        "stream_late_events": closing_sql("too_late", COLUMNS["machine", "silver"]),
        "stream_machine_outcomes": outcomes_sql("machine"),
        "stream_worker_outcomes": outcomes_sql("worker"),
        "machine_events_bulk": bulk_sql("machine", as_floats(f"{MACHINE_EVENT}, {MACHINE_EXTRA}")),
        "worker_events_bulk": bulk_sql("worker", COLUMNS["worker", "silver"]),
        "machine_unknown_fields": unknown_sql(),
        "sketched_temperature": sketched_sql("machine", "temperature"),
        "sketched_heart_rate": sketched_sql("worker", "heart_rate"),
        "machine_gold_merged": layer_sql("machine", "gold"),
        "worker_gold_merged": layer_sql("worker", "gold"),
    }
