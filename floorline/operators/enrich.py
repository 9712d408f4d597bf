"""Valid rows -> silver: one projection that adds every computed column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from floorline.functions import clock, labels, scores


def machine_columns() -> dict[str, Column]:
    """Computed columns of a machine event, in layer order."""
    return {
        "temperature_status": labels.ladder("temperature_status"),
        "vibration_status": labels.ladder("vibration_status"),
        "fault_flag": scores.fault_flag(),
        "event_date": clock.event_date(),
        "event_hour": clock.event_hour(),
        "health_score": scores.health_score(),
        "risk_score": scores.risk_score(),
        "running_flag": scores.running_flag(),
        "fault_category": labels.fault_category(),
        "power_status": labels.ladder("power_status"),
        "time_bucket": clock.time_bucket(),
        "anomaly_flag": scores.anomaly_flag(),
    }


def worker_columns() -> dict[str, Column]:
    """Computed columns of a worker event, in layer order."""
    return {
        "safety_violation_flag": scores.safety_violation_flag(),
        "fatigue_status": labels.ladder("fatigue_status"),
        "worker_risk_level": scores.worker_risk_level(),
        "alert_level": scores.alert_level(),
        "heart_rate_status": labels.ladder("heart_rate_status"),
    }


def machine_silver(valid: DataFrame) -> DataFrame:
    return valid.withColumns(machine_columns())


def worker_silver(valid: DataFrame) -> DataFrame:
    return valid.withColumns(worker_columns())
