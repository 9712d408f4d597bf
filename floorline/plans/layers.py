"""The four layers of each domain, from raw payloads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from floorline.operators import decode, enrich, gold, quality

BRONZE = {"machine": decode.machine_bronze, "worker": decode.worker_bronze}
SILVER = {"machine": enrich.machine_silver, "worker": enrich.worker_silver}
GOLD = {"machine": gold.machine_gold, "worker": gold.worker_gold}

# Bronze columns that the rules and the aggregates of gold read.
GOLD_INPUTS = {
    "machine": ("timestamp", "machine_id", "status", "is_fault", "temperature", "vibration", "rpm", "power_kw"),
    "worker": ("timestamp", "worker_id", "helmet_on", "safety_vest_on", "heart_rate", "movement_status",
               "danger_zone", "fatigue_score"),
}


def bronze_layer(raw: DataFrame, domain: str, columns: Iterable[str] | None = None) -> DataFrame:
    return BRONZE[domain](raw, columns)


def quarantine_layer(bronze: DataFrame, domain: str) -> DataFrame:
    return quality.quarantine(bronze, quality.RULES[domain])


def unrouted_rows(bronze: DataFrame, domain: str) -> DataFrame:
    return quality.unrouted(bronze, quality.RULES[domain])


def silver_layer(bronze: DataFrame, domain: str) -> DataFrame:
    return SILVER[domain](quality.valid(bronze, quality.RULES[domain]))


def gold_layer(silver: DataFrame, domain: str, watermark: str | None = None) -> DataFrame:
    return GOLD[domain](silver, watermark)


def stateless_layers(bronze: DataFrame, domain: str) -> dict[str, DataFrame]:
    """The layers that need no state, all derived from one bronze DataFrame."""
    return {
        "bronze": bronze,
        "quarantine": quarantine_layer(bronze, domain),
        "silver": silver_layer(bronze, domain),
    }


def build_layer(raw: DataFrame, domain: str, layer: str, watermark: str | None = None,
                columns: Iterable[str] | None = None) -> DataFrame:
    """One layer straight from raw payloads; of a layer of events, with ``columns``, only these bronze columns and the rules' are parsed."""
    if layer == "gold":
        bronze = bronze_layer(raw, domain, GOLD_INPUTS[domain])
        return gold_layer(silver_layer(bronze, domain), domain, watermark)
    needed = None if columns is None else {*GOLD_INPUTS[domain], *columns}
    return stateless_layers(bronze_layer(raw, domain, needed), domain)[layer]
