"""The datasets the streams maintain."""

from __future__ import annotations

from typing import NamedTuple

from floorline.contracts import LAYERS


class Dataset(NamedTuple):
    """One layer kept in one store."""

    domain: str
    layer: str
    store: str  # lake | relational | topic | search
    target: str  # path below the lake root, table, topic or index
    trigger: str | None  # processing-time trigger, None: as soon as possible

    @property
    def name(self) -> str:
        return f"{self.domain}_{self.layer}_{self.store}"

    @property
    def columns(self) -> tuple[str, ...]:
        return LAYERS[self.domain, self.layer]

    @property
    def output_mode(self) -> str:
        return "update" if self.layer == "gold" else "append"


# Targets and triggers of the 19 datasets.
DATASETS = (
    Dataset("machine", "silver", "topic", "sensor-processed", None),
    Dataset("machine", "bronze", "lake", "bronze/machine_bronze_data", None),
    Dataset("machine", "silver", "lake", "silver/machine_silver_data", None),
    Dataset("machine", "gold", "lake", "gold/machine_gold_data", None),
    Dataset("machine", "quarantine", "relational", "machine_events_quarantine", None),
    Dataset("machine", "bronze", "relational", "machine_events_bronze", "2 seconds"),
    Dataset("machine", "silver", "relational", "machine_events_silver", "2 seconds"),
    Dataset("machine", "gold", "relational", "machine_aggregates_gold", "2 seconds"),
    Dataset("machine", "silver", "search", "machine-events", "2 seconds"),
    Dataset("machine", "gold", "search", "machine-aggregates", None),
    Dataset("worker", "quarantine", "relational", "worker_events_quarantine", None),
    Dataset("worker", "bronze", "relational", "worker_events_bronze", "2 seconds"),
    Dataset("worker", "silver", "relational", "worker_events_silver", "2 seconds"),
    Dataset("worker", "gold", "relational", "worker_safety_gold", None),
    Dataset("worker", "bronze", "lake", "bronze/worker_bronze_data", None),
    Dataset("worker", "silver", "lake", "silver/worker_silver_data", None),
    Dataset("worker", "gold", "lake", "gold/worker_gold_data", None),
    Dataset("worker", "silver", "search", "worker-events", "2 seconds"),
    Dataset("worker", "gold", "search", "worker-safety", None),
)


def dataset(name: str) -> Dataset:
    """The dataset called ``<domain>_<layer>_<store>``."""
    return next(d for d in DATASETS if d.name == name)


def lake_path(domain: str, layer: str) -> str:
    """Directory of a layer below the lake root, ``layer/table``."""
    return f"{layer}/{domain}_{layer}_data"
