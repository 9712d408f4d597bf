"""Message topics: rows as JSON documents without a key."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from floorline.functions.text import to_json_value
from floorline.operators.contract import require_columns
from floorline.sinks.batch import Batch
from floorline.streaming.datasets import Dataset


@dataclass(frozen=True)
class TopicSink:
    servers: str
    extra: Mapping[str, str] = field(default_factory=dict)

    def options(self, topic: str) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, "topic": topic, **self.extra}

    def documents(self, rows: DataFrame, dataset: Dataset) -> DataFrame:
        return to_json_value(require_columns(rows, dataset.columns, dataset.name))

    def write(self, rows: DataFrame, dataset: Dataset, batch: Batch) -> None:
        self.documents(rows, dataset).write.format("kafka").options(**self.options(dataset.target)).save()
