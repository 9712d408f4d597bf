"""Search indexes (append, at least once).

Readings are sent as they are; the index mapping stores them as 32-bit floats,
see ``plans.layouts.search_layout`` for the values a search sees.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from floorline.contracts import SEARCH_INDEXES
from floorline.operators.contract import require_columns
from floorline.sinks.batch import Batch
from floorline.streaming.datasets import Dataset

FORMAT = "org.elasticsearch.spark.sql"


@dataclass(frozen=True)
class SearchSink:
    nodes: str
    port: int = 9200
    extra: Mapping[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {
            "es.nodes": self.nodes,
            "es.port": str(self.port),
            "es.index.auto.create": "true",
            **self.extra,
        }

    def write(self, rows: DataFrame, dataset: Dataset, batch: Batch) -> None:
        chosen = require_columns(rows, SEARCH_INDEXES[dataset.target], dataset.name)
        chosen.write.format(FORMAT).options(**self.options()).mode("append").save(dataset.target)
