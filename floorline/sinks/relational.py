"""Relational tables through JDBC (append, at least once)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from floorline.plans.layouts import relational_layout, text_column_types
from floorline.sinks.batch import Batch
from floorline.streaming.datasets import Dataset


@dataclass(frozen=True)
class RelationalSink:
    """``connections`` bounds how many tasks write to the database at a time."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    connections: int = 16
    extra: Mapping[str, str] = field(default_factory=dict)
    # The writer merges partitions down to its connections; what feeds it must not be computed in them.
    few_tasks = True

    def connection(self, table: str) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": table,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
        }

    def options(self, table: str) -> dict[str, str]:
        return {
            **self.connection(table),
            "numPartitions": str(self.connections),
            "createTableColumnTypes": text_column_types(table),
            **self.extra,
        }

    def write(self, rows: DataFrame, dataset: Dataset, batch: Batch) -> None:
        laid_out = relational_layout(rows, dataset.target)
        laid_out.write.format("jdbc").options(**self.options(dataset.target)).mode("append").save()

    def read_options(self, table: str, since: str, until: str) -> dict[str, str]:
        """Read in ``connections`` slices of time; rows outside the span are read too."""
        ts = "window_start" if table.endswith("_gold") else "timestamp"
        return {
            **self.connection(table),
            "numPartitions": str(self.connections),
            "partitionColumn": ts,
            "lowerBound": since,
            "upperBound": until,
        }

    def read(self, spark: SparkSession, table: str, since: str, until: str) -> DataFrame:
        """A stored table; ``since`` and ``until`` only place the slices."""
        return spark.read.format("jdbc").options(**self.read_options(table, since, until)).load()
