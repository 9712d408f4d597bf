"""Identity of a micro-batch."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame


class Batch(NamedTuple):
    """A batch id is only unique within its query: a new checkpoint starts at 0."""

    query_id: str
    batch_id: int


def current_batch(rows: DataFrame, batch_id: int) -> Batch:
    """The batch a ``foreachBatch`` function is called for."""
    query_id = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query_id:
        # Two queries under one made-up name would overwrite each other's output.
        raise ValueError("a batch is only known inside foreachBatch: the query id is missing")
    return Batch(query_id, batch_id)
