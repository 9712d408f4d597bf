"""Rows as JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_json_value(rows: DataFrame) -> DataFrame:
    """One ``value`` column: each row as a JSON object.

    Null fields are left out and timestamps carry milliseconds, as Spark's
    ``to_json`` does by default.
    """
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
