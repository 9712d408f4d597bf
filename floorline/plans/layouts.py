"""Store layouts: the shape rows have in a relational table or a search index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorline.contracts import SEARCH_INDEXES, relational_columns
from floorline.operators.contract import require_columns


def _cast_type(sql_type: str) -> str:
    return "STRING" if sql_type.startswith("VARCHAR") else sql_type


def relational_layout(rows: DataFrame, table: str) -> DataFrame:
    """Columns, order and types of a relational table."""
    columns = relational_columns(table)
    return require_columns(rows, [name for name, _ in columns], table).select(
        *(F.col(name).cast(_cast_type(sql_type)).alias(name) for name, sql_type in columns)
    )


def text_column_types(table: str) -> str:
    """Lengths of the text columns, in the form JDBC writers take to create a table.

    Other columns are left to the database's dialect, which knows its own names
    for doubles and timestamps.
    """
    columns = relational_columns(table)
    return ", ".join(f"{name} {sql_type}" for name, sql_type in columns if sql_type.startswith("VARCHAR"))


def search_layout(rows: DataFrame, index: str) -> DataFrame:
    """Fields of a search index as indexed: readings are 32-bit floats."""
    chosen = require_columns(rows, SEARCH_INDEXES[index], index)
    return chosen.select(
        *(
            F.col(name).cast("float").alias(name) if dtype == "double" else F.col(name)
            for name, dtype in chosen.dtypes
        )
    )
