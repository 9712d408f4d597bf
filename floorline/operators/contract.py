"""Column contracts of the layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


class ContractError(ValueError):
    """A DataFrame lacks columns its target needs."""


def require_columns(rows: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """``rows`` reduced to ``columns`` in that order, or an error naming what is missing."""
    missing = [name for name in columns if name not in rows.columns]
    if missing:
        raise ContractError(f"{target}: missing columns {', '.join(missing)}")
    return rows.select(*columns)
