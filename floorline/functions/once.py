"""Evaluating an expensive expression once."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expand_once(rows: DataFrame, struct: Column, keep: Iterable[str] = ()) -> DataFrame:
    """The fields of ``struct`` as columns beside those of ``keep``, with the struct computed once per row.

    The optimizer merges neighbouring projections and pushes filters down by
    copying the expressions they use, so an expensive expression used n times is
    computed n times.  It does not look through a generator, and a generator over
    a one-element array changes nothing else.
    """
    return rows.select(*keep, F.inline(F.array(struct)))
