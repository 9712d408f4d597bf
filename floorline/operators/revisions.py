"""Reading an update-mode changelog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_revision(changelog: DataFrame, keys: Sequence[str], order: str = "revision") -> DataFrame:
    """The newest row per key.

    An update-mode stream stores a window again each time it changes.  The
    newest revision is picked by an aggregate, so the copies of one key are
    combined before the shuffle and never gathered.  ``order`` must rise over all
    that wrote the changelog; batch ids do so within one ``query_id`` only.
    """
    newest = F.max_by(F.struct(*changelog.columns), order).alias("newest")
    return changelog.groupBy(*keys).agg(newest).select("newest.*")
