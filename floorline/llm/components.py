"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorline.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it is connected to, for every node of ``links`` (``a``, ``b``).

    Each round gives a node the smallest label among its neighbours and then the
    label of that label, so paths halve; rounds are written to the shared folder.
    Nodes without links have no row; an empty graph gives none.  Links may repeat
    and point either way; a null end is ignored.
    """
    links = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    ways = stored(links.select("a", "b").union(links.select("b", "a")).toDF("node", "other").distinct(), "links")
    labels = stored(ways.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")), "labels")
    while True:
        seen = ways.join(labels.select(F.col("node").alias("other"), F.col("label").alias("near")), "other")
        least = seen.groupBy("node").agg(F.min("near").alias("near"))
        lower = labels.join(least, "node").select("node", F.least("label", "near").alias("next"), "label")
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        after = stored(
            lower.join(jump, "next", "left").select("node", F.least("next", "far").alias("next"), "label"), "labels")
        if after.filter("next <> label").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", F.col("next").alias("label"))
