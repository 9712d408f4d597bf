"""Exact and approximate medians per group.

Spark's built-in ``median`` keeps every distinct value of a group in the memory
of one task.  ``exact_median`` selects by rank instead, in even shares of the data:

1. count rows per (group, value) - combined before the shuffle, and spread over
   all tasks even if one group holds most of the rows;
2. deal these counts into ranges of (group, value) of equal size, however close
   together or far apart the values lie, and sum up each range: as a range holds a
   segment of a group, running sums over a group's segments are ranks, and they
   show the one or two segments that hold the middle ranks;
3. walk the distinct values of these segments alone, in a sort that can spill.

A segment is passed on as its rank and its lowest and highest value, and these are
compared with the counts: what a range is may differ from one run to the next, so
no number of a range is relied on.  ``approx_median`` needs a single shuffle of
fixed-size sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Parts of a group that meet its middle segments in different tasks.
SPREAD = 32
RANGES = "spark.sql.shuffle.partitions"


def _covering_middle(rows: DataFrame) -> DataFrame:
    """Rows whose rank range ``(before, through]`` holds a middle rank; a group without values keeps its row."""
    return rows.where(((F.col("before") < F.col("upper")) & (F.col("through") >= F.col("lower"))) | (F.col("total") == 0))


def value_counts(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """``by``, each distinct ``v`` and the number ``n`` of its rows, 0 for null."""
    return rows.select(*by, F.col(value).cast("double").alias("v")).groupBy(*by, "v").agg(F.count("v").alias("n"))


def rank_segments(counted: DataFrame, by: Sequence[str]) -> DataFrame:
    """Segments of each group: values from ``lowest`` to ``highest``, their ranks ``before`` to ``through``, the group's ``total``.

    There are about as many rows as groups and ranges together.
    """
    by = list(by)
    ranges = int(counted.sparkSession.conf.get(RANGES))
    # A number of ranges that is given is kept by adaptive execution, which sees few bytes here but needs them spread.
    dealt = counted.repartitionByRange(ranges, *by, "v").withColumn("part", F.spark_partition_id())
    sums = dealt.groupBy(*by, "part").agg(F.sum("n").alias("n"), F.min("v").alias("lowest"), F.max("v").alias("highest"))
    group = Window.partitionBy(*by)
    up_to_here = group.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    placed = sums.withColumns({"through": F.sum("n").over(up_to_here), "total": F.sum("n").over(group)})
    return placed.select(*by, "lowest", "highest", (F.col("through") - F.col("n")).alias("before"), "through", "total")


def exact_median(rows: DataFrame, by: Sequence[str], value: str, out: str = "median") -> DataFrame:
    """``by`` columns plus the median of ``value``; null for groups without a value.  NaN counts as the largest value."""
    by = list(by)
    counted = value_counts(rows, by, value)
    segments = rank_segments(counted, by).withColumns({"lower": F.expr("(total + 1) div 2"), "upper": F.expr("total div 2 + 1")})
    middle = _covering_middle(segments).select(
        *(F.col(name).alias(f"{name}__") for name in by), "lowest", "highest", "before", "lower", "upper", "total",
        F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("share"))
    # Null-safe keys, for null groups and because a filter for nulls below the shared counts would make Spark run them twice.
    same = F.pmod(F.hash("v"), F.lit(SPREAD)) == F.col("share")
    for name in by:
        same &= F.col(name).eqNullSafe(F.col(f"{name}__"))
    inside = counted.join(middle, same & (F.col("v").between(F.col("lowest"), F.col("highest")) | (F.col("total") == 0)))
    # If a group has two middle segments, the ranks of one follow those of the other, so both are one walk.
    group = Window.partitionBy(*by)
    walk = group.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    walked = inside.withColumn("through", F.min("before").over(group) + F.sum("n").over(walk)).withColumn(
        "before", F.col("through") - F.col("n"))
    return _covering_middle(walked).groupBy(*by).agg(((F.min("v") + F.max("v")) / 2).alias(out))


def approx_median(
    rows: DataFrame, by: Sequence[str], value: str, out: str = "median", accuracy: int = 10_000
) -> DataFrame:
    """``by`` columns plus a value whose rank is within ``1/accuracy`` of the middle."""
    middle = F.percentile_approx(F.col(value).cast("double"), 0.5, accuracy)
    return rows.groupBy(*by).agg(middle.alias(out))
