"""Regular time series for dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorline.operators.median import approx_median, exact_median

# The steps an automatic interval is chosen from.
STEPS = (
    "1 second", "5 seconds", "10 seconds", "30 seconds", "1 minute", "5 minutes", "10 minutes",
    "30 minutes", "1 hour", "3 hours", "12 hours", "1 day", "7 days", "30 days", "365 days",
)
MICROS = {"second": 10 ** 6, "minute": 60 * 10 ** 6, "hour": 3600 * 10 ** 6, "day": 86_400 * 10 ** 6}
AUTO = "auto"
MAX_BUCKETS = 100

# Buckets made by one row of the spine; keeps the arrays behind it small.
SPINE_BLOCK = 4096


def auto_interval(rows: DataFrame, ts: str, max_buckets: int = MAX_BUCKETS) -> str:
    """The shortest step that covers the rows' times in ``max_buckets`` aligned buckets; beyond the last step, it doubles.

    Runs a job that brings one row, the first and the last time, to the driver.
    """
    first, last = rows.agg(F.unix_micros(F.min(ts)), F.unix_micros(F.max(ts))).first()
    for step in (*STEPS, *(f"{365 * 2 ** k} days" for k in range(1, 40))):
        amount, unit = step.split()
        width = int(amount) * MICROS[unit.rstrip("s")]
        if first is None or last // width - first // width < max_buckets:
            return step
    raise ValueError("no step covers these times")


def bucket_spine(rows: DataFrame, ts: str, interval: str) -> DataFrame:
    """Every bucket from the first to the last event, with or without events.

    One row of bounds grows into blocks and each block into buckets, so a long
    span is spread over tasks instead of being built as a single array.
    """
    bounds = (
        rows.agg(F.min(ts).alias("earliest"), F.max(ts).alias("latest"))
        .select(F.window("earliest", interval).alias("w"), "latest")
        .select(
            F.unix_micros("w.start").alias("first"),
            (F.unix_micros("w.end") - F.unix_micros("w.start")).alias("step"),
            F.unix_micros("latest").alias("latest"),
        )
        .withColumn("gaps", F.expr("(latest - first) div step"))
    )
    blocks = bounds.select(
        "*", F.explode(F.expr(f"sequence(0L, gaps div {SPINE_BLOCK})")).alias("block")
    ).repartition("block")
    return blocks.select(
        "first",
        "step",
        F.explode(
            F.expr(f"sequence(block * {SPINE_BLOCK}, least(gaps, block * {SPINE_BLOCK} + {SPINE_BLOCK - 1}))")
        ).alias("i"),
    ).select(F.timestamp_micros(F.col("first") + F.col("i") * F.col("step")).alias("bucket"))


def median_series(
    rows: DataFrame,
    ts: str,
    reading: str,
    interval: str = "1 hour",
    *,
    exact: bool = True,
    fill_empty: bool = True,
    out: str | None = None,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """``bucket`` and the median of ``reading`` per bucket of ``interval``.

    ``interval`` is a fixed duration such as ``"15 minutes"``, or ``"auto"``.

    ``since`` and ``until`` (excluded) are the time range of the panel; without them
    the series runs from the first event to the last, so one event with a year far
    off makes it that long.  Partial buckets at both ends are kept.  With ``fill_empty`` a bucket without
    events is a row with a null median.
    """
    out = out or f"median_{reading}"
    if since:
        rows = rows.where(F.col(ts) >= F.to_timestamp(F.lit(since)))
    if until:
        rows = rows.where(F.col(ts) < F.to_timestamp(F.lit(until)))
    if interval == AUTO:
        interval = auto_interval(rows, ts)
    placed = rows.where(F.col(ts).isNotNull()).select(F.window(ts, interval)["start"].alias("bucket"), reading)
    medians = (exact_median if exact else approx_median)(placed, ["bucket"], reading, out)
    if not fill_empty:
        return medians
    # Bounds taken from the medians, whose shuffles are reused, not from the rows.
    # Null-safe, as a filter for nulls below the medians would keep their shuffles from being reused.
    found = medians.withColumnRenamed("bucket", "filled")
    return bucket_spine(medians, "bucket", interval).join(found, F.col("bucket").eqNullSafe(F.col("filled")), "left").drop("filled")
