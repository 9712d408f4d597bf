"""Median series from stored, mergeable sketches."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from floorline.operators.sketches import merge_sketches, rank_error, reading_sketches, sketched_series


@pytest.fixture
def rows(spark):
    """Three days of readings of four units, skewed, with ties, nulls and NaN."""
    return spark.range(60_000).select(
        F.timestamp_seconds(1_704_067_200 + F.col("id") * 4).alias("ts"), (F.col("id") % 4).alias("unit"),
        F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 51 == 0, F.lit(float("nan"))).otherwise(
            F.pow(F.pmod(F.xxhash64("id"), F.lit(1000)) / 100.0, F.lit(3)).cast("double")).alias("v"))


def test_sketches_merge_over_units_and_hours(rows):
    hourly = reading_sketches(rows, "ts", "v", "1 hour", ["unit"])
    daily = sketched_series(hourly, "1 day")
    errors = rank_error(daily, rows, "ts", "v", "1 day").collect()
    assert len(errors) == 3 and all(r.error <= 0.0266 for r in errors)
    good = rows.where("v IS NOT NULL AND NOT isnan(v)").count()
    assert sum(r.readings for r in errors) == good == merge_sketches(hourly, "1 day").agg(F.sum("readings")).first()[0]
    assert merge_sketches(hourly, "1 day", ["unit"]).count() == 12
    # However many readings, a sketch stays small.
    assert merge_sketches(hourly, "10 days").select(F.max(F.length("sketch"))).first()[0] < 10_000


def test_small_buckets_are_exact_and_gaps_stay(spark):
    rows = spark.createDataFrame([(datetime(2024, 1, 1, h, 5), v) for h, v in [(0, 1.0), (0, 5.0), (0, 9.0), (3, 2.0), (3, None)]], "ts TIMESTAMP, v DOUBLE")
    hourly = reading_sketches(rows, "ts", "v", "1 hour")
    assert [r.median for r in sketched_series(hourly, "1 hour").orderBy("bucket").collect()] == [5.0, None, None, 2.0]
    assert [r.median for r in sketched_series(hourly, "1 hour", fill_empty=False).orderBy("bucket").collect()] == [5.0, 2.0]
    assert all(r.error == 0 for r in rank_error(sketched_series(hourly, "1 hour"), rows, "ts", "v", "1 hour").collect())


def test_automatic_interval_and_no_rows(rows):
    found = sketched_series(reading_sketches(rows, "ts", "v", "10 minutes")).collect()
    assert len(found) == 67 and all(r.bucket.minute == 0 for r in found)
    assert sketched_series(reading_sketches(rows.limit(0), "ts", "v", "1 hour")).count() == 0
