from __future__ import annotations

import random
import statistics
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from floorline.operators.median import approx_median, exact_median, rank_segments, value_counts
from floorline.operators.series import SPINE_BLOCK, auto_interval, bucket_spine, median_series

START = datetime(2024, 1, 1)
readings = st.one_of(
    st.none(),
    st.floats(-1e6, 1e6, allow_nan=False).map(lambda x: x + 0.0),
    st.sampled_from([0.0, 1.0, -1.0, 1e-9, -1e-9, 90.0, 90.001]),
)


def expected_medians(rows):
    groups = {}
    for key, value in rows:
        groups.setdefault(key, []).append(value)
    return {
        key: statistics.median(kept) if (kept := [v for v in values if v is not None]) else None
        for key, values in groups.items()
    }


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), readings), min_size=1, max_size=60))
def test_exact_median_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k INT, v DOUBLE")
    found = {row.k: row.median for row in exact_median(df, ["k"], "v").collect()}
    expected = expected_medians(rows)
    assert found.keys() == expected.keys()
    for key, value in expected.items():
        assert found[key] == (None if value is None else pytest.approx(value, abs=1e-9))


def test_one_hot_group_with_one_hot_value(spark):
    generator = random.Random(7)
    rows = [(0, 70.0)] * 2000 + [(0, generator.gauss(70, 5)) for _ in range(2001)]
    rows += [(k, generator.gauss(70, 5)) for k in range(1, 40) for _ in range(5)]
    df = spark.createDataFrame(rows, "k INT, v DOUBLE")
    found = {row.k: row.median for row in exact_median(df, ["k"], "v").collect()}
    assert found == pytest.approx(expected_medians(rows))


def test_extremes_rank_like_the_builtin(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("nan", 1.0), ("nan", nan), ("nan", nan), ("inf", -inf), ("inf", 5.0), ("inf", inf),
            ("mixed", inf), ("mixed", nan), ("mixed", 2.0), ("tiny", 5e-324), ("tiny", -5e-324), ("tiny", 0.0)]
    df = spark.createDataFrame(rows, "k STRING, v DOUBLE")
    ours = {r.k: str(r.median) for r in exact_median(df, ["k"], "v").collect()}
    builtin = {r.k: str(r.m) for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert ours == builtin


def test_integers_and_several_keys(spark):
    df = spark.createDataFrame([("a", 1, 4), ("a", 1, 7), ("a", 2, 5), ("b", 1, 6)], "x STRING, y INT, v INT")
    found = {(r.x, r.y): r.median for r in exact_median(df, ["x", "y"], "v").collect()}
    assert found == {("a", 1): 5.5, ("a", 2): 5.0, ("b", 1): 6.0}


def test_counting_runs_once(spark):
    df = spark.range(1000).select((F.col("id") % 5).alias("k"), F.col("id").alias("v"))
    rows = exact_median(df, ["k"], "v")
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1
    assert plan.count("Range (") == 1


def executed(rows):
    rows.collect()
    return rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_values_close_together_are_shared_out(spark):
    """A million values within 0.01 % of each other, all in one group: no task walks more than its share."""
    n = 1_000_001
    df = spark.range(n).select(F.lit("k").alias("k"), (70 + F.col("id") * 7e-9).alias("v"))
    counted = value_counts(df, ["k"], "v")
    segments = rank_segments(counted, ["k"]).orderBy("before").collect()
    sizes = [s.through - s.before for s in segments]
    assert len(segments) == 8 and sum(sizes) == n and max(sizes) < n / 4
    assert all(a.highest < b.lowest and a.through == b.before for a, b in zip(segments, segments[1:]))
    assert exact_median(df, ["k"], "v").first().median == 70 + (n // 2) * 7e-9


def test_large_shuffles_are_two(spark):
    """The counts and their ranges are shuffled whole; the other exchanges carry segments and the values of one or two of them."""
    df = spark.range(20_000).select((F.col("id") % 3).alias("k"), (F.col("id") * 0.5).alias("v"))
    plan = executed(exact_median(df, ["k"], "v"))
    exchanges = [line for line in plan.splitlines() if "Exchange " in line and "Reused" not in line and "Broadcast" not in line]
    assert sum("rangepartitioning" in line for line in exchanges) == 1
    assert sum("hashpartitioning(k#" in line and ", v#" in line for line in exchanges) == 1
    assert len(exchanges) <= 5 and plan.count("SinglePartition") == 0


def test_null_groups_and_middles_in_two_segments(spark):
    rows = [(None, float(v)) for v in range(10)] + [("a", None), ("b", None), ("b", 3.0)] + [("c", float(v)) for v in range(1000)]
    found = {r.k: r.median for r in exact_median(spark.createDataFrame(rows, "k STRING, v DOUBLE"), ["k"], "v").collect()}
    assert found == {None: 4.5, "a": None, "b": 3.0, "c": 499.5}
    for n in range(2, 40):
        assert exact_median(spark.range(n).withColumn("k", F.lit(0)), ["k"], "id").first().median == (n - 1) / 2


def test_approximate_median_is_close(spark):
    df = spark.range(10_001).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    assert approx_median(df, ["k"], "v").first().median == pytest.approx(5000, abs=2)


@pytest.fixture
def gappy(spark):
    minutes = [(0, 1.0), (10, 3.0), (70, None), (200, 5.0), (201, 6.0)]
    return spark.createDataFrame([(START + timedelta(minutes=m), v) for m, v in minutes], "ts TIMESTAMP, v DOUBLE")


@pytest.mark.parametrize("exact", [True, False])
def test_empty_buckets_are_kept(gappy, exact):
    rows = median_series(gappy, "ts", "v", "1 hour", exact=exact).orderBy("bucket").collect()
    assert [row.bucket.hour for row in rows] == [0, 1, 2, 3]
    assert [row.median_v for row in rows][1:3] == [None, None]
    if exact:
        assert [row.median_v for row in rows] == [2.0, None, None, 5.5]


def test_empty_buckets_can_be_left_out(gappy):
    rows = median_series(gappy, "ts", "v", "1 hour", fill_empty=False, out="m").orderBy("bucket").collect()
    assert [(row.bucket.hour, row.m) for row in rows] == [(0, 2.0), (1, None), (3, 5.5)]


def test_long_spine_is_complete(spark):
    ends = spark.createDataFrame([(START,), (START + timedelta(minutes=3 * SPINE_BLOCK),)], "ts TIMESTAMP")
    spine = bucket_spine(ends, "ts", "1 minute")
    found = spine.agg(F.count("*").alias("n"), F.countDistinct("bucket").alias("d"),
                      F.min("bucket").alias("a"), F.max("bucket").alias("b")).first()
    n = 3 * SPINE_BLOCK + 1
    assert tuple(found) == (n, n, START, START + timedelta(minutes=n - 1))


def test_spine_of_nothing_is_empty(spark):
    nothing = spark.createDataFrame([], "ts TIMESTAMP, v DOUBLE")
    assert median_series(nothing, "ts", "v").count() == 0


@pytest.mark.parametrize(
    ("span", "interval"),
    [
        (timedelta(0), "1 second"),
        (timedelta(seconds=99), "1 second"),
        (timedelta(seconds=100), "5 seconds"),
        (timedelta(hours=9), "10 minutes"),
        (timedelta(days=5), "3 hours"),
        (timedelta(days=99), "1 day"),
        (timedelta(days=36_000), "365 days"),
        (timedelta(days=400_000), "5840 days"),
    ],
)
def test_automatic_interval(spark, span, interval):
    ends = spark.createDataFrame([(datetime(1700, 1, 1),), (datetime(1700, 1, 1) + span,)], "ts TIMESTAMP")
    assert auto_interval(ends, "ts") == interval


def test_automatic_interval_counts_aligned_buckets(spark):
    """A span off the minute boundary touches one bucket more than its length has minutes."""
    ends = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 30),), (datetime(2024, 1, 1, 1, 40, 29),)], "ts TIMESTAMP")
    assert auto_interval(ends, "ts") == "5 minutes"


def test_panel_range_bounds_the_series(spark):
    rows = spark.sql("SELECT * FROM VALUES (timestamp'0001-01-01', 1D), (timestamp'2024-01-01 05:30:00', 2D), "
                     "(timestamp'2024-01-01 07:10:00', 3D), (timestamp'9999-01-01', 4D) AS t(ts, v)")
    series = median_series(rows, "ts", "v", since="2024-01-01", until="2024-01-02").orderBy("bucket").collect()
    assert [(r.bucket.hour, r.median_v) for r in series] == [(5, 2.0), (6, None), (7, 3.0)]


def test_automatic_series(spark, gappy):
    rows = median_series(gappy, "ts", "v", "auto").collect()
    assert len(rows) == 41 and {row.bucket.minute % 5 for row in rows} == {0}
    nothing = spark.createDataFrame([], "ts TIMESTAMP, v DOUBLE")
    assert median_series(nothing, "ts", "v", "auto").count() == 0


def test_series_scans_its_rows_once(spark, tmp_path):
    ticks = spark.range(5000).select(F.timestamp_seconds(F.col("id") * 7).alias("ts"), (F.col("id") % 90).alias("v"))
    ticks.write.parquet(f"{tmp_path}/ticks")
    series = median_series(spark.read.parquet(f"{tmp_path}/ticks"), "ts", "v", "10 minutes")
    series.collect()
    plan = series._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1
