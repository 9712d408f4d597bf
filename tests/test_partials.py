"""Gold from mergeable parts."""

from __future__ import annotations

import pytest
from conftest import SMALL, machine, worker
from pyspark.sql import functions as F

from checks.queries import layer_of
from floorline.operators.partials import gold_from_parts, gold_parts, merge_parts, part_columns
from floorline.plans.layers import build_layer


def rounded(rows):
    return rows.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in rows.dtypes))


@pytest.mark.parametrize("domain", ["machine", "worker"])
def test_merged_parts_give_gold(spark, domain):
    silver, gold = layer_of(spark, SMALL, domain, "silver"), layer_of(spark, SMALL, domain, "gold")
    halves = [gold_parts(silver.where(F.pmod(F.xxhash64(*silver.columns), F.lit(3)) == k), domain) for k in range(3)]
    merged = gold_from_parts(merge_parts(halves[0].unionByName(halves[1]).unionByName(halves[2]), domain), domain)
    assert merged.dtypes == gold.dtypes and merged.count() == gold.count()
    assert rounded(merged).exceptAll(rounded(gold)).isEmpty()


def test_a_late_day_is_added_without_the_others(spark, raw):
    first = gold_parts(build_layer(raw(machine(temperature=60.0), machine(temperature=80.0)), "machine", "silver"), "machine")
    late = gold_parts(build_layer(raw(machine(temperature=100.0, is_fault=True)), "machine", "silver"), "machine")
    row = gold_from_parts(merge_parts(first.unionByName(late), "machine"), "machine").first()
    assert (row.avg_temp, row.max_temp, row.fault_count, row.total_events) == (80.0, 100.0, 1, 3)
    assert row.fault_percentage == pytest.approx(100 / 3)


def test_longer_windows_are_made_of_shorter_ones(spark, raw):
    silver = build_layer(raw(*(machine(timestamp=f"2024-01-01T00:{m:02}:10Z", temperature=float(m)) for m in range(60))), "machine", "silver")
    hours = merge_parts(gold_parts(silver, "machine"), "machine", "1 hour").collect()
    assert len(hours) == 1 and hours[0].temperature_n == 60 and hours[0].temperature_sum == sum(range(60))
    assert (hours[0].window_end - hours[0].window_start).seconds == 3600 and (hours[0].temperature_min, hours[0].temperature_max) == (0, 59)


def test_numbers_without_values_are_null(spark, raw):
    parts = gold_parts(build_layer(raw(worker(fatigue_score=None)), "worker", "silver"), "worker")
    assert set(part_columns("worker")) <= set(parts.columns) and parts.first().fatigue_score_n == 0
    assert gold_from_parts(merge_parts(parts, "worker"), "worker").first().avg_fatigue_score is None
    assert gold_from_parts(merge_parts(parts.limit(0), "worker"), "worker").count() == 0
