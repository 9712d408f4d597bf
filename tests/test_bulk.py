"""Search documents as bulk files."""

from __future__ import annotations

import json

import pytest
from conftest import machine, worker

from floorline.contracts import SEARCH_INDEXES
from floorline.plans.layers import build_layer
from floorline.sinks.batch import Batch
from floorline.sinks.bulk import BulkSink, BulkWriter, Written, loaded, read_bulk
from floorline.streaming.datasets import dataset

EVENTS, WINDOWS = dataset("machine_silver_search"), dataset("worker_gold_search")


def silver(raw, *names):
    return build_layer(raw(*(machine(event_id=n, error_code='say "E1"\n{"index":') for n in names)), "machine", "silver")


def test_documents_come_back_and_a_repeated_batch_adds_nothing(spark, raw, tmp_path):
    sink = BulkSink(str(tmp_path))
    sink.write(silver(raw, "a", "b", "same", "same"), EVENTS, Batch("q", 0))
    sink.write(silver(raw, "c"), EVENTS, Batch("q", 1))
    first = sorted(tuple(r) for r in read_bulk(spark, str(tmp_path), "machine-events").collect())
    sink.write(silver(raw, "same", "b", "a", "same").repartition(5), EVENTS, Batch("q", 0))
    again = sorted(tuple(r) for r in read_bulk(spark, str(tmp_path), "machine-events").collect())
    assert again == first and len({i for _, i, _ in first}) == 5
    found = [json.loads(d) for _, _, d in first]
    assert sorted(d["event_id"] for d in found) == ["a", "b", "c", "same", "same"]
    assert found[0]["error_code"] == 'say "E1"\n{"index":' and set(found[0]) <= set(SEARCH_INDEXES["machine-events"])
    lines = [line for f in (tmp_path / "machine-events/data").glob("*.ndjson") for line in f.read_text().splitlines()]
    assert all(json.loads(a)["index"]["_index"] == "machine-events" and "event_id" in json.loads(b) for a, b in zip(lines[::2], lines[1::2]))


def test_a_window_is_replaced_by_its_newest(spark, raw, tmp_path):
    sink = BulkSink(str(tmp_path))
    for k, scores in enumerate([(10,), (10, 30)]):
        sink.write(build_layer(raw(*(worker(fatigue_score=s) for s in scores)), "worker", "gold"), WINDOWS, Batch("q", k))
    assert read_bulk(spark, str(tmp_path), "worker-safety").count() == 2
    assert [json.loads(r.document)["avg_fatigue_score"] for r in loaded(read_bulk(spark, str(tmp_path), "worker-safety")).collect()] == [20.0]


def test_uncommitted_files_are_not_read(spark, raw, tmp_path):
    sink = BulkSink(str(tmp_path))
    sink.write(silver(raw, "a"), EVENTS, Batch("q", 0))
    stray = tmp_path / "machine-events/data/stray.ndjson"
    stray.write_text('{"index":{"_index":"machine-events","_id":"x"}}\n{"event_id":"x"}\n')
    assert read_bulk(spark, str(tmp_path), "machine-events").count() == 1
    writer = BulkWriter({"path": f"{tmp_path}/machine-events", "index": "machine-events", "batch": "b"})
    writer.abort([None, Written("data/stray.ndjson", 1)])
    assert not stray.exists()


@pytest.mark.parametrize("rows", [0, 3])
def test_empty_batches_and_failures(spark, raw, tmp_path, rows):
    from pyspark.sql import functions as F

    sink = BulkSink(str(tmp_path))
    sink.write(silver(raw, "a").limit(0), EVENTS, Batch("q", 0))
    assert read_bulk(spark, str(tmp_path), "machine-events").count() == 0
    if rows:
        broken = silver(raw, "a", "b", "c").withColumn("floor", F.raise_error(F.lit("no floor")).cast("string"))
        with pytest.raises(Exception, match="no floor"):
            sink.write(broken, EVENTS, Batch("q", 1))
        assert read_bulk(spark, str(tmp_path), "machine-events").count() == 0
