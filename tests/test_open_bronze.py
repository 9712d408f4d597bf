"""Payloads kept whole beside the typed columns."""

from __future__ import annotations

import json

import pyarrow.parquet as pq
import pytest
from conftest import machine, worker

from floorline.contracts import LAYERS
from floorline.plans.layers import build_layer
from floorline.sinks.batch import Batch
from floorline.sinks.lake import LakeSink
from floorline.sources.raw import read_stream
from floorline.streaming.open_bronze import PAYLOAD, UNREAD, field_at, open_bronze, read_open, start_open_bronze, unknown_fields, write_open
from floorline.streaming.workspace import stream_session

NEW = {**machine(event_id="a"), "firmware": "1.2", "metrics": {**machine()["metrics"], "noise": 3.5}}
ODD = [{**machine(event_id="c"), "firmware": 7, "tags": ["x", "y"]}, "not json", "[1, 2]", '"text"', "", "{broken"]


def test_unknown_fields_survive_the_lake(spark, raw, tmp_path):
    rows = raw(NEW, machine(event_id="b"), *ODD).union(spark.createDataFrame([(None,)], "value BINARY"))
    write_open(open_bronze(rows, "machine"), "machine", LakeSink(str(tmp_path)), Batch("q", 0))
    stored = read_open(spark, str(tmp_path), "machine")
    assert unknown_fields(stored, "machine") == {"firmware": "variant", "metrics.noise": "double", "tags": "array<string>"}
    found = {r.event_id: r for r in stored.where("event_id IS NOT NULL").select(
        "event_id", field_at("metrics.noise", "double").alias("noise"), field_at("firmware", "string").alias("firmware"),
        field_at("tags", "array<string>").alias("tags"), field_at("firmware", "date").alias("wrong")).collect()}
    assert {k: (r.noise, r.firmware, r.tags, r.wrong) for k, r in found.items()} == {
        "a": (3.5, "1.2", None, None), "b": (None, None, None, None), "c": (None, "7", ["x", "y"], None)}
    assert sorted(str(r.unread) for r in stored.where("payload IS NULL").collect()) == sorted(
        str(x) for x in ["not json", "[1, 2]", '"text"', "", "{broken", None])
    # The typed columns are bronze's.
    bronze = build_layer(rows, "machine", "bronze")
    assert stored.drop(PAYLOAD, UNREAD).exceptAll(bronze).isEmpty() and bronze.exceptAll(stored.drop(PAYLOAD, UNREAD)).isEmpty()
    assert stored.columns == [*LAYERS["machine", "bronze"], PAYLOAD, UNREAD]


def test_shared_fields_have_columns_in_the_files(spark, raw, tmp_path):
    write_open(open_bronze(raw(*(machine(event_id=str(k)) for k in range(200))), "machine"), "machine", LakeSink(str(tmp_path)), Batch("q", 0))
    files = [f for f in tmp_path.rglob("*.parquet") if "event_date=" in str(f)]
    assert all("typed_value" in str(pq.read_schema(f).field(PAYLOAD).type) for f in files) and files


@pytest.mark.parametrize("documents", [[], ["x"], [worker()]])
def test_nothing_unknown(spark, raw, tmp_path, documents):
    rows = raw(*documents) if documents else raw(worker()).limit(0)
    write_open(open_bronze(rows, "worker"), "worker", LakeSink(str(tmp_path)), Batch("q", 0))
    assert unknown_fields(read_open(spark, str(tmp_path), "worker"), "worker") == {}


def test_a_stream_keeps_payloads(spark, tmp_path):
    session, wire = stream_session(spark, 2), tmp_path / "wire"
    wire.mkdir()
    for k, document in enumerate((NEW, machine(event_id="b"))):
        (wire / f"{k}.json").write_text(json.dumps(document))
        start_open_bronze(read_stream(session, "text", path=str(wire)), "machine", LakeSink(str(tmp_path / "lake")), str(tmp_path / "ck"),
                          {"availableNow": True}).awaitTermination()
    stored = read_open(spark, str(tmp_path / "lake"), "machine")
    assert sorted(r.event_id for r in stored.collect()) == ["a", "b"] and "firmware" in unknown_fields(stored, "machine")
