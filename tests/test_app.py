from __future__ import annotations

import json

import pytest
from conftest import machine, worker

from floorline import app
from floorline.sinks.bulk import read_bulk
from floorline.sinks.lake import read_lake
from floorline.streaming.closing import LATE, OUTPUTS
from floorline.streaming.workspace import stream_session


def write_lines(folder, *documents):
    folder.mkdir(parents=True)
    (folder / "0.json").write_text("\n".join(json.dumps(d) for d in documents))


@pytest.fixture
def wire(tmp_path):
    write_lines(tmp_path / "wire" / "sensor-events", machine(), machine(rpm=-1))
    write_lines(tmp_path / "wire" / "worker-events", worker(), worker(), worker(heart_rate=None))
    return tmp_path


def test_both_domains_into_the_lake(spark, wire):
    options = app.parse([
        "--files", f"{wire}/wire", "--lake", f"{wire}/lake/", "--checkpoint", f"{wire}/ck", "--once",
    ])
    queries = app.start(stream_session(spark, 2), options)
    for query in queries:
        query.awaitTermination()
    assert [q.name for q in queries] == ["machine_events", "machine_gold", "worker_events", "worker_gold"]
    counts = {
        (domain, layer): read_lake(spark, f"{wire}/lake", domain, layer).count()
        for domain in ("machine", "worker") for layer in ("bronze", "silver", "gold")
    }
    assert counts == {
        ("machine", "bronze"): 2, ("machine", "silver"): 1, ("machine", "gold"): 1,
        ("worker", "bronze"): 3, ("worker", "silver"): 2, ("worker", "gold"): 1,
    }


def test_single_datasets(spark, wire):
    options = app.parse([
        "--files", f"{wire}/wire", "--lake", f"{wire}/lake", "--checkpoint", f"{wire}/ck", "--once",
        "--only", "worker_gold_lake", "machine_bronze_lake",
    ])
    queries = app.start(stream_session(spark, 2), options)
    for query in queries:
        query.awaitTermination()
    assert sorted(q.name for q in queries) == ["machine_bronze_lake", "worker_gold_lake"]
    assert read_lake(spark, f"{wire}/lake", "worker", "gold").first().avg_fatigue_score == 20


def test_closed_windows_and_bulk_files(spark, wire):
    options = app.parse([
        "--files", f"{wire}/wire", "--lake", f"{wire}/lake", "--bulk", f"{wire}/bulk", "--checkpoint", f"{wire}/ck", "--once",
        "--domains", "worker", "--closed-windows",
    ])
    queries = app.start(stream_session(spark, 2), options)
    for query in queries:
        query.awaitTermination()
    assert [q.name for q in queries] == ["worker_events", "worker_gold", "worker_closing"]
    assert read_bulk(spark, f"{wire}/bulk", "worker-events").count() == 2 and read_bulk(spark, f"{wire}/bulk", "worker-safety").count() == 1
    late = read_lake(spark, f"{wire}/lake", "worker", "silver", target=OUTPUTS["worker"][LATE].target)
    assert late.count() == 0 and (wire / "ck" / "worker_closing").is_dir()


def test_sinks_follow_the_addresses(monkeypatch):
    monkeypatch.setenv("FLOORLINE_DB_USER", "me")
    monkeypatch.setenv("FLOORLINE_DB_PASSWORD", "secret")
    options = app.parse([
        "--servers", "a:1", "--checkpoint", "ck", "--database", "jdbc:x", "--search", "h:1", "--republish",
    ])
    stores = app.sinks(options)
    assert stores.keys() == {"relational", "search", "topic"}
    assert stores["relational"].password == "secret" and stores["search"].port == 1
    assert stores["topic"].servers == "a:1"


@pytest.mark.parametrize(
    ("arguments", "expected"),
    [([], None), (["--once"], {"availableNow": True}), (["--trigger", "2 seconds"], {"processingTime": "2 seconds"})],
)
def test_triggers(arguments, expected):
    assert app.trigger(app.parse(["--servers", "a:1", "--checkpoint", "ck", "--lake", "l", *arguments])) == expected


def test_source_options_bound_the_batches(spark, wire):
    (wire / "wire" / "worker-events" / "1.json").write_text(json.dumps(worker()))
    options = app.parse([
        "--files", f"{wire}/wire", "--lake", f"{wire}/lake", "--checkpoint", f"{wire}/ck", "--once",
        "--only", "worker_bronze_lake", "--source-option", "maxFilesPerTrigger=1",
    ])
    [query] = app.start(stream_session(spark, 2), options)
    query.awaitTermination()
    stored = read_lake(spark, f"{wire}/lake", "worker", "bronze", revisions=True)
    assert sorted(row["count"] for row in stored.groupBy("batch_id").count().collect()) == [1, 3]


@pytest.mark.parametrize("arguments", [
    ["--lake", "l"], ["--servers", "a:1", "--files", "f", "--lake", "l"],
    ["--files", "f", "--lake", "l", "--republish"], ["--files", "f"],
    ["--files", "f", "--lake", "l", "--domains", "worker", "--only", "machine_gold_lake"],
    ["--files", "f", "--lake", "l", "--only", "machine_gold_relational"], ["--files", "f", "--search", "h", "--bulk", "b"],
    ["--files", "f", "--bulk", "b", "--closed-windows"],
    ["--files", "f", "--database", "jdbc:x"],
])
def test_options_that_cannot_work_are_rejected(monkeypatch, arguments):
    """No source or two, no broker, no store, a dataset of another domain or without its store, no login."""
    monkeypatch.delenv("FLOORLINE_DB_USER", raising=False)
    with pytest.raises(SystemExit):
        app.parse(["--checkpoint", "ck", *arguments])


def test_sources_have_a_rate_by_default(spark, wire, monkeypatch):
    asked = {}
    monkeypatch.setattr(app, "read_topic", lambda session, servers, topic, **options: asked.setdefault(topic, options))
    monkeypatch.setattr(app, "read_stream", lambda session, fmt, options, path: asked.setdefault(fmt, options))
    base = ["--checkpoint", "ck", "--lake", "l"]
    app.source(spark, app.parse([*base, "--servers", "a:1"]), "machine")
    app.source(spark, app.parse([*base, "--servers", "a:1", "--source-option", "maxOffsetsPerTrigger=5"]), "worker")
    app.source(spark, app.parse([*base, "--files", "f"]), "machine")
    assert asked["sensor-events"] == {"maxOffsetsPerTrigger": "1000000"} and asked["worker-events"] == {"maxOffsetsPerTrigger": "5"}
    assert asked["text"] == {"maxFilesPerTrigger": "1000"}
