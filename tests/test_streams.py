from __future__ import annotations

import json
from datetime import datetime

import pytest
from conftest import SMALL, machine, worker
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from checks.queries import layer_of, raw_of
from checks.event_log import PAYLOADS
from checks.streams import FILES_PER_BATCH, SLICES, run_slices, slices
from floorline.plans.layers import build_layer
from floorline.sinks.lake import LakeSink, read_lake
from floorline.sources.raw import read_stream
from floorline.streaming.datasets import DATASETS, dataset
from floorline.streaming.pipelines import await_any, cadence, start_dataset, start_domain
from floorline.streaming.workspace import shared_folder, stream_session

ONCE = {"availableNow": True}


@pytest.fixture
def session(spark):
    return stream_session(spark, state_partitions=2)


class Arrivals:
    """A folder of JSON lines that a text stream reads."""

    def __init__(self, folder):
        self.folder, self.files = folder, 0
        folder.mkdir()

    def add(self, *documents):
        lines = "\n".join(d if isinstance(d, str) else json.dumps(d) for d in documents)
        (self.folder / f"{self.files:04}.json").write_text(lines)
        self.files += 1

    def stream(self, session):
        return read_stream(session, "text", path=str(self.folder))


@pytest.fixture
def arrivals(tmp_path):
    return Arrivals(tmp_path / "wire")


class Recorder:
    """A sink that keeps the rows it is given, per batch."""

    def __init__(self):
        self.batches = {}

    def write(self, rows, target, batch):
        self.batches.setdefault(target.name, {})[batch.batch_id] = rows.collect()

    def rows(self, name):
        return [row for rows in self.batches.get(name, {}).values() for row in rows]


class Broken:
    def write(self, rows, target, batch):
        raise RuntimeError("store is down")


def run(queries):
    for query in queries if isinstance(queries, list) else [queries]:
        query.awaitTermination()


@pytest.mark.parametrize("domain", ["machine", "worker"])
def test_stream_equals_batch(spark, domain):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    root = run_slices(spark, events, domain, {"bronze", "silver", "gold"})
    for layer in ("bronze", "silver"):
        stored, batch = read_lake(spark, root, domain, layer), layer_of(spark, SMALL, domain, layer)
        assert stored.exceptAll(batch).isEmpty() and batch.exceptAll(stored).isEmpty()
    changelog = read_lake(spark, root, domain, "gold", revisions=True)
    newest = read_lake(spark, root, domain, "gold")
    assert changelog.count() >= newest.count()

    def rounded(rows):
        return rows.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in rows.dtypes))

    batch = layer_of(spark, SMALL, domain, "gold")
    assert newest.count() == batch.count()
    assert rounded(newest).exceptAll(rounded(batch)).isEmpty()


def test_slices_cover_every_event_once(spark):
    """Ids of any size, and rows without one."""
    for first in (5, 10 ** 12):
        events = spark.range(first, first + 100).withColumnRenamed("id", "event_id")
        events = events.union(spark.sql("SELECT CAST(NULL AS BIGINT) AS event_id"))
        parts = [[r.event_id for r in part.collect()] for part in slices(events)]
        assert len(parts) == SLICES and [None] == [i for part in parts for i in part if i is None] and None in parts[0]
        found = [i for part in parts for i in sorted(x for x in part if x is not None)]
        assert found == list(range(first, first + 100))
    assert [part.count() for part in slices(events.limit(0))] == [0]


def test_an_arrival_is_a_micro_batch(spark):
    """Gold streams take several bounded batches in a start."""
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    root = run_slices(spark, events, "worker", {"gold"})
    assert read_lake(spark, root, "worker", "gold", revisions=True).select("batch_id").distinct().count() >= SLICES
    wire = spark.read.parquet(root.replace("/lake", "/wire"))
    assert len(wire.inputFiles()) == SLICES * FILES_PER_BATCH and wire.count() == events.count()


def test_large_ids_have_payloads(spark):
    rows = spark.sql("""SELECT 999999999999L + id AS event_id, timestamp'2024-05-01 10:00:00' AS ts, id AS user_id, 'view' AS event_type,
                        1.5D AS value, '{"k": 20}' AS props FROM range(50)""")
    for domain in PAYLOADS:
        assert build_layer(PAYLOADS[domain](rows), domain, "silver").count() == 50


def test_late_events(session, arrivals, tmp_path):
    """Windows stay open for a minute past the newest event of earlier runs."""
    recorder = Recorder()

    def feed(*times):
        arrivals.add(*(machine(timestamp=f"2024-01-01T{t}Z", rpm=rpm) for t, rpm in times))
        before = len(recorder.batches.get("machine_gold_lake", {}))
        run(start_domain(arrivals.stream(session), "machine", {"lake": recorder}, str(tmp_path / "ck"), ONCE,
                         [dataset("machine_gold_lake")]))
        newest = list(recorder.batches["machine_gold_lake"].values())[before:]
        return sorted(
            (row.window_start.minute, row.total_events, row.avg_rpm * row.total_events)
            for rows in newest for row in rows
        )

    assert feed(("00:00:10", 1), ("00:00:59", 2)) == [(0, 2, 3)]
    assert feed(("00:00:20", 4), ("00:05:00", 1)) == [(0, 3, 7), (5, 1, 1)]
    assert feed(("00:00:30", 8), ("00:05:01", 1)) == [(5, 2, 2)]


def test_restart_continues_where_it_stopped(session, arrivals, tmp_path):
    recorder = Recorder()

    def again():
        run(start_domain(arrivals.stream(session), "worker", {"lake": recorder}, str(tmp_path / "ck"), ONCE))

    arrivals.add(worker(worker_id="a"))
    again()
    arrivals.add(worker(worker_id="b"))
    again()
    again()
    assert [row.worker_id for row in recorder.rows("worker_bronze_lake")] == ["a", "b"]
    assert {row.worker_id for row in recorder.rows("worker_gold_lake")} == {"a", "b"}


def test_one_pass_feeds_every_store(session, arrivals, tmp_path):
    stores = {"lake": Recorder(), "relational": Recorder(), "search": Recorder(), "topic": Recorder()}
    arrivals.add(machine(event_id="good"), machine(event_id="bad", rpm=-1), machine(event_id="lost", rpm=None),
                 "not json")
    queries = start_domain(arrivals.stream(session), "machine", stores, str(tmp_path / "ck"), ONCE)
    run(queries)
    assert [q.name for q in queries] == ["machine_events", "machine_gold"]
    written = {name for store in stores.values() for name in store.batches}
    assert written == {d.name for d in DATASETS if d.domain == "machine"}
    bronze = stores["lake"].rows("machine_bronze_lake")
    assert len(bronze) == 4 and bronze == stores["relational"].rows("machine_bronze_relational")
    assert [r.event_id for r in stores["topic"].rows("machine_silver_topic")] == ["good"]
    reasons = {r.event_id: r.validation_reason for r in stores["relational"].rows("machine_quarantine_relational")}
    assert reasons == {"bad": "INVALID_RPM", None: "NULL_TIMESTAMP"}
    assert [r.total_events for r in stores["search"].rows("machine_gold_search")] == [1]
    assert not session.catalog.listTables()


def test_a_failing_sink_ends_the_query_and_the_batch_is_replayed(session, arrivals, tmp_path):
    lake = LakeSink(str(tmp_path / "lake"))
    bronze = [dataset("worker_bronze_lake"), dataset("worker_bronze_relational")]
    arrivals.add(worker(worker_id="a"))

    def start(relational):
        return start_domain(arrivals.stream(session), "worker", {"lake": lake, "relational": relational},
                            str(tmp_path / "ck"), ONCE, bronze)

    with pytest.raises(StreamingQueryException, match="store is down"):
        run(start(Broken()))
    recorder = Recorder()
    run(start(recorder))
    assert len(recorder.rows("worker_bronze_relational")) == 1
    assert read_lake(session, str(tmp_path / "lake"), "worker", "bronze").count() == 1


def test_waiting_reports_a_failed_query(session, arrivals, tmp_path):
    arrivals.add(worker())
    session.streams.resetTerminated()
    start_dataset(arrivals.stream(session), dataset("worker_bronze_lake"), Broken(), str(tmp_path / "ck"), ONCE)
    with pytest.raises(StreamingQueryException, match="store is down"):
        await_any(session, 60)
    session.streams.resetTerminated()


@pytest.mark.parametrize("name", ["worker_silver_lake", "worker_gold_lake", "worker_quarantine_relational"])
def test_each_dataset_can_run_alone(session, arrivals, tmp_path, name):
    recorder = Recorder()
    arrivals.add(worker(), worker(heart_rate=-1))
    query = start_dataset(arrivals.stream(session), dataset(name), recorder, str(tmp_path / "ck"), ONCE)
    run(query)
    assert query.name == name and len(recorder.rows(name)) == 1
    assert tuple(recorder.rows(name)[0].asDict()) == dataset(name).columns


def test_processing_time_trigger_is_the_datasets_own(session, arrivals, tmp_path):
    recorder = Recorder()
    arrivals.add(worker())
    query = start_dataset(arrivals.stream(session), dataset("worker_bronze_relational"), recorder, str(tmp_path / "ck"))
    try:
        query.processAllAvailable()
        assert len(recorder.rows("worker_bronze_relational")) == 1
        assert query.isActive
    finally:
        query.stop()


def test_append_mode_waits_for_the_watermark(session, arrivals, tmp_path):
    from floorline.plans.layers import build_layer

    def closed_windows():
        rows = build_layer(arrivals.stream(session), "machine", "gold", watermark="1 minute")
        out = {}
        query = (
            rows.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "ck"))
            .foreachBatch(lambda df, i: out.update({i: df.collect()})).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return [(r.window_start, r.total_events) for rows in out.values() for r in rows]

    arrivals.add(machine(timestamp="2024-01-01T00:00:10Z"))
    assert closed_windows() == []
    arrivals.add(machine(timestamp="2024-01-01T00:00:20Z"), machine(timestamp="2024-01-01T00:05:00Z"))
    assert closed_windows() == [(datetime(2024, 1, 1), 2)]


def test_waiting_for_nothing_is_an_error(spark):
    with pytest.raises(ValueError, match="no query"):
        await_any(spark.newSession())


def test_shared_queries_keep_a_common_cadence():
    lake, search = dataset("machine_bronze_lake"), dataset("machine_silver_search")
    relational = dataset("machine_bronze_relational")
    assert cadence([(search, None), (relational, None)]) == {"processingTime": "2 seconds"}
    assert cadence([(lake, None), (relational, None)]) is None and cadence([(lake, None)]) is None


def test_datasets_can_keep_their_own_cadence(session, arrivals, tmp_path):
    """Those of one cadence share a query; the trigger of a query is theirs."""
    arrivals.add(worker())
    stores = {"lake": Recorder(), "relational": Recorder(), "search": Recorder()}
    queries = start_domain(arrivals.stream(session), "worker", stores, str(tmp_path / "ck"), own_cadence=True)
    try:
        assert [q.name for q in queries] == ["worker_events", "worker_events_2_seconds", "worker_gold"]
        for query in queries:
            query.processAllAvailable()
        assert set(stores["relational"].batches) == {d.name for d in DATASETS if d.domain == "worker" and d.store == "relational"}
        assert len(stores["lake"].rows("worker_bronze_lake")) == 1 == len(stores["search"].rows("worker_silver_search"))
    finally:
        for query in queries:
            query.stop()
    together = start_domain(arrivals.stream(session), "worker", stores, str(tmp_path / "ck2"), ONCE, own_cadence=True)
    run(together)
    assert [q.name for q in together] == ["worker_events", "worker_gold"]


def test_a_sink_with_few_tasks_does_not_narrow_the_batch(session, arrivals, tmp_path):
    """Each payload is decoded in the batch's own partitions, once, before the sink merges them."""
    seen = []

    class Narrow:
        few_tasks = True

        def write(self, rows, target, batch):
            seen.append((rows.storageLevel.useMemory, rows.rdd.getNumPartitions(), rows.coalesce(1).count()))

    for _ in range(4):
        arrivals.add(worker())
    run(start_dataset(arrivals.stream(session), dataset("worker_bronze_relational"), Narrow(), str(tmp_path / "ck"), ONCE))
    assert [count for *_, count in seen] == [4] and seen[0][0]


def test_shared_folders_are_below_the_configured_one(spark):
    folder = shared_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir", "/tmp"))
    assert folder != shared_folder(spark, "x")


def test_stream_session_leaves_the_caller_alone(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert stream_session(spark, 3).conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_raw_payloads_match_the_stream_source(spark):
    assert raw_of(spark, SMALL, "machine").count() == 1000


def test_large_arrivals_come_as_more_files_and_stay_one_batch(spark, monkeypatch):
    monkeypatch.setattr("checks.streams.FILE_EVENTS", 20)
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    files = -(-events.count() // (SLICES * 20))
    root = run_slices(spark, events, "worker", {"silver"})
    assert len(spark.read.parquet(f"{root.removesuffix('/lake')}/wire").inputFiles()) == SLICES * files > SLICES * FILES_PER_BATCH
    stored = read_lake(spark, root, "worker", "silver", revisions=True)
    assert stored.select("batch_id").distinct().count() == SLICES
    assert stored.count() == layer_of(spark, SMALL, "worker", "silver").count()


def test_slices_of_one_file_are_dealt_to_all_cores(spark):
    from checks.streams import dealt

    events = spark.read.parquet(f"{SMALL}/events.parquet")
    parts = dealt(events, 3)
    assert sum(part.count() for part in parts) == events.count()
    assert all("REBALANCE" in part._jdf.queryExecution().optimizedPlan().toString().upper() for part in parts)
