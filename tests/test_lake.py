"""The lake's commit log: snapshots, crashes, concurrent writers, checkpoints, compaction."""

from __future__ import annotations

from datetime import date

import pytest
from conftest import machine, worker

from floorline.plans.layers import build_layer
from floorline.sinks import commits, lake
from floorline.sinks.batch import Batch
from floorline.sinks.commits import CommitLog, File
from floorline.sinks.lake import LakeSink, compact, read_lake, vacuum
from floorline.streaming.datasets import dataset, lake_path

TODAY = date(2024, 1, 3)


def bronze(raw, *documents):
    return build_layer(raw(*documents), "machine", "bronze")


def ids(spark, root, **options):
    return sorted(r.event_id for r in read_lake(spark, str(root), "machine", "bronze", **options).collect())


@pytest.fixture
def days(spark, raw, tmp_path):
    """Three batches over three days."""
    sink = LakeSink(str(tmp_path))
    for k in range(3):
        rows = bronze(raw, *(machine(event_id=f"{d}{k}", timestamp=f"2024-01-0{d}T0{k}:00:00Z") for d in (1, 2, 3)))
        sink.write(rows, dataset("machine_bronze_lake"), Batch("q", k))
    return tmp_path


def data_files(root):
    return [p for p in root.rglob("*.parquet") if "event_date=" in str(p)]


def test_versions_are_snapshots(spark, days):
    assert ids(spark, days) == sorted(f"{d}{k}" for d in (1, 2, 3) for k in range(3))
    assert ids(spark, days, version=1) == ["10", "20", "30"] and ids(spark, days, version=0) == []
    assert ids(spark, days, since=date(2024, 1, 2), until=TODAY) == ["20", "21", "22"]


def test_a_crash_before_the_commit_leaves_the_old_snapshot(spark, raw, days, monkeypatch):
    before = ids(spark, days)
    more = bronze(raw, machine(event_id="new", timestamp="2024-01-02T09:00:00Z"))

    def dies(*_, **__):
        raise OSError("host lost")

    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", dies)
        with pytest.raises(OSError):
            LakeSink(str(days)).write(more, dataset("machine_bronze_lake"), Batch("q", 3))
        with pytest.raises(OSError):
            compact(spark, str(days), "machine", "bronze", TODAY)
    assert ids(spark, days) == before
    # The replay writes over what was staged and commits.
    LakeSink(str(days)).write(more, dataset("machine_bronze_lake"), Batch("q", 3))
    assert ids(spark, days) == sorted([*before, "new"])


def test_a_committed_batch_is_not_written_again(spark, raw, days):
    other = bronze(raw, machine(event_id="other"))
    for sink in (LakeSink(str(days)), LakeSink(str(days))):
        sink.write(other, dataset("machine_bronze_lake"), Batch("q", 1))
        sink.write(other, dataset("machine_bronze_lake"), Batch("q", 2))
    assert "other" not in ids(spark, days)
    assert len(list((days / "bronze/machine_bronze_data/_log").glob("*.json"))) == 3


def test_compaction_is_one_commit_and_repeatable(spark, days):
    before, files = ids(spark, days), len(data_files(days))
    assert files == 9
    assert compact(spark, str(days), "machine", "bronze", TODAY) == 4
    assert ids(spark, days) == before and ids(spark, days, version=3) == before
    active = CommitLog(spark, f"{days}/{lake_path('machine', 'bronze')}").active().collect()
    assert sorted(str(r.day) for r in active) == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-03", "2024-01-03"]
    assert compact(spark, str(days), "machine", "bronze", TODAY) is None
    # What arrives late for a compacted day makes it one to compact again.
    assert vacuum(spark, str(days), "machine", "bronze", 3600) == []
    assert len(vacuum(spark, str(days), "machine", "bronze", -10)) == 6
    assert ids(spark, days) == before and len(data_files(days)) == 5


def test_a_late_batch_reopens_a_compacted_day(spark, raw, days):
    compact(spark, str(days), "machine", "bronze", TODAY)
    LakeSink(str(days)).write(bronze(raw, machine(event_id="late")), dataset("machine_bronze_lake"), Batch("q", 3))
    assert compact(spark, str(days), "machine", "bronze", TODAY) == 6
    assert "late" in ids(spark, days) and len(ids(spark, days)) == 10


def test_a_batch_commits_while_a_compaction_runs(spark, raw, days, monkeypatch):
    real, late = lake.stage, bronze(raw, machine(event_id="meanwhile", timestamp="2024-01-01T08:00:00Z"))

    def slow(rows, log, batch):
        found = real(rows, log, batch)
        if batch.query_id.startswith(lake.COMPACTION):
            monkeypatch.setattr(lake, "stage", real)
            LakeSink(str(days)).write(late, dataset("machine_bronze_lake"), Batch("q", 3))
        return found

    before = ids(spark, days)
    monkeypatch.setattr(lake, "stage", slow)
    assert compact(spark, str(days), "machine", "bronze", TODAY) == 5
    assert ids(spark, days) == sorted([*before, "meanwhile"])


def test_of_two_compactions_one_counts(spark, days, monkeypatch):
    real = lake.stage

    def slow(rows, log, batch):
        monkeypatch.setattr(lake, "stage", real)
        assert compact(spark, str(days), "machine", "bronze", TODAY) == 4
        return real(rows, log, batch)

    before = ids(spark, days)
    monkeypatch.setattr(lake, "stage", slow)
    assert compact(spark, str(days), "machine", "bronze", TODAY) is None
    assert ids(spark, days) == before


def test_a_version_has_one_author(spark, tmp_path):
    first, second = CommitLog(spark, str(tmp_path)), CommitLog(spark, str(tmp_path))
    assert first.commit(1, Batch("a", 0), [File("event_date=2024-01-01/x.parquet", "2024-01-01", 1)])
    assert not second.commit(1, Batch("b", 0))
    second.refresh()
    assert second.holds(Batch("a", 0)) and not second.holds(Batch("a", 1)) and not second.holds(Batch("b", 0))
    assert second.commit(2, Batch("b", 0)) and second.active().count() == 1
    assert not [p for p in (tmp_path / "_log").iterdir() if p.suffix not in (".json", ".crc")]


def test_checkpoints_replace_earlier_commits(spark, raw, days, monkeypatch):
    monkeypatch.setattr(commits, "CHECKPOINT_EVERY", 2)
    sink = LakeSink(str(days))
    for k in (3, 4, 5):
        sink.write(bronze(raw, machine(event_id=f"x{k}")), dataset("machine_bronze_lake"), Batch("q", k))
    log = days / "bronze/machine_bronze_data/_log"
    assert {p.name for p in log.glob("*.checkpoint")} == {f"{v:020}.checkpoint" for v in (4, 6)}
    expected = ids(spark, days)
    for version in (1, 2, 3):
        (log / f"{version:020}.json").unlink()
    assert ids(spark, days) == expected and len(expected) == 12
    fresh = CommitLog(spark, f"{days}/{lake_path('machine', 'bronze')}")
    assert fresh.holds(Batch("q", 5)) and not fresh.holds(Batch("q", 6)) and fresh.latest == 6


def test_gold_revisions_follow_the_log(spark, raw, tmp_path, monkeypatch):
    """The newest commit's row of a window counts, whatever the clock says; compaction keeps that one."""
    sink, target = LakeSink(str(tmp_path)), dataset("worker_gold_lake")
    for k, scores in enumerate([(10,), (10, 30), (10, 30, 80)]):
        monkeypatch.setattr("time.time_ns", lambda k=k: 10 ** 18 - k * 10 ** 15)
        sink.write(build_layer(raw(*(worker(fatigue_score=s) for s in scores)), "worker", "gold"), target, Batch(f"q{k}", 0))
    read = lambda **o: read_lake(spark, str(tmp_path), "worker", "gold", **o)
    assert [r.avg_fatigue_score for r in read().collect()] == [40.0]
    assert sorted(r.revision for r in read(revisions=True).collect()) == [1, 2, 3]
    assert compact(spark, str(tmp_path), "worker", "gold", TODAY) == 4
    assert [(r.avg_fatigue_score) for r in read().collect()] == [40.0] and [r.revision for r in read(revisions=True).collect()] == [3]
    sink.write(build_layer(raw(worker(fatigue_score=5)), "worker", "gold"), target, Batch("q9", 0))
    assert [r.avg_fatigue_score for r in read().collect()] == [5.0]


def test_rows_without_a_time_belong_to_the_day_they_arrived(spark, raw, tmp_path):
    sink = LakeSink(str(tmp_path))
    sink.write(bronze(raw, machine(event_id="t"), machine(event_id="n", timestamp=None), "broken"), dataset("machine_bronze_lake"), Batch("q", 0))
    folders = sorted(p.name for p in (tmp_path / "bronze/machine_bronze_data").iterdir() if p.name.startswith("event_date="))
    assert len(folders) == 2 and folders[0] == "event_date=2024-01-01" and "HIVE" not in folders[1]
    assert read_lake(spark, str(tmp_path), "machine", "bronze").count() == 3
