"""Outcome counts that arrive with a stream's progress."""

from __future__ import annotations

import json

import pytest
from conftest import machine, worker
from pyspark.sql import functions as F

from floorline.operators.quality import RULES
from floorline.plans import layers
from floorline.sources.raw import read_stream
from floorline.streaming.counters import UNROUTED, VALID, OutcomeCounts, counts, outcomes
from floorline.streaming.datasets import dataset
from floorline.streaming.pipelines import start_stateless
from floorline.streaming.workspace import stream_session

DOCUMENTS = [machine(), machine(timestamp=None), machine(temperature=999.0), machine(temperature=None), machine(rpm=-1), machine(rpm=None),
             machine(power_kw=-1), machine(status="?"), machine(machine_id=""), machine(machine_id=None), "not json", machine(temperature=999.0, rpm=-1)]


def test_every_row_has_one_outcome(raw):
    for domain, documents in (("machine", DOCUMENTS), ("worker", [worker(), worker(heart_rate=None), worker(worker_id=""), "x"])):
        bronze = layers.bronze_layer(raw(*documents), domain)
        found = bronze.agg(*counts(domain)).first().asDict()
        assert sum(found.values()) == len(documents) and list(found) == outcomes(domain)
        quarantined = {r.validation_reason: r["count"] for r in layers.quarantine_layer(bronze, domain).groupBy("validation_reason").count().collect()}
        assert {k: v for k, v in found.items() if v and k not in (VALID, UNROUTED)} == quarantined
        assert found[UNROUTED] == layers.unrouted_rows(bronze, domain).count()
    empty = layers.bronze_layer(raw("x"), "machine").limit(0).agg(*counts("machine")).first()
    assert set(empty.asDict().values()) == {0} and len(empty) == len(RULES["machine"]) + 2


class Reader:
    """A sink that looks at the rows so many times."""

    def __init__(self, times):
        self.times = times

    def write(self, rows, target, batch):
        for _ in range(self.times):
            rows.where(F.lit(True)).collect()


@pytest.mark.parametrize("stores, times", [(["lake"], 1), (["relational", "lake", "topic"], 2)])
def test_counts_of_a_stream(spark, tmp_path, stores, times):
    """Sinks that share a batch read what is kept of it, so it is counted once however often they look."""
    session, wire, seen = stream_session(spark, 2), tmp_path / "wire", OutcomeCounts()
    wire.mkdir()
    chosen = [d for d in (dataset("machine_quarantine_relational"), dataset("machine_bronze_lake"), dataset("machine_silver_topic")) if d.store in stores]
    session.streams.addListener(seen)
    try:
        for k, part in enumerate((DOCUMENTS[:5], DOCUMENTS[5:])):
            (wire / f"{k}.json").write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in part))
            query = start_stateless(read_stream(session, "text", path=str(wire)), "machine", [(d, Reader(times)) for d in chosen], str(tmp_path / "ck"),
                                    {"availableNow": True})
            query.awaitTermination()
            seen.wait_for(query)
    finally:
        session.streams.removeListener(seen)
    by_batch = [sum(found.values()) for _, found in sorted(seen.batches.items(), key=lambda x: x[0][1])]
    assert by_batch == [5, 7] and {k: n for k, n in seen.totals().items() if n} == {
        "NULL_TIMESTAMP": 2, "NULL_TEMPERATURE": 1, "TEMPERATURE_OUT_OF_RANGE": 2, "INVALID_RPM": 1, "INVALID_POWER": 1, "INVALID_STATUS": 1,
        "EMPTY_MACHINE_ID": 1, VALID: 1, UNROUTED: 2}
