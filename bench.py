"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores and
``BENCH_RUNS`` the measured runs per query.  The event log, one small file of one row
group there, is first copied as a file per core, as a single file is one task whatever
the query does; all rows are kept and the copy is not timed.  Each query runs once unmeasured and
its median is taken; the result goes to a ``noop`` sink, so all columns of all
rows are computed but nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from checks.queries import registered
from floorline.session import build_session

HEADLINE = (
    "machine_decode_bronze",
    "worker_decode_bronze",
    "machine_quarantine",
    "machine_silver",
    "worker_silver",
    "machine_gold",
    "worker_gold",
    "machine_silver_json",
    "machine_events_index",
    "worker_events_silver_view",
    "median_temperature",
    "median_vibration",
    "median_fatigue",
    "median_heart_rate",
    "stream_machine_gold_update",
    "stream_worker_gold_update",
    "stream_late_data",
    "stream_silver_append",
    "parquet_sink_roundtrip",
)


def spread(spark, folder: str, files: int) -> str:
    """A new folder with the event log of ``folder`` in several files."""
    copy = tempfile.mkdtemp(prefix="floorline-bench-")
    spark.read.parquet(f"{folder}/events.parquet").repartitionByRange(files, "event_id").write.parquet(f"{copy}/events.parquet")
    return copy


def seconds(query, spark, folder: str) -> float:
    began = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    events = spread(spark, folder, int(cpus))
    measured = {}
    for name in names:
        seconds(queries[name], spark, events)
        measured[name] = round(statistics.median(seconds(queries[name], spark, events) for _ in range(runs)), 3)
        print(f"{name} {measured[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds of the headline queries, median run each",
        "value": round(sum(measured.values()), 3),
        "unit": "sec",
        "queries": measured,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
