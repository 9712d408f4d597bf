
from __future__ import annotations

import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.queries import layer_of, raw_of
from checks.streams import WIRE_FILES
from floorline.contracts import MACHINE_BRONZE_FIELDS, MACHINE_WIRE
from floorline.functions.clock import parse_event_time
from floorline.operators.median import approx_median, exact_median
from floorline.plans import layers
from floorline.session import build_session
from floorline.sinks.lake import LakeSink
from floorline.sources.raw import read_stream
from floorline.streaming.datasets import DATASETS
from floorline.streaming.pipelines import start_dataset, start_domain
from floorline.streaming.workspace import shared_folder, stream_session

RUNS = 5


def report(name: str, act: Callable[[], object], runs: int = RUNS) -> None:
    """Median of ``runs`` after one unmeasured run."""
    times = []
    for _ in range(runs + 1):
        began = time.perf_counter()
        act()
        times.append(time.perf_counter() - began)
    print(f"{name}: {statistics.median(times[1:]):.2f} s", flush=True)


def run_all(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def plain_bronze(raw: DataFrame) -> DataFrame:
    """Machine bronze the usual way, which lets filters copy ``from_json``."""
    parsed = raw.select(F.from_json(F.col("value").cast("string"), MACHINE_WIRE).alias("d")).select("d.*")
    return parsed.select(
        *(
            (parse_event_time() if name == "timestamp" else F.col(field)).alias(name)
            for name, field in MACHINE_BRONZE_FIELDS.items()
        )
    )


def batch(spark: SparkSession, folder: str, wire: str) -> None:
    for domain in ("machine", "worker"):
        report(f"batch {domain} events to gold", lambda: run_all(layer_of(spark, folder, domain, "gold")))
        stored = spark.read.parquet(f"{wire}/{domain}")
        report(
            f"batch {domain} stored payloads to gold",
            lambda: run_all(layers.build_layer(stored, domain, "gold")),
        )
    stored = spark.read.parquet(f"{wire}/machine")
    for name, bronze in (("once", layers.bronze_layer(stored, "machine")), ("plain", plain_bronze(stored))):
        silver = layers.silver_layer(bronze, "machine")
        report(f"machine silver, payload parsed {name}", lambda: run_all(silver))


def medians(spark: SparkSession, folder: str) -> None:
    """Hourly medians, then one bucket that holds everything."""
    work = shared_folder(spark, "measure")
    layer_of(spark, folder, "machine", "silver").write.parquet(work)
    silver = spark.read.parquet(work)
    hours = silver.select(F.window("timestamp", "1 hour")["start"].alias("b"), "temperature")
    single = silver.select(F.lit(0).alias("b"), "temperature")
    for name, rows in (("hourly", hours), ("one bucket", single)):
        report(f"{name} median, exact", lambda: run_all(exact_median(rows, ["b"], "temperature")))
        report(f"{name} median, approximate", lambda: run_all(approx_median(rows, ["b"], "temperature")))
        report(f"{name} median, built-in", lambda: run_all(rows.groupBy("b").agg(F.median("temperature"))))


def streams(spark: SparkSession, wire: str) -> None:
    session = stream_session(spark)
    once = {"availableNow": True}

    def source(domain: str) -> DataFrame:
        return read_stream(session, "parquet", schema=WIRE_FILES, path=f"{wire}/{domain}")

    def run(start: Callable[[str, LakeSink], list]) -> None:
        work = shared_folder(spark, "measure")
        for query in start(f"{work}/checkpoint", LakeSink(f"{work}/lake")):
            query.awaitTermination()

    def together(checkpoint: str, lake: LakeSink) -> list:
        return [
            query for domain in ("machine", "worker")
            for query in start_domain(source(domain), domain, {"lake": lake}, checkpoint, once)
        ]

    def alone(checkpoint: str, lake: LakeSink) -> list:
        return [
            start_dataset(source(d.domain), d, lake, checkpoint, once) for d in DATASETS if d.store == "lake"
        ]

    def gold(checkpoint: str, lake: LakeSink) -> list:
        target = next(d for d in DATASETS if d.name == "machine_gold_lake")
        return [start_dataset(source("machine"), target, lake, checkpoint, once)]

    rows = spark.read.parquet(f"{wire}/machine").count()
    print(f"stream rows: {rows}")
    report("stream machine gold", lambda: run(gold), 3)
    report("6 lake datasets, 4 queries", lambda: run(together), 3)
    report("6 lake datasets, 6 queries", lambda: run(alone), 3)


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("measure", "local[8]", spark__ui__enabled="false", spark__driver__memory="16g",
                          spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    print(f"{folder}, Spark {spark.version}, {spark.sparkContext.defaultParallelism} cores")
    wire = shared_folder(spark, "wire")
    for domain in ("machine", "worker"):
        raw_of(spark, folder, domain).write.parquet(f"{wire}/{domain}")
    batch(spark, folder, wire)
    medians(spark, folder)
    streams(spark, wire)
    spark.stop()


if __name__ == "__main__":
    main()
