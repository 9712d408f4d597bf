"""Streams from raw payloads to the datasets.

Two queries per domain maintain all of its datasets:

* the stateless query decodes each micro-batch once, keeps it while bronze,
  quarantine and silver are written to every sink, and then lets it go;
* the gold query holds one windowed state and writes each changed window to
  every gold sink.

All sinks of a query therefore see the same batches, the source is read twice
instead of once per dataset, and there is one state instead of one per gold sink.
A single dataset can also be run as a query of its own with ``start_dataset``.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from floorline.operators.gold import WATERMARK
from floorline.plans import layers
from floorline.sinks.batch import Batch, current_batch
from floorline.sinks.topic import TopicSink
from floorline.streaming.counters import counted
from floorline.streaming.datasets import DATASETS, Dataset

log = logging.getLogger(__name__)

# Writes of one batch that run at the same time.
CONCURRENT_WRITES = 4
POOL = "spark.scheduler.pool"

Outputs = list[tuple[Dataset, "Sink"]]
Derive = Callable[[DataFrame], Mapping[str, DataFrame]]


class Sink(Protocol):
    def write(self, rows: DataFrame, dataset: Dataset, batch: Batch) -> None: ...


def _writer(derive: Derive, outputs: Outputs) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: every output of one batch, or an error.

    With several outputs, or one that writes with few tasks, the batch is
    persisted and filled by a pass of its own, in as many tasks as the batch has
    partitions and with each partition, state included, computed once.  The
    outputs then read what is kept and run side by side, as most wait on different
    stores.  An error ends the query; after a restart the whole batch is run again.
    """

    def write_one(rows: DataFrame, dataset: Dataset, sink: Sink, batch: Batch) -> None:
        try:
            sink.write(rows, dataset, batch)
        except Exception:
            log.exception("%s: batch %s not written", dataset.name, batch.batch_id)
            raise

    kept = len(outputs) > 1 or any(getattr(sink, "few_tasks", False) for _, sink in outputs)

    def write(rows: DataFrame, batch_id: int) -> None:
        batch = current_batch(rows, batch_id)
        if kept:
            rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if kept:
                rows.write.format("noop").mode("append").save()
            derived = derive(rows)
            if len(outputs) == 1:
                dataset, sink = outputs[0]
                write_one(derived[dataset.layer], dataset, sink, batch)
                return
            # The threads' Spark jobs belong to the query and stop with it.
            job = inheritable_thread_target(rows.sparkSession)(write_one)
            with ThreadPoolExecutor(min(len(outputs), CONCURRENT_WRITES)) as pool:
                writes = [pool.submit(job, derived[d.layer], d, sink, batch) for d, sink in outputs]
            for done in writes:
                done.result()
        finally:
            if kept:
                rows.unpersist()

    return write


def start_query(
    spark: SparkSession, writer: DataStreamWriter, name: str, checkpoint: str, trigger: Mapping | None
) -> StreamingQuery:
    """Start a query in a scheduler pool of its own.

    With ``spark.scheduler.mode=FAIR`` the queries of an application then share
    its cores; otherwise the pool has no effect.
    """
    writer = writer.queryName(name).option("checkpointLocation", f"{checkpoint}/{name}")
    if trigger:
        writer = writer.trigger(**trigger)
    spark.sparkContext.setLocalProperty(POOL, name)
    try:
        return writer.start()
    finally:
        spark.sparkContext.setLocalProperty(POOL, None)


def start_stateless(
    raw: DataFrame, domain: str, outputs: Outputs, checkpoint: str, trigger: Mapping | None = None, suffix: str = ""
) -> StreamingQuery:
    """Bronze, quarantine and silver datasets from one pass over the source."""
    write = _writer(lambda bronze: layers.stateless_layers(bronze, domain), outputs)
    bronze = counted(layers.bronze_layer(raw, domain), domain)
    return start_query(
        raw.sparkSession, bronze.writeStream.outputMode("append").foreachBatch(write),
        f"{domain}_events{suffix}", checkpoint, trigger,
    )


def start_gold(
    raw: DataFrame, domain: str, outputs: Outputs, checkpoint: str, trigger: Mapping | None = None, suffix: str = ""
) -> StreamingQuery:
    """Gold datasets from one windowed state; changed windows are written again."""
    write = _writer(lambda gold: {"gold": gold}, outputs)
    gold = layers.build_layer(raw, domain, "gold", watermark=WATERMARK)
    return start_query(
        raw.sparkSession, gold.writeStream.outputMode("update").foreachBatch(write),
        f"{domain}_gold{suffix}", checkpoint, trigger,
    )


def cadence(outputs: Outputs) -> Mapping | None:
    """The trigger that a shared query's datasets have in common."""
    triggers = {d.trigger for d, _ in outputs}
    return {"processingTime": triggers.pop()} if len(triggers) == 1 and None not in triggers else None


def start_domain(
    raw: DataFrame,
    domain: str,
    sinks: Mapping[str, Sink],
    checkpoint: str,
    trigger: Mapping | None = None,
    datasets: Iterable[Dataset] = DATASETS,
    own_cadence: bool = False,
) -> list[StreamingQuery]:
    """All datasets of a domain whose store has an entry in ``sinks``.

    ``trigger`` holds the arguments of ``DataStreamWriter.trigger``, e.g.
    ``{"processingTime": "2 seconds"}``.  Without it a query keeps the cadence of
    its datasets: theirs if they all have the same one, back to back otherwise,
    as one pass serves them all and none may wait longer than it should.  With
    ``own_cadence`` datasets of different cadences do not share a query, so each keeps
    its own, at the price of a pass over the source, and of a gold state, per cadence.
    """
    outputs = [(d, sinks[d.store]) for d in datasets if d.domain == domain and d.store in sinks]
    stateless = [(d, sink) for d, sink in outputs if d.layer != "gold"]
    gold = [(d, sink) for d, sink in outputs if d.layer == "gold"]
    queries = []
    for start, chosen in ((start_stateless, stateless), (start_gold, gold)):
        if own_cadence and not trigger:
            for step in sorted({d.trigger or "" for d, _ in chosen}):
                own = [(d, sink) for d, sink in chosen if (d.trigger or "") == step]
                # Names are also those of checkpoints, so the query without a cadence keeps its own.
                queries.append(start(raw, domain, own, checkpoint, cadence(own), f"_{step.replace(' ', '_')}" if step else ""))
        elif chosen:
            queries.append(start(raw, domain, chosen, checkpoint, trigger or cadence(chosen)))
    return queries


def start_dataset(
    raw: DataFrame, dataset: Dataset, sink: Sink, checkpoint: str, trigger: Mapping | None = None
) -> StreamingQuery:
    """One dataset as a query of its own, on its own trigger unless given."""
    if trigger is None and dataset.trigger:
        trigger = {"processingTime": dataset.trigger}
    watermark = WATERMARK if dataset.layer == "gold" else None
    rows = layers.build_layer(raw, dataset.domain, dataset.layer, watermark)
    if isinstance(sink, TopicSink):
        writer = sink.documents(rows, dataset).writeStream.format("kafka").options(**sink.options(dataset.target))
    else:
        writer = rows.writeStream.foreachBatch(_writer(lambda batch: {dataset.layer: batch}, [(dataset, sink)]))
    return start_query(raw.sparkSession, writer.outputMode(dataset.output_mode), dataset.name, checkpoint, trigger)


def await_any(spark: SparkSession, timeout: float | None = None) -> bool | None:
    """Wait until a query of the session ends; raises if it failed, or if there is none to wait for."""
    if not spark.streams.active and timeout is None:
        raise ValueError("no query is running")
    return spark.streams.awaitAnyTermination(timeout)
