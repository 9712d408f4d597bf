"""Streams over the event log: slices of it arrive one after another."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from checks.event_log import PAYLOADS
from floorline.sinks.lake import LakeSink
from floorline.sources.raw import read_stream
from floorline.streaming.closing import start_closing
from floorline.streaming.counters import OutcomeCounts
from floorline.streaming.datasets import DATASETS
from floorline.streaming.pipelines import start_domain
from floorline.streaming.workspace import shared_folder, stream_session

# Starts of the streams, the arrivals each of them finds, and the files of an arrival; an arrival is a micro-batch.
STARTS, ARRIVALS, FILES_PER_BATCH = 3, 2, 4
SLICES = STARTS * ARRIVALS
# Events of a file, at most; larger arrivals come as more files.
FILE_EVENTS = 50_000
WIRE_FILES = "event_id BIGINT, value BINARY"

# How much earlier than it arrives an event of the late-data query happened.
LATENESS = "make_dt_interval(0, CASE WHEN k >= 80 THEN (k - 80) * 5 ELSE 0 END)"


def slices(events: DataFrame, count: int = SLICES) -> list[DataFrame]:
    """The events in ``count`` equal id ranges, one after another; rows without an id come with the first."""
    first, last = events.agg(F.min("event_id"), F.max("event_id")).first()
    if first is None:
        return [events]
    # Bounds of the ids themselves: a reader skips the row groups of other slices.
    begins = [first - (-i * (last - first + 1) // count) for i in range(count + 1)]
    event_id = F.col("event_id")
    ranges = [(event_id >= a) & (event_id < b) if b <= last else event_id >= a for a, b in zip(begins, begins[1:])]
    return [events.where(ranges[0] | event_id.isNull()), *map(events.where, ranges[1:])]


def dealt(events: DataFrame, count: int) -> list[DataFrame]:
    """Slices whose rows are dealt to all cores before documents are made of them: a file of few row groups is read by few tasks."""
    return [part.hint("rebalance") for part in slices(events, count)]


def arrival_files(events: DataFrame) -> int:
    """Files of an arrival: so many that none is larger than the others and no task's work grows with the log."""
    return max(FILES_PER_BATCH, -(-events.count() // (SLICES * FILE_EVENTS)))


def feed(spark: SparkSession, events: DataFrame, domain: str, delay: str | None,
         start: Callable[[DataFrame, str], list[StreamingQuery]]) -> str:
    """Feed all events slice by slice to the queries that ``start`` makes of the stream; returns the work folder.

    Slices arrive as ordered files and a micro-batch takes one slice.  For every
    few of them the queries are started again on the same checkpoint and run
    until they have taken in everything there is.
    """
    work = shared_folder(spark, f"{domain}-stream")
    session = stream_session(spark)
    arriving, files = slices(events), arrival_files(events)
    for begin in range(0, len(arriving), ARRIVALS):
        for arrived in arriving[begin:begin + ARRIVALS]:
            # The events are dealt out, not the documents, which are then built by as many tasks as there are files.
            PAYLOADS[domain](arrived.repartition(files), delay).write.mode("append").parquet(f"{work}/wire")
        raw = read_stream(session, "parquet", {"maxFilesPerTrigger": files}, schema=WIRE_FILES, path=f"{work}/wire")
        for query in start(raw, work):
            query.awaitTermination()
    return work


def run_slices(spark: SparkSession, events: DataFrame, domain: str, layers: set[str], delay: str | None = None) -> str:
    """The layers of a domain kept in a lake by its streams; returns the lake root."""
    chosen = [d for d in DATASETS if d.domain == domain and d.layer in layers]

    def start(raw: DataFrame, work: str) -> list[StreamingQuery]:
        return start_domain(raw, domain, {"lake": LakeSink(f"{work}/lake")}, f"{work}/checkpoint", {"availableNow": True}, chosen)

    return f"{feed(spark, events, domain, delay, start)}/lake"


def run_counted(spark: SparkSession, events: DataFrame, domain: str) -> OutcomeCounts:
    """Outcome counts of every micro-batch of the stateless stream of a domain."""
    seen, chosen = OutcomeCounts(), [d for d in DATASETS if d.domain == domain and d.layer == "silver"]

    def start(raw: DataFrame, work: str) -> list[StreamingQuery]:
        session = raw.sparkSession
        session.streams.addListener(seen)
        try:
            queries = start_domain(raw, domain, {"lake": LakeSink(f"{work}/lake")}, f"{work}/checkpoint", {"availableNow": True}, chosen)
            for query in queries:
                query.awaitTermination()
                seen.wait_for(query)
        finally:
            session.streams.removeListener(seen)
        return queries

    feed(spark, events, domain, None, start)
    return seen


def run_closing(spark: SparkSession, events: DataFrame, domain: str, delay: str | None = None) -> str:
    """Closed windows and late events of a domain in a lake; returns its root."""

    def start(raw: DataFrame, work: str) -> list[StreamingQuery]:
        sink = LakeSink(f"{work}/lake")
        return [start_closing(raw, domain, sink, sink, f"{work}/checkpoint", {"availableNow": True})]

    return f"{feed(spark, events, domain, delay, start)}/lake"
