"""Gold windows once, when they close, and the events that came too late for theirs.

The gold stream stores a window whenever it changes and drops what comes behind the
watermark.  The stream here keeps a part per open window (``operators/partials.py``) in
arbitrary state, gives a window out once, by an event-time timer, and sends late
events to an output of their own: an event is either in exactly one closed or open
window or among the late ones.

A key's windows are dealt to ``SPANS`` spans by their time, each a group of its own, so the
tasks are not bounded by the keys.  A group's micro-batch is aggregated by numpy, state
is read and written once per ``CHUNK`` windows and not per window, and all windows of a
group that a watermark closes are given out together.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from floorline.contracts import LAYERS
from floorline.operators.gold import WATERMARK
from floorline.operators.partials import EVENTS, KEYS, LENGTHS, MAKES, gold_from_parts, measures, part_columns, windowed_measures
from floorline.operators.series import MICROS
from floorline.plans import layers
from floorline.sinks.batch import current_batch
from floorline.streaming.datasets import Dataset
from floorline.streaming.pipelines import Sink, start_query

CLOSED, LATE, KIND = "closed", "late", "kind"
# Lake tables of the two outputs; gold's and silver's columns.
OUTPUTS = {
    domain: {CLOSED: Dataset(domain, "gold", "lake", f"gold/{domain}_closed_data", None),
             LATE: Dataset(domain, "silver", "lake", f"silver/{domain}_late_data", None)}
    for domain in KEYS
}
NAMES = tuple(MAKES)
MERGE = {"n": np.add, "sum": np.add, "min": np.minimum, "max": np.maximum}
# Neighbouring windows of a state entry, and spans that a key's entries are dealt to, so that its work is not one task's.
CHUNK, SPANS, SPAN = 512, 16, "span"


def window_micros(domain: str) -> int:
    amount, unit = LENGTHS[domain].split()
    return int(amount) * MICROS[unit.rstrip("s")]


def merged(starts: np.ndarray, parts: np.ndarray, events: np.ndarray) -> Open:
    """One part per window of all that there are, windows in order; ``parts`` is kinds by rows by measures."""
    order = np.argsort(starts, kind="stable")
    ordered, events = starts[order], events[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    made = [MERGE[kind].reduceat(parts[k][order], first, axis=0) for k, kind in enumerate(NAMES)]
    return Open(ordered[first], np.stack(made), np.add.reduceat(events, first))


class Open(NamedTuple):
    """Open windows: where they begin, in microseconds, their parts, and how many events each has."""

    starts: np.ndarray
    parts: np.ndarray
    events: np.ndarray

    def where(self, chosen: np.ndarray) -> Open:
        return Open(self.starts[chosen], self.parts[:, chosen], self.events[chosen])

    def stored(self) -> tuple[bytes, bytes, bytes]:
        return tuple(np.ascontiguousarray(each).tobytes() for each in self)

    @classmethod
    def read(cls, value: tuple) -> Open:
        starts, parts, events = (np.frombuffer(each, kind) for each, kind in zip(value, (np.int64, np.float64, np.int64)))
        return cls(starts, parts.reshape(len(NAMES), len(starts), -1), events)


class OpenWindows(StatefulProcessor):
    """Per key and span: the parts of the open windows, ``CHUNK`` neighbouring windows to a state entry.

    An entry's timer is due when the first of its windows is.
    """

    def __init__(self, key: str, length: int, measured: list[str], late_columns: list[str], columns: list[str]):
        self.key, self.length, self.measured, self.late_columns, self.columns = key, length, measured, late_columns, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "chunk BIGINT", "starts BINARY, parts BINARY, events BINARY")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        for frame in rows:
            start = frame["window_start"].astype("datetime64[us]").astype("int64").to_numpy()
            late = start + self.length <= watermark
            if late.any():
                yield self.shaped(frame.loc[late, [self.key, *self.late_columns]].assign(**{KIND: LATE}))
            if not late.all():
                self.add(frame.loc[~late, self.measured].to_numpy(np.float64), start[~late])

    def shaped(self, frame: pd.DataFrame) -> pd.DataFrame:
        """All columns of the output; those that ``frame`` has not are null, whatever their type."""
        return pd.DataFrame({name: frame[name] if name in frame else pd.Series(None, frame.index, object) for name in self.columns})

    def add(self, values: np.ndarray, start: np.ndarray) -> None:
        known = ~np.isnan(values)
        makes = {"n": known, "sum": np.where(known, values, 0), "min": np.where(known, values, np.inf), "max": np.where(known, values, -np.inf)}
        fresh = merged(start, np.stack([makes[kind].astype(np.float64) for kind in NAMES]), np.ones(len(start), np.int64))
        chunks = fresh.starts // (self.length * CHUNK)
        for chunk in np.unique(chunks).tolist():
            new, stored = fresh.where(chunks == chunk), self.windows.getValue((chunk,))
            old = Open.read(stored) if stored else None
            if old is None or new.starts[0] < old.starts[0]:
                self.handle.registerTimer(self.end(new))
            if old is not None:
                new = merged(*(np.concatenate(pair, axis=axis) for pair, axis in zip(zip(old, new), (0, 1, 0))))
            self.windows.updateValue((chunk,), new.stored())

    def end(self, windows: Open) -> int:
        """When the first of the windows ends, in milliseconds; windows end on whole ones."""
        return (int(windows.starts[0]) + self.length) // 1000

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        stored = self.windows.getValue(((expiredTimerInfo.getExpiryTimeInMs() * 1000 - self.length) // (self.length * CHUNK),))
        if stored is None or self.end(Open.read(stored)) > watermark:
            return  # given out with an earlier timer
        closed = []
        for (chunk,), value in list(self.windows.iterator()):
            windows = Open.read(value)
            due = windows.starts + self.length <= watermark * 1000
            if due.all():
                self.windows.removeKey((chunk,))
            elif due.any():
                rest = windows.where(~due)
                self.windows.updateValue((chunk,), rest.stored())
                self.handle.registerTimer(self.end(rest))
            closed.append(windows.where(due))
        starts, events = np.concatenate([each.starts for each in closed]), np.concatenate([each.events for each in closed])
        parts = np.concatenate([each.parts for each in closed], axis=1)
        # A sum or extreme of no values is null; the number of values is the first kind.
        parts = np.where((parts[NAMES.index("n")] > 0) | (np.array(NAMES) == "n")[:, None, None], parts, np.nan)
        numbers = {f"{name}_{kind}": parts[k, :, m] for m, name in enumerate(self.measured) for k, kind in enumerate(NAMES)}
        times = {name: pd.to_datetime(at, unit="us") for name, at in (("window_start", starts), ("window_end", starts + self.length))}
        yield self.shaped(pd.DataFrame({**numbers, EVENTS: events, **times, self.key: key[0], KIND: CLOSED}))

    def close(self) -> None:
        pass


def closing_rows(silver: DataFrame, domain: str, watermark: str = WATERMARK) -> DataFrame:
    """Closed windows and late events of a silver stream in one DataFrame, told apart by ``kind``; each has nulls for the other's columns."""
    key, measured = KEYS[domain], list(measures(domain))
    # The watermark goes by a copy of the time that is then left out: Spark drops late rows where it finds the column itself.
    clocked = silver.withColumn("clock", F.col("timestamp")).withWatermark("clock", watermark)
    own = [name for name in LAYERS[domain, "silver"] if name != key]
    kept = {name: F.col(name).alias(f"row_{name}") for name in own}
    rows = windowed_measures(clocked, domain, *kept.values())
    late_columns = [f"row_{name}" for name in own]
    numbers = [T.StructField(name, T.LongType() if name == EVENTS else T.DoubleType()) for name in part_columns(domain)]
    shape = T.StructType([
        T.StructField(KIND, T.StringType()), T.StructField(key, T.StringType()), T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()), *numbers,
        *(T.StructField(f"row_{name}", silver.schema[name].dataType) for name in own)])
    length = window_micros(domain)
    spanned = rows.withColumn(SPAN, F.expr(f"pmod(unix_micros(window_start) div {length * CHUNK}, {SPANS})"))
    return spanned.groupBy(key, SPAN).transformWithStateInPandas(
        OpenWindows(key, length, measured, late_columns, shape.fieldNames()), shape, "append", "EventTime")


def closed_windows(rows: DataFrame, domain: str) -> DataFrame:
    return gold_from_parts(rows.where(F.col(KIND) == CLOSED), domain)


def late_events(rows: DataFrame, domain: str) -> DataFrame:
    key = KEYS[domain]
    names = LAYERS[domain, "silver"]
    return rows.where(F.col(KIND) == LATE).select(*(F.col(name if name == key else f"row_{name}").alias(name) for name in names))


def start_closing(raw: DataFrame, domain: str, closed: Sink, late: Sink, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
    """Closed windows and late events of a domain, each to its sink, from one state."""
    outputs = OUTPUTS[domain]

    def write(rows: DataFrame, batch_id: int) -> None:
        batch = current_batch(rows, batch_id)
        rows.persist()
        try:
            closed.write(closed_windows(rows, domain), outputs[CLOSED], batch)
            late.write(late_events(rows, domain), outputs[LATE], batch)
        finally:
            rows.unpersist()

    silver = layers.build_layer(raw, domain, "silver")
    return start_query(raw.sparkSession, closing_rows(silver, domain).writeStream.outputMode("append").foreachBatch(write),
                       f"{domain}_closing", checkpoint, trigger)
