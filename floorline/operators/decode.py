"""Wire payload -> typed, flat bronze rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floorline.contracts import (
    MACHINE_BRONZE_FIELDS,
    MACHINE_WIRE,
    WORKER_BRONZE_FIELDS,
    WORKER_WIRE,
)
from floorline.functions.clock import parse_event_time
from floorline.functions.once import expand_once


def decode(raw: DataFrame, wire: str | T.StructType, payload: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """Parse the JSON payload (binary or text) into the columns of ``wire``, beside the columns ``keep`` of ``raw``.

    A payload that is not JSON yields a row of nulls, a field of the wrong type a
    null field.  Each payload is parsed once, however many filters follow.
    """
    return expand_once(raw, F.from_json(F.col(payload).cast("string"), wire), keep)


def pruned(wire: str, sources: Iterable[str]) -> T.StructType:
    """The part of a wire format that holds the fields ``sources`` (``block.field`` in a block); others are skipped unparsed."""
    wanted: dict[str, set[str]] = {}
    for source in sources:
        name, _, inner = source.partition(".")
        wanted.setdefault(name, set()).add(inner)
    kept = []
    for field in T.StructType.fromDDL(wire):
        if field.name in wanted:
            inner = wanted[field.name]
            kind = field.dataType if "" in inner else T.StructType([f for f in field.dataType if f.name in inner])
            kept.append(T.StructField(field.name, kind))
    return T.StructType(kept)


def _bronze(raw: DataFrame, wire: str, fields: dict[str, str], columns: Iterable[str] | None, keep: Iterable[str]) -> DataFrame:
    needed = set(fields if columns is None else columns)
    kinds = dict(leaf_types(T.StructType.fromDDL(wire)))
    parsed = decode(raw, pruned(wire, (source for name, source in fields.items() if name in needed)), keep=keep)

    def column(name: str, source: str) -> Column:
        if name not in needed:
            return F.lit(None).cast("timestamp" if name == "timestamp" else kinds[source])
        return parse_event_time(source) if name == "timestamp" else F.col(source)

    return parsed.select(*(column(name, source).alias(name) for name, source in fields.items()), *keep)


def leaf_types(wire: T.StructType, prefix: str = "") -> Iterator[tuple[str, T.DataType]]:
    for field in wire:
        if isinstance(field.dataType, T.StructType):
            yield from leaf_types(field.dataType, f"{prefix}{field.name}.")
        else:
            yield prefix + field.name, field.dataType


def machine_bronze(raw: DataFrame, columns: Iterable[str] | None = None, keep: Iterable[str] = ()) -> DataFrame:
    """Machine events with the sensor blocks flattened; columns other than ``columns`` are null and not parsed, ``keep`` of ``raw`` stay."""
    return _bronze(raw, MACHINE_WIRE, MACHINE_BRONZE_FIELDS, columns, keep)


def worker_bronze(raw: DataFrame, columns: Iterable[str] | None = None, keep: Iterable[str] = ()) -> DataFrame:
    """Worker events; ``columns`` and ``keep`` as above."""
    return _bronze(raw, WORKER_WIRE, WORKER_BRONZE_FIELDS, columns, keep)
