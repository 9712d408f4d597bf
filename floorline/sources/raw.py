"""Raw sources: message topics and files, as batches and as streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_stream(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, object] | None = None,
    schema: StructType | str | None = None,
    path: str | None = None,
) -> DataFrame:
    """A stream with a ``value`` payload column.

    ``kafka`` brings its own schema; file formats need ``schema`` and ``path``.
    The ``text`` format needs only a path: one JSON document per line.
    """
    reader = spark.readStream.format(fmt).options(**{k: str(v) for k, v in (options or {}).items()})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def topic_options(servers: str, topic: str, starting_offsets: str = "latest") -> dict[str, str]:
    """Options of a message-topic source."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }


def read_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Stream of a message topic, from the latest offset on unless told otherwise."""
    return read_stream(spark, "kafka", {**topic_options(servers, topic), **options})

