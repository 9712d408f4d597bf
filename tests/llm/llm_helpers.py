"""Small tables for the tests of ``floorline.llm``."""

from __future__ import annotations

import random

import duckdb

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, *rows):
    """Documents from (id, text) pairs; ``None`` is null."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA)


def clashing(frame):
    """Further columns with the names that operators use inside."""
    from pyspark.sql import functions as F

    for name in ("id", "n", "bands", "label", "grp", "kept", "row", "tag", "at", "score", "key", "sample", "component_id", "removal"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame


def connect(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def words(seed, n, vocabulary=200):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def rows(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.select(*columns).collect()), key=repr)
