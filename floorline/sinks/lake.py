"""Parquet lake with a commit log: ``<root>/<layer>/<table>/event_date=.../query_id=.../batch_id=...``.

The day is outermost.  A batch stages its files in folders of its own and then
commits their names to the table's log (``commits.py``); readers take the names from
the log and list no folders.  A batch that died before its commit is invisible and its
replay overwrites what it left; a batch that is committed is not written again.
``compact`` rewrites closed days into few files in one commit.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from floorline.contracts import GOLD_KEYS, LAYERS
from floorline.operators.contract import require_columns
from floorline.operators.revisions import latest_revision
from floorline.plans.layers import build_layer
from floorline.sinks.batch import Batch
from floorline.sinks.commits import CommitLog, File
from floorline.streaming.datasets import Dataset, lake_path

DAY, BATCH, REVISION = "event_date", ("query_id", "batch_id"), "revision"
COMPACTION = "compaction-"


def stage(rows: DataFrame, log: CommitLog, batch: Batch) -> list[File]:
    """Write a batch's rows, which have the day, to its folders; its files, none of which are part of the table yet."""
    days = Observation()
    placed = rows.withColumns({"query_id": F.lit(batch.query_id), "batch_id": F.lit(batch.batch_id).cast("long")})
    # Without rebalancing every task writes a file per day; it brings a day together but still splits days too large for one task.
    placed.observe(days, F.collect_set(F.col(DAY).cast("string")).alias("seen")).hint("rebalance", DAY).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(DAY, *BATCH).parquet(log.folder.path)
    try:
        # Only the folders of days that the batch has are looked into, however many the table has.
        seen = days.get["seen"]
    except Py4JJavaError:
        # Nothing is observed where the optimizer saw that there are no rows.
        seen = [name.partition("=")[2] for name in log.folder.names() if name.startswith(f"{DAY}=")]
    return [File(path, day, size) for day in sorted(seen)
            for path, size, _ in log.folder.files(f"{DAY}={day}/query_id={batch.query_id}/batch_id={batch.batch_id}")]


@dataclass(frozen=True)
class LakeSink:
    root: str
    logs: dict[str, CommitLog] = field(default_factory=dict, repr=False, compare=False)

    def log(self, spark: SparkSession, target: str) -> CommitLog:
        """A table's log, read once; later batches remember what they have committed."""
        if target not in self.logs:
            self.logs[target] = CommitLog(spark, f"{self.root}/{target}")
        return self.logs[target]

    def write(self, rows: DataFrame, dataset: Dataset, batch: Batch) -> None:
        chosen = require_columns(rows, dataset.columns, dataset.name)
        log = self.log(rows.sparkSession, dataset.target)
        if log.holds(batch):
            return
        if DAY not in chosen.columns:
            # Rows without a time belong to the day they arrived on.
            day = F.to_date("window_start" if dataset.layer == "gold" else "timestamp")
            chosen = chosen.withColumn(DAY, F.coalesce(day, F.current_date()))
        while True:
            version = log.latest + 1
            # A window's newest revision is that of the latest commit, whatever the clocks of the hosts say.
            own = chosen.withColumn(REVISION, F.lit(version).cast("long")) if dataset.layer == "gold" else chosen
            if log.commit(version, batch, stage(own, log, batch)):
                return
            log.refresh()


def stored_schema(spark: SparkSession, domain: str, layer: str) -> T.StructType:
    """Columns of a layer's files and folders, from the layer's own types."""
    empty = spark.createDataFrame([], "value BINARY")
    fields = [T.StructField(f.name, f.dataType) for f in build_layer(empty, domain, layer).schema if f.name != DAY]
    if layer == "gold":
        fields.append(T.StructField(REVISION, T.LongType()))
    return T.StructType([*fields, T.StructField(DAY, T.DateType()), T.StructField("query_id", T.StringType()),
                         T.StructField("batch_id", T.LongType())])


def read_files(spark: SparkSession, folder: str, paths: list[str], schema: T.StructType) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", folder).parquet(*(f"{folder}/{path}" for path in paths))


def read_lake(spark: SparkSession, root: str, domain: str, layer: str, revisions: bool = False, version: int | None = None,
              since: date | None = None, until: date | None = None, target: str | None = None,
              extra: Sequence[T.StructField] = ()) -> DataFrame:
    """A stored layer in layer column order, gold as it is now: the newest revision of each window.

    It is a snapshot: of the newest commit or, with ``version``, of that one, while
    others write or compact.  ``since`` and ``until`` (excluded) leave out the files of other
    days, and ``target`` is another table with the layer's columns and the ``extra`` ones.  ``revisions`` gives all that is stored, with query id, batch id and, for
    gold, ``revision``; a compacted day has the ids of its compaction.  Types are
    declared, so no footers are read for them and a layer that holds nothing yet has no rows.
    """
    log = CommitLog(spark, f"{root}/{target or lake_path(domain, layer)}")
    files = log.active(version)
    if since is not None:
        files = files.where(F.col("day") >= F.lit(since))
    if until is not None:
        files = files.where(F.col("day") < F.lit(until))
    paths = [row.path for row in files.select("path").collect()]  # names of files, as a listing would give
    schema = stored_schema(spark, domain, layer)
    stored = read_files(spark, log.folder.path, paths, T.StructType([*extra, *schema]))
    columns = [*LAYERS[domain, layer], *(column.name for column in extra)]
    if revisions:
        return stored.select(*columns, *BATCH, *([REVISION] if layer == "gold" else []))
    if layer == "gold":
        stored = latest_revision(stored, GOLD_KEYS[domain], REVISION)
    return stored.select(*columns)


def compact(spark: SparkSession, root: str, domain: str, layer: str, before: date, keep_revisions: bool = False) -> int | None:
    """Rewrite the days before ``before`` that batches have written to since they were last compacted; the commit's version.

    All days are rewritten in one job and change in one commit, so a reader sees
    all of it or nothing; batches may be committed meanwhile.  Of gold only the newest revision of
    each window is kept unless asked otherwise.  Without such days, or if another
    compaction was faster, nothing changes and the result is None; doing it again is therefore safe.
    """
    log = CommitLog(spark, f"{root}/{lake_path(domain, layer)}")
    files = [row for row in log.active().where(F.col("day") < F.lit(before)).collect()]
    fresh = {row.day for row in files if not row.query_id.startswith(COMPACTION)}
    old = [row.path for row in files if row.day in fresh]
    if not old:
        return None
    rows = read_files(spark, log.folder.path, old, stored_schema(spark, domain, layer)).drop(*BATCH)
    if layer == "gold" and not keep_revisions:
        rows = latest_revision(rows, GOLD_KEYS[domain], REVISION)
    batch = Batch(f"{COMPACTION}{uuid.uuid4().hex}", 0)
    staged = stage(rows, log, batch)
    while not log.commit(log.latest + 1, batch, staged, old, done=False):
        log.refresh()
        if log.active().where(F.col("path").isin(old[:1])).isEmpty():
            return None
    log.checkpoint()
    return log.latest


def vacuum(spark: SparkSession, root: str, domain: str, layer: str, older_than: float) -> list[str]:
    """Delete files that are not part of the newest version and were last changed more than ``older_than`` seconds ago; their names.

    The time must exceed that of any running batch, compaction or reader.  Older versions can no longer be read.
    """
    log = CommitLog(spark, f"{root}/{lake_path(domain, layer)}")
    kept = {row.path for row in log.active().select("path").collect()}
    limit = time.time() * 1000 - older_than * 1000
    gone = [path for path, _, changed in log.folder.files() if re.match(rf"{DAY}=", path) and path not in kept and changed < limit]
    for path in gone:
        log.folder.delete(path)
    return gone
