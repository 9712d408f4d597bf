"""The commit log of a lake table: which files are the table, version by version.

``_log/<version>.json`` says what a commit adds and removes, one action a line, and
is created whole or not at all, so a version has one author.  Files that no commit
names are not part of the table, whether a writer died or is still at work.  A
checkpoint is the state at a version, written by Spark; a reader takes the newest one
and the few commits behind it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floorline.sinks.batch import Batch
from floorline.sinks.files import Folder

LOG, CHECKPOINTS = "_log", "_checkpoints"
ACTIONS = "version BIGINT, action STRING, path STRING, day DATE, bytes BIGINT, query_id STRING, batch_id BIGINT"
ADD, REMOVE, BATCH = "add", "remove", "batch"
# Commits after which a writer leaves a checkpoint.
CHECKPOINT_EVERY = 200


class File(NamedTuple):
    """A data file: its name below the table, its day and size."""

    path: str
    day: str
    bytes: int


class CommitLog:
    """Versions of the table at ``path``; the first is 1, and 0 is the empty table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, Folder(spark, path)
        self.latest, self.batches = 0, {}
        self.refresh()

    def _names(self, suffix: str) -> Iterator[tuple[int, str]]:
        for name in self.folder.names(LOG):
            if name.endswith(suffix) and not name.startswith("."):
                yield int(name[:-len(suffix)]), name

    def refresh(self) -> None:
        """See what others have committed; the newest version and each query's last batch are kept in memory."""
        self.latest = max((version for version, _ in self._names(".json")), default=0)
        done = self.actions().where(F.col("action") == BATCH).groupBy("query_id").agg(F.max("batch_id").alias("last"))
        self.batches = {row.query_id: row["last"] for row in done.collect()} if self.latest else {}

    def holds(self, batch: Batch) -> bool:
        """Whether a batch is committed; a query commits its batches in order."""
        return self.batches.get(batch.query_id, -1) >= batch.batch_id

    def actions(self, version: int | None = None) -> DataFrame:
        """What led to a version, from the checkpoint before it on."""
        upto = self.latest if version is None else version
        base = max(((v, name) for v, name in self._names(".checkpoint") if v <= upto), default=(0, None))
        names = [f"{self.folder.path}/{LOG}/{name}" for v, name in self._names(".json") if base[0] < v <= upto]
        found = self.spark.read.schema(ACTIONS).json(names) if names else self.spark.createDataFrame([], ACTIONS)
        if base[1]:
            pointer = self.spark.read.text(f"{self.folder.path}/{LOG}/{base[1]}").first().value
            found = found.unionByName(self.spark.read.schema(ACTIONS).parquet(f"{self.folder.path}/{CHECKPOINTS}/{pointer}"))
        return found

    def active(self, version: int | None = None) -> DataFrame:
        """The files of a version; a file is added once and removed at most once."""
        actions = self.actions(version)
        removed = actions.where(F.col("action") == REMOVE).select("path")
        return actions.where(F.col("action") == ADD).join(removed, "path", "left_anti").select("path", "day", "bytes", "query_id", "batch_id")

    def commit(self, version: int, by: Batch, add: Iterable[File] = (), remove: Iterable[str] = (), done: bool = True) -> bool:
        """Make ``version``; False if another writer has made it.  ``done`` says that the batch is not to be written again."""
        lines = [{"action": ADD, **file._asdict(), **by._asdict()} for file in add] + [{"action": REMOVE, "path": path} for path in remove]
        if done:
            lines.append({"action": BATCH, **by._asdict()})
        if not self.folder.create(f"{LOG}/{version:020}.json", "\n".join(json.dumps({"version": version, **line}) for line in lines)):
            return False
        self.latest = version
        if done:
            self.batches[by.query_id] = by.batch_id
        if version % CHECKPOINT_EVERY == 0:
            self.checkpoint()
        return True

    def checkpoint(self) -> None:
        """Leave the state of the newest version for readers; doing it again changes nothing."""
        version, name = self.latest, uuid.uuid4().hex
        actions = self.actions(version)
        last = actions.where(F.col("action") == BATCH).groupBy("query_id").agg(F.max("batch_id").alias("batch_id"))
        state = self.active(version).withColumn("action", F.lit(ADD)).unionByName(last.withColumn("action", F.lit(BATCH)), allowMissingColumns=True)
        state.withColumn("version", F.lit(version)).write.parquet(f"{self.folder.path}/{CHECKPOINTS}/{name}")
        self.folder.create(f"{LOG}/{version:020}.checkpoint", name)
