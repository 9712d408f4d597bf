"""Search documents as bulk files, for loaders that read them from a shared folder.

A Spark data source, ``bulk_documents``, writes them: each task writes a file of
``action`` and ``source`` lines and reports its name, and the driver commits the names
of all tasks in one small file per batch.  Files of tasks that failed or ran twice are
in no such file and therefore not part of the folder's content.  A document's id
follows from its batch and content, or from its key in gold, so loading a batch
again replaces its documents and adds none.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from floorline.contracts import GOLD_KEYS, SEARCH_INDEXES
from floorline.operators.contract import require_columns
from floorline.sinks.batch import Batch
from floorline.streaming.datasets import Dataset

FORMAT, ID, DOCUMENT = "bulk_documents", "id", "document"
DATA, BATCHES, ENDING = "data", "batches", ".ndjson"
# What separates a document from the next: a line that begins an action.
ACTION = '{"index":'


def opened(path: str):
    """File system and name for a path as Spark gives it; imported where files are written, in tasks and by the committer."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    name: str
    documents: int


class BulkWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.folder, self.batch = options["path"].rstrip("/"), options["batch"]
        # The action without its id, which is a hash and needs no escaping.
        self.action = json.dumps({"index": {"_index": options["index"], "_id": ""}}, separators=(",", ":"))[:-len('"}}')].encode()

    def write(self, iterator) -> Written:
        system, base = opened(self.folder)
        system.create_dir(f"{base}/{DATA}", recursive=True)
        name, documents = f"{DATA}/{uuid.uuid4().hex}{ENDING}", 0
        with system.open_output_stream(f"{base}/{name}", compression=None) as out:
            for batch in iterator:
                for key, document in zip(batch[ID].to_pylist(), batch[DOCUMENT].to_pylist()):
                    out.write(b'%b%b"}}\n%b\n' % (self.action, key.encode(), document.encode()))
                documents += batch.num_rows
        return Written(name, documents)

    def commit(self, messages: Sequence[Written | None]) -> None:
        system, base = opened(self.folder)
        system.create_dir(f"{base}/{BATCHES}", recursive=True)
        lines = "\n".join(json.dumps({"file": m.name, "documents": m.documents}) for m in messages if m and m.documents)
        draft = f"{base}/{BATCHES}/.{uuid.uuid4().hex}"
        with system.open_output_stream(draft, compression=None) as out:
            out.write(lines.encode())
        # One name per batch: a batch that is written again takes the place of what it was.
        system.move(draft, f"{base}/{BATCHES}/{self.batch}.json")

    def abort(self, messages: Sequence[Written | None]) -> None:
        system, base = opened(self.folder)
        for message in filter(None, messages):
            system.delete_file(f"{base}/{message.name}")


class BulkDocuments(DataSource):
    """``df.write.format("bulk_documents")`` with options ``path``, ``index`` and ``batch``; columns ``id`` and ``document``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return f"{ID} STRING, {DOCUMENT} STRING"

    def writer(self, schema, overwrite: bool) -> BulkWriter:
        return BulkWriter(dict(self.options))


def documents(rows: DataFrame, key: Sequence[str] = (), batch: Batch | None = None) -> DataFrame:
    """``id`` and ``document`` (JSON) of each row.

    With ``key`` the id follows from these columns alone, so a newer document of the
    key replaces it.  Otherwise it follows from the batch, the document and, where a batch has
    equal ones, their number; they are counted, so only equal documents meet.
    """
    whole = F.to_json(F.struct(*rows.columns))

    def hashed(*parts: Column) -> Column:
        return F.sha2(F.to_json(F.struct(*parts)).cast("binary"), 256).alias(ID)

    if key:
        return rows.select(hashed(*map(F.col, key)), whole.alias(DOCUMENT))
    equal = rows.select(whole.alias(DOCUMENT)).groupBy(DOCUMENT).agg(F.count("*").alias("times"))
    each = equal.select(DOCUMENT, F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("number"))
    return each.select(hashed(F.lit(batch.query_id).alias("q"), F.lit(batch.batch_id).alias("b"), F.col(DOCUMENT), F.col("number")), DOCUMENT)


@dataclass(frozen=True)
class BulkSink:
    """The search datasets as bulk files below ``root/<index>``."""

    root: str

    def write(self, rows: DataFrame, dataset: Dataset, batch: Batch) -> None:
        spark = rows.sparkSession
        spark.dataSource.register(BulkDocuments)
        # Spark looks the format up in the active session, which a thread that writes a part of a batch has not; building a DataFrame sets it.
        spark.createDataFrame([], "x INT")
        chosen = require_columns(rows, SEARCH_INDEXES[dataset.target], dataset.name)
        key = GOLD_KEYS[dataset.domain] if dataset.layer == "gold" else ()
        documents(chosen, key, batch).write.format(FORMAT).mode("append").options(
            path=f"{self.root}/{dataset.target}", index=dataset.target, batch=f"{batch.query_id}-{batch.batch_id:012}").save()


def read_bulk(spark: SparkSession, root: str, index: str) -> DataFrame:
    """``batch``, ``id`` and ``document`` of all committed batches; ``batch`` is the name a batch was committed under."""
    listed = spark.read.schema("file STRING, documents BIGINT").json(f"{root}/{index}/{BATCHES}").select(
        F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1).alias("batch"), "file")
    files = listed.collect()  # names of files, as a listing would give
    if not files:
        return spark.createDataFrame([], f"batch STRING, {ID} STRING, {DOCUMENT} STRING")
    # A record begins with an action; lines of JSON hold no line ends of their own.
    text = spark.read.option("lineSep", f"\n{ACTION}").text([f"{root}/{index}/{row.file}" for row in files])
    parts = text.select(F.regexp_extract(F.input_file_name(), rf"({DATA}/[^/]+)$", 1).alias("from"),
                        F.regexp_extract("value", r'"_id":"([^"]+)"', 1).alias(ID), F.substring_index("value", "\n", 2).alias("both"))
    each = parts.select("from", ID, F.substring_index("both", "\n", -1).alias(DOCUMENT))
    return each.join(listed, F.col("from") == F.col("file")).select("batch", ID, DOCUMENT)


def loaded(documents_: DataFrame) -> DataFrame:
    """The documents an index holds after loading all batches in the order of their names: the last of each id."""
    return documents_.groupBy(ID).agg(F.max_by(DOCUMENT, "batch").alias(DOCUMENT))
