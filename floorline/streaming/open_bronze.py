"""Bronze with whole payloads: fields that bronze has no column for are kept.

Beside the typed columns, which take their pick of the wire format, a row has its payload as a VARIANT, so a field that
producers add is stored from the first event on and can be read by its path before
anybody has declared it.  Files hold the fields that most payloads share as columns of
their own (shredded), so reading one path need not read the payloads.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from floorline.contracts import LAYERS, MACHINE_BRONZE_FIELDS, WORKER_BRONZE_FIELDS
from floorline.plans.layers import BRONZE
from floorline.sinks.batch import Batch, current_batch
from floorline.sinks.lake import LakeSink, read_lake
from floorline.streaming.datasets import Dataset
from floorline.streaming.pipelines import start_query

PAYLOAD, UNREAD = "payload", "unread"
EXTRA = (T.StructField(PAYLOAD, T.VariantType()), T.StructField(UNREAD, T.StringType()))
FIELDS = {"machine": MACHINE_BRONZE_FIELDS, "worker": WORKER_BRONZE_FIELDS}
SHREDDING = ("spark.sql.variant.writeShredding.enabled", "spark.sql.variant.inferShreddingSchema")


class OpenDataset(Dataset):
    """Bronze columns, the payload, and the text of what is none."""

    @property
    def columns(self) -> tuple[str, ...]:
        return (*LAYERS[self.domain, self.layer], PAYLOAD, UNREAD)


TABLES = {domain: OpenDataset(domain, "bronze", "lake", f"bronze/{domain}_payload_data", None) for domain in FIELDS}


def open_bronze(raw: DataFrame, domain: str) -> DataFrame:
    """Bronze and ``payload``, a JSON object; what is none is kept as the text ``unread``, so that it does not widen the objects' schema."""
    text = F.col("value").cast("string")
    kept = raw.select("value", F.when(F.ltrim(text).startswith("{"), F.try_parse_json(text)).alias(PAYLOAD), text.alias("text"))
    kept = kept.withColumn(UNREAD, F.when(F.col(PAYLOAD).isNull(), F.col("text")))
    return BRONZE[domain](kept, None, keep=(PAYLOAD, UNREAD))


def write_open(rows: DataFrame, domain: str, sink: LakeSink, batch: Batch) -> None:
    """Store open bronze, shredded."""
    for setting in SHREDDING:
        rows.sparkSession.conf.set(setting, "true")
    sink.write(rows, TABLES[domain], batch)


def read_open(spark: SparkSession, root: str, domain: str, **options) -> DataFrame:
    """Stored open bronze; ``options`` as for ``read_lake``."""
    return read_lake(spark, root, domain, "bronze", target=TABLES[domain].target, extra=EXTRA, **options)


def start_open_bronze(raw: DataFrame, domain: str, sink: LakeSink, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
    def write(rows: DataFrame, batch_id: int) -> None:
        write_open(rows, domain, sink, current_batch(rows, batch_id))

    return start_query(raw.sparkSession, open_bronze(raw, domain).writeStream.outputMode("append").foreachBatch(write),
                       f"{domain}_open_bronze", checkpoint, trigger)


def leaves(kind: T.DataType, prefix: str = "") -> Iterator[tuple[str, str]]:
    """Paths and types of the fields that are no objects."""
    if isinstance(kind, T.StructType):
        for field in kind:
            yield from leaves(field.dataType, f"{prefix}.{field.name}" if prefix else field.name)
    elif prefix:
        # Numbers are stored as the decimals they are written as, of as many digits as the longest has.
        yield prefix, "double" if isinstance(kind, T.DecimalType) else kind.simpleString()


def unknown_fields(rows: DataFrame, domain: str) -> dict[str, str]:
    """Paths, with their types, that some payload has and bronze has no column for; one row, the merged schema, comes to the driver."""
    found = rows.agg(F.schema_of_variant_agg(PAYLOAD).alias("schema")).first().schema
    known = set(FIELDS[domain].values())
    merged = rows.sparkSession.createDataFrame([], f"payload {found.replace('OBJECT<', 'STRUCT<')}").schema[0].dataType if found else None
    return {path: kind for path, kind in leaves(merged) if path not in known} if merged is not None else {}


def field_at(path: str, kind: str) -> Column:
    """A field of the payload by its path; null where it is missing or of another type."""
    return F.try_variant_get(PAYLOAD, f"$.{path}", kind)
