"""The registered queries: every operator over the whole event log of a folder.

Each query derives payloads from ``events``, runs them through the library and
shapes the result for comparison (``comparable``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.event_log import PAYLOADS
from checks.streams import LATENESS, dealt, run_closing, run_counted, run_slices
from floorline.contracts import MACHINE_SILVER, RELATIONAL_TABLES, SEARCH_INDEXES
from floorline.functions.text import to_json_value
from floorline.operators.enrich import machine_columns, worker_columns
from floorline.operators.partials import gold_from_parts, gold_parts, merge_parts
from floorline.operators.quality import RULES, valid
from floorline.operators.sketches import rank_error, reading_sketches, sketched_series
from floorline.plans import layers
from floorline.plans.dashboards import PANELS, panel
from floorline.plans.layouts import relational_layout, search_layout
from floorline.plans.views import VIEWS, local_time_view
from floorline.session import pin_clock
from floorline.sinks.batch import Batch
from floorline.sinks.bulk import BulkSink, loaded, read_bulk
from floorline.sinks.lake import LakeSink, compact, read_lake
from floorline.streaming.closing import CLOSED, LATE, OUTPUTS
from floorline.streaming.datasets import DATASETS, dataset
from floorline.streaming.open_bronze import field_at, open_bronze, read_open, unknown_fields, write_open
from floorline.streaming.workspace import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

# query -> (domain, computed column); the column's inputs are shown beside it.
COMPUTED_COLUMNS = {
    "machine_temperature_status": ("machine", ["temperature_status"], ["temperature"]),
    "machine_vibration_status": ("machine", ["vibration_status"], ["vibration"]),
    "machine_fault_flag": ("machine", ["fault_flag"], ["is_fault"]),
    "machine_event_date_hour": ("machine", ["event_date", "event_hour"], ["timestamp"]),
    "machine_health_score": ("machine", ["health_score"], ["is_fault", "temperature", "vibration"]),
    "machine_risk_score": ("machine", ["risk_score"], ["temperature", "vibration"]),
    "machine_running_flag": ("machine", ["running_flag"], ["status"]),
    "machine_fault_category": ("machine", ["fault_category"], ["error_code"]),
    "machine_power_status": ("machine", ["power_status"], ["power_kw"]),
    "machine_time_bucket": ("machine", ["time_bucket"], ["timestamp"]),
    "machine_anomaly_flag": ("machine", ["anomaly_flag"], ["temperature"]),
    "worker_safety_violation": ("worker", ["safety_violation_flag"], ["helmet_on", "safety_vest_on"]),
    "worker_fatigue_status": ("worker", ["fatigue_status"], ["fatigue_score"]),
    "worker_risk_level": ("worker", ["worker_risk_level"], ["danger_zone", "fatigue_score"]),
    "worker_alert_level": (
        "worker", ["alert_level"], ["danger_zone", "fatigue_score", "helmet_on", "safety_vest_on"],
    ),
    "worker_heart_rate_status": ("worker", ["heart_rate_status"], ["heart_rate"]),
}
IDENTITY = {"machine": ["event_id"], "worker": ["worker_id", "timestamp"]}


def comparable(rows: DataFrame) -> DataFrame:
    """Instants as UTC date-times, doubles to seven places."""
    shaped = {"timestamp": lambda c: c.cast("timestamp_ntz"), "double": lambda c: F.round(c, 7)}
    return rows.select(
        *(shaped.get(dtype, lambda c: c)(F.col(name)).alias(name) for name, dtype in rows.dtypes)
    )


def events_of(spark: SparkSession, folder: str) -> DataFrame:
    return pin_clock(spark).read.parquet(f"{folder}/events.parquet")


def raw_of(spark: SparkSession, folder: str, domain: str) -> DataFrame:
    return PAYLOADS[domain](events_of(spark, folder))


def layer_of(spark: SparkSession, folder: str, domain: str, layer: str, columns: Iterable[str] | None = None) -> DataFrame:
    return layers.build_layer(raw_of(spark, folder, domain), domain, layer, columns=columns)


def _layer(domain: str, layer: str) -> Query:
    return lambda spark, folder: comparable(layer_of(spark, folder, domain, layer))


def _valid(domain: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(valid(layer_of(spark, folder, domain, "bronze"), RULES[domain]))

    return query


def _unrouted(domain: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(layers.unrouted_rows(layer_of(spark, folder, domain, "bronze"), domain))

    return query


def _computed(domain: str, names: list[str], inputs: list[str]) -> Query:
    columns = {"machine": machine_columns, "worker": worker_columns}[domain]

    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = valid(layer_of(spark, folder, domain, "bronze", [*IDENTITY[domain], *inputs]), RULES[domain])
        shown = [name for name in IDENTITY[domain] + inputs if name not in names]
        computed = columns()
        return comparable(
            rows.select(*dict.fromkeys(shown), *(computed[name].alias(name) for name in names))
        )

    return query


def _stored_layer(target: str) -> tuple[str, str]:
    return next((d.domain, d.layer) for d in DATASETS if d.target == target)


def _relational(table: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(relational_layout(layer_of(spark, folder, *_stored_layer(table)), table))

    return query


def _search(index: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(search_layout(layer_of(spark, folder, *_stored_layer(index)), index))

    return query


def _view(view: str) -> Query:
    table = VIEWS[view][0]

    def query(spark: SparkSession, folder: str) -> DataFrame:
        stored = relational_layout(layer_of(spark, folder, *_stored_layer(table)), table)
        return comparable(local_time_view(stored, view))

    return query


def _panel(name: str) -> Query:
    domain, layer, _, reading = PANELS[name]
    columns = None if layer == "gold" else [reading]
    return lambda spark, folder: comparable(panel(layer_of(spark, folder, domain, layer, columns), name))


def machine_silver_json(spark: SparkSession, folder: str) -> DataFrame:
    """Silver as JSON documents, read back field by field."""
    silver = layer_of(spark, folder, "machine", "silver")
    texts = ("timestamp", "event_date")
    types = ", ".join(
        f"{name} {'STRING' if name in texts else dtype}" for name, dtype in silver.dtypes
    )
    documents = to_json_value(silver)
    return comparable(
        documents.select(
            F.size(F.json_object_keys("value")).alias("n_fields"),
            F.from_json("value", types).alias("document"),
        ).select("n_fields", *(f"document.{name}" for name in MACHINE_SILVER))
    )


def _stream_gold(domain: str, late: bool = False) -> Query:
    """Gold kept up to date by a stream, newest revision of each window."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        delay = LATENESS if late else None
        root = run_slices(spark, events_of(spark, folder), domain, {"gold"}, delay)
        return comparable(read_lake(spark, root, domain, "gold"))

    return query


def _stream_layer(domain: str, layer: str) -> Query:
    """A stateless layer written by a stream and read back from the lake."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        root = run_slices(spark, events_of(spark, folder), domain, {"bronze", "silver"})
        return comparable(read_lake(spark, root, domain, layer))

    return query


def stream_domain_gold_view(spark: SparkSession, folder: str) -> DataFrame:
    """Both queries of a domain side by side; the stored gold changelog, its newest revisions, and the view over them."""
    root = run_slices(spark, events_of(spark, folder), "worker", {"bronze", "silver", "gold"})
    stored = relational_layout(read_lake(spark, root, "worker", "gold"), "worker_safety_gold")
    return comparable(local_time_view(stored, "worker_safety_gold_view"))


def stream_gold_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Median panel over gold as a stream has stored it."""
    root = run_slices(spark, events_of(spark, folder), "machine", {"gold"})
    return comparable(panel(read_lake(spark, root, "machine", "gold"), "median_vibration"))


def parquet_sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Machine bronze through the lake sink in batches, the last one written twice."""
    events = events_of(spark, folder)
    root = shared_folder(spark, "lake")
    target, sink = dataset("machine_bronze_lake"), LakeSink(root)
    parts = list(enumerate(dealt(events, 3)))
    for batch_id, part in [*parts, parts[-1]]:
        bronze = layers.bronze_layer(PAYLOADS["machine"](part), "machine")
        sink.write(bronze, target, Batch("roundtrip", batch_id))
    return comparable(read_lake(spark, root, "machine", "bronze"))


def last_day(rows: DataFrame, ts: str):
    """The day of the newest row; the days before it are closed."""
    return rows.agg(F.to_date(F.max(ts)).alias("day")).first().day


def lake_compaction_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Machine bronze in batches, closed days compacted in between and afterwards, then read."""
    events = events_of(spark, folder)
    root = shared_folder(spark, "lake")
    target, sink = dataset("machine_bronze_lake"), LakeSink(root)
    closed = last_day(events, "ts")
    for batch_id, part in enumerate(dealt(events, 3)):
        sink.write(layers.bronze_layer(PAYLOADS["machine"](part), "machine"), target, Batch("compacted", batch_id))
        if batch_id and closed:
            compact(spark, root, "machine", "bronze", closed)
    return comparable(read_lake(spark, root, "machine", "bronze"))


def lake_compacted_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Worker gold as a stream's changelog, all days compacted: every stored revision is then a window's newest."""
    root = run_slices(spark, events_of(spark, folder), "worker", {"gold"})
    newest = last_day(read_lake(spark, root, "worker", "gold"), "window_start")
    if newest:
        compact(spark, root, "worker", "gold", newest + timedelta(days=1))
    return comparable(read_lake(spark, root, "worker", "gold", revisions=True).drop("query_id", "batch_id", "revision"))


def _closing(kind: str, layer: str) -> Query:
    """What the closing stream of the late-data events has stored: each closed window once, or the events that came too late."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        root = run_closing(spark, events_of(spark, folder), "machine", LATENESS)
        stored = read_lake(spark, root, "machine", layer, revisions=True, target=OUTPUTS["machine"][kind].target)
        return comparable(stored.drop("query_id", "batch_id", "revision"))

    return query


def machine_unknown_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Fields that bronze has no column for, found in stored payloads and read by their paths, beside a typed column."""
    root = shared_folder(spark, "lake")
    sink = LakeSink(root)
    for batch_id, part in enumerate(dealt(events_of(spark, folder), 2)):
        write_open(open_bronze(PAYLOADS["machine"](part), "machine"), "machine", sink, Batch("payloads", batch_id))
    stored = read_open(spark, root, "machine")
    found = sorted(unknown_fields(stored, "machine").items())
    return comparable(stored.select("event_id", "flow_rate", "unread", *(field_at(path, kind).alias(path.replace(".", "_")) for path, kind in found)))


def _bulk(index: str) -> Query:
    """An index's documents as bulk files in batches, one of them written twice, and what an index holds after loading them."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        root, target = shared_folder(spark, "bulk"), next(d for d in DATASETS if d.target == index)
        sink, parts = BulkSink(root), list(enumerate(dealt(events_of(spark, folder), 3)))
        for batch_id, part in [*parts, parts[1 % len(parts)]]:
            rows = layers.build_layer(PAYLOADS[target.domain](part), target.domain, target.layer)
            sink.write(rows, target, Batch("bulk", batch_id))
        kinds = {name: "STRING" if kind in ("timestamp", "date") else kind for name, kind in layer_of(spark, folder, target.domain, target.layer).dtypes}
        types = ", ".join(f"{name} {kinds[name]}" for name in SEARCH_INDEXES[index])
        found = loaded(read_bulk(spark, root, index)).select(F.from_json("document", types).alias("d")).select("d.*")
        return comparable(search_layout(found, index))

    return query


def _outcomes(domain: str) -> Query:
    """Rows per outcome of the rules, as the stream has counted them while it wrote."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        totals = run_counted(spark, events_of(spark, folder), domain).totals()
        return spark.createDataFrame(sorted(totals.items()), "outcome STRING, n BIGINT")

    return query


def _sketched_panel(name: str) -> Query:
    """A panel by day from stored hourly sketches per unit: readings behind each estimate, and whether its rank is within two sketch errors."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        domain, layer, ts, reading = PANELS[name]
        unit = {"machine": "machine_id", "worker": "worker_id"}[domain]
        rows, stored = layer_of(spark, folder, domain, layer, [reading]), shared_folder(spark, "sketches")
        reading_sketches(rows, ts, reading, "1 hour", [unit]).write.parquet(stored)
        daily = sketched_series(spark.read.parquet(stored), "1 day", fill_empty=False)
        return comparable(rank_error(daily, rows, ts, reading, "1 day").select("bucket", "readings", (F.col("error") <= 0.0266).alias("close")))

    return query


def _merged_gold(domain: str) -> Query:
    """Gold from stored parts: those of three slices of the log, written one by one and merged."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        parts = shared_folder(spark, f"{domain}-parts")
        for part in dealt(events_of(spark, folder), 3):
            silver = layers.silver_layer(layers.bronze_layer(PAYLOADS[domain](part), domain, layers.GOLD_INPUTS[domain]), domain)
            gold_parts(silver, domain).write.mode("append").parquet(parts)
        return comparable(gold_from_parts(merge_parts(spark.read.parquet(parts), domain), domain))

    return query


def registered() -> dict[str, Query]:
    return {
        "machine_decode_bronze": _layer("machine", "bronze"),
        "worker_decode_bronze": _layer("worker", "bronze"),
        "machine_quarantine": _layer("machine", "quarantine"),
        "worker_quarantine": _layer("worker", "quarantine"),
        "machine_valid": _valid("machine"),
        "worker_valid": _valid("worker"),
        "machine_unrouted": _unrouted("machine"),
        "worker_unrouted": _unrouted("worker"),
        **{name: _computed(*spec) for name, spec in COMPUTED_COLUMNS.items()},
        "machine_silver": _layer("machine", "silver"),
        "worker_silver": _layer("worker", "silver"),
        "machine_gold": _layer("machine", "gold"),
        "worker_gold": _layer("worker", "gold"),
        "machine_silver_json": machine_silver_json,
        **{f"relational_{table}": _relational(table) for table in RELATIONAL_TABLES},
        **{f"{index.replace('-', '_')}_index": _search(index) for index in SEARCH_INDEXES},
        **{view: _view(view) for view in VIEWS},
        **{name: _panel(name) for name in PANELS},
        "stream_machine_gold_update": _stream_gold("machine"),
        "stream_worker_gold_update": _stream_gold("worker"),
        "stream_late_data": _stream_gold("machine", late=True),
        "stream_silver_append": _stream_layer("machine", "silver"),
        "stream_bronze_append": _stream_layer("worker", "bronze"),
        "stream_worker_silver_append": _stream_layer("worker", "silver"),
        "stream_domain_gold_view": stream_domain_gold_view,
        "stream_gold_panel": stream_gold_panel,
        "parquet_sink_roundtrip": parquet_sink_roundtrip,
        "lake_compaction_roundtrip": lake_compaction_roundtrip,
        "lake_compacted_gold": lake_compacted_gold,
        "stream_closed_windows": _closing(CLOSED, "gold"),
        "stream_late_events": _closing(LATE, "silver"),
        "stream_machine_outcomes": _outcomes("machine"),
        "stream_worker_outcomes": _outcomes("worker"),
        "machine_events_bulk": _bulk("machine-events"),
        "worker_events_bulk": _bulk("worker-events"),
        "machine_unknown_fields": machine_unknown_fields,
        "sketched_temperature": _sketched_panel("median_temperature"),
        "sketched_heart_rate": _sketched_panel("median_heart_rate"),
        "machine_gold_merged": _merged_gold("machine"),
        "worker_gold_merged": _merged_gold("worker"),
    }
