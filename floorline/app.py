"""Run the streams: ``spark-submit floorline/app.py --checkpoint ... --lake ...``.

Stores without an address are left out.  The database login comes from the
environment (``FLOORLINE_DB_USER``, ``FLOORLINE_DB_PASSWORD``), credentials of the
object store from the Spark configuration.
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence
from pathlib import Path

if __name__ == "__main__" and not __package__:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql.streaming import StreamingQuery  # noqa: E402

from floorline.session import build_session  # noqa: E402
from floorline.sinks.bulk import BulkSink  # noqa: E402
from floorline.sinks.lake import LakeSink  # noqa: E402
from floorline.sinks.relational import RelationalSink  # noqa: E402
from floorline.sinks.search import SearchSink  # noqa: E402
from floorline.sinks.topic import TopicSink  # noqa: E402
from floorline.sources.raw import read_stream, read_topic  # noqa: E402
from floorline.streaming.closing import start_closing  # noqa: E402
from floorline.streaming.datasets import DATASETS, Dataset, dataset  # noqa: E402
from floorline.streaming.pipelines import Sink, await_any, start_dataset, start_domain  # noqa: E402
from floorline.streaming.workspace import stream_session  # noqa: E402

# Source topics.
TOPICS = {"machine": "sensor-events", "worker": "worker-events"}
# Bounds of a micro-batch unless the source options say otherwise; a backlog is worked off in several.
RATES = {"kafka": {"maxOffsetsPerTrigger": "1000000"}, "text": {"maxFilesPerTrigger": "1000"}}


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--checkpoint", required=True, help="folder for checkpoints, shared by all executors")
    parser.add_argument("--servers", help="message brokers, host:port,...")
    parser.add_argument("--files", help="read JSON lines below <files>/<topic> instead of topics")
    parser.add_argument("--source-option", nargs="+", metavar="KEY=VALUE", default=[],
                        help="options of the source, e.g. maxOffsetsPerTrigger=1000000 to bound a batch")
    parser.add_argument("--domains", nargs="+", choices=list(TOPICS), default=list(TOPICS))
    parser.add_argument("--lake", help="root of the Parquet lake")
    parser.add_argument("--database", help="JDBC URL")
    parser.add_argument("--connections", type=int, default=16, help="tasks that write to the database at a time")
    parser.add_argument("--search", help="search nodes, host[:port]")
    parser.add_argument("--bulk", help="folder for search documents as bulk files, instead of --search")
    parser.add_argument("--own-cadence", action="store_true", help="datasets of different cadences do not share a query")
    parser.add_argument("--closed-windows", action="store_true", help="also store closed windows once, and late events, in the lake")
    parser.add_argument("--republish", action="store_true", help="send machine silver back to the brokers")
    parser.add_argument("--only", nargs="+", choices=[d.name for d in DATASETS],
                        help="run these datasets as queries of their own")
    parser.add_argument("--trigger", help="processing-time trigger, e.g. '2 seconds'")
    parser.add_argument("--once", action="store_true", help="take in what is there and stop")
    parser.add_argument("--state-partitions", type=int, help="partitions of the gold state, fixed per checkpoint")
    options = parser.parse_args(arguments)
    if bool(options.servers) == bool(options.files):
        parser.error("give either --servers or --files")
    if options.republish and not options.servers:
        parser.error("--republish needs --servers")
    if options.search and options.bulk:
        parser.error("give either --search or --bulk")
    if options.closed_windows and not options.lake:
        parser.error("--closed-windows needs --lake")
    stores = {"lake": options.lake, "relational": options.database, "search": options.search or options.bulk, "topic": options.republish}
    if not any(stores.values()):
        parser.error("give at least one of --lake, --database, --search, --bulk and --republish")
    for wanted in map(dataset, options.only or ()):
        if wanted.domain not in options.domains:
            parser.error(f"{wanted.name} is not of the domains {' '.join(options.domains)}")
        if not stores[wanted.store]:
            parser.error(f"{wanted.name} needs the address of its {wanted.store} store")
    if options.database and not {"FLOORLINE_DB_USER", "FLOORLINE_DB_PASSWORD"} <= os.environ.keys():
        parser.error("--database needs FLOORLINE_DB_USER and FLOORLINE_DB_PASSWORD in the environment")
    return options


def sinks(options: argparse.Namespace) -> dict[str, Sink]:
    """The sink of each store that has an address."""
    chosen: dict[str, Sink] = {}
    if options.lake:
        chosen["lake"] = LakeSink(options.lake.rstrip("/"))
    if options.database:
        chosen["relational"] = RelationalSink(
            options.database, os.environ["FLOORLINE_DB_USER"], os.environ["FLOORLINE_DB_PASSWORD"],
            connections=options.connections,
        )
    if options.search:
        host, _, port = options.search.partition(":")
        chosen["search"] = SearchSink(host, int(port or 9200))
    if options.bulk:
        chosen["search"] = BulkSink(options.bulk.rstrip("/"))
    if options.republish:
        chosen["topic"] = TopicSink(options.servers)
    return chosen


def source(session: SparkSession, options: argparse.Namespace, domain: str) -> DataFrame:
    topic = TOPICS[domain]
    extra = dict(option.split("=", 1) for option in options.source_option)
    if options.files:
        return read_stream(session, "text", {**RATES["text"], **extra}, path=f"{options.files}/{topic}")
    return read_topic(session, options.servers, topic, **{**RATES["kafka"], **extra})


def trigger(options: argparse.Namespace) -> dict[str, object] | None:
    if options.once:
        return {"availableNow": True}
    return {"processingTime": options.trigger} if options.trigger else None


def start(session: SparkSession, options: argparse.Namespace) -> list[StreamingQuery]:
    """All queries the options ask for."""
    stores = sinks(options)
    queries = []
    for domain in options.domains:
        if options.only:
            wanted: list[Dataset] = [dataset(n) for n in options.only if dataset(n).domain == domain]
            queries += [
                start_dataset(source(session, options, domain), d, stores[d.store], options.checkpoint, trigger(options))
                for d in wanted
            ]
        else:
            raw = source(session, options, domain)
            queries += start_domain(raw, domain, stores, options.checkpoint, trigger(options), own_cadence=options.own_cadence)
        if options.closed_windows:
            queries.append(start_closing(source(session, options, domain), domain, stores["lake"], stores["lake"], options.checkpoint, trigger(options)))
    return queries


def main(arguments: Sequence[str] | None = None) -> None:
    options = parse(arguments)
    session = stream_session(build_session("floorline", spark__scheduler__mode="FAIR"), options.state_partitions)
    queries = start(session, options)
    if options.once:
        for query in queries:
            query.awaitTermination()
    else:
        await_any(session)


if __name__ == "__main__":
    main()
