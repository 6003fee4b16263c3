"""The continuous job: raw feed in, event store and serving tables out.

    python -m rillstone --servers host:9092 --root hdfs:///events
    python -m rillstone --files /data/topic --root /data/out --once

One query serves all tables, so that store and metrics can never disagree about which events were seen. Once a day, or
every `--archive-every` batches, the records of older batches move into the event store below `archive`.
`--store-query` starts a second query that appends to a table partitioned by kind, with its own offsets
and dedup state.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rillstone.operators.wire import envelope
from rillstone.schemas import TOPIC_RAW
from rillstone.session import build_session, tune
from rillstone.sinks.topics import FolderTopics, KafkaTopics
from rillstone.sources.files import wire_stream
from rillstone.sources.jdbc import JdbcDatabase
from rillstone.sources.kafka import KafkaTopic
from rillstone.sources.store import EventStore
from rillstone.streaming import flow
from rillstone.streaming.fanout import Fanout
from rillstone.streaming.launch import SERVE_EVERY, STORE_EVERY, start_fanout, start_store, supervise


def settings(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="rillstone", description="Parse, clean and aggregate an event feed.")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--files", help="folder of Parquet files with broker records")
    parser.add_argument("--root", required=True, help="folder for tables and checkpoints, reachable by every executor")
    parser.add_argument("--topic", default=TOPIC_RAW)
    parser.add_argument("--starting", default="latest", help="latest, earliest or a JSON offset map")
    parser.add_argument("--max-per-trigger", type=int, help="records (Kafka) or files per micro-batch")
    parser.add_argument("--min-partitions", type=int, help="read tasks per Kafka micro-batch, at least")
    parser.add_argument("--archive-every", type=int, default=8640, help="batches after which older ones are archived")
    parser.add_argument("--no-archive", action="store_true", help="keep all records in the folders of their batches")
    parser.add_argument("--jdbc-connections", type=int, default=16, help="writing connections")
    parser.add_argument("--publish", action="store_true", help="also publish cleaned, curated and dead-letter topics")
    parser.add_argument("--store-query", action="store_true", help="also run the independent store query")
    parser.add_argument("--dedup-horizon", default=flow.DAY, help="how long the store query remembers an id")
    parser.add_argument("--combine", action="store_true", help="store query: thin out hot event ids before the dedup")
    parser.add_argument("--store-format", default="parquet", choices=["parquet", "delta"])
    parser.add_argument("--store-writers", type=int, help="files per directory and trigger of the store query")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-user", default=os.environ.get("JDBC_USER", ""))
    parser.add_argument("--jdbc-driver", default="org.postgresql.Driver")
    parser.add_argument("--attempts", type=int, default=3, help="starts of a query that fails, before the job does")
    parser.add_argument("--once", action="store_true", help="work off what is there, then stop")
    return parser.parse_args(argv)


def records(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.files:
        return envelope(wire_stream(spark, args.files, args.max_per_trigger))
    topic = KafkaTopic(args.servers, args.topic, args.starting, args.max_per_trigger, args.min_partitions)
    return envelope(topic.stream(spark))


def starts(spark: SparkSession, args: argparse.Namespace) -> dict[str, Callable[[], StreamingQuery]]:
    """How to start each query of the job, by name."""
    feed, root = records(spark, args), args.root.rstrip("/")
    topics = database = None
    if args.publish:
        topics = KafkaTopics(args.servers) if args.servers else FolderTopics(f"{root}/topics")
    if args.jdbc_url:
        # The password never appears among the arguments.
        database = JdbcDatabase(
            args.jdbc_url,
            args.jdbc_user,
            os.environ["JDBC_PASSWORD"],
            args.jdbc_driver,
            connections=args.jdbc_connections,
        )
    archive = None if args.no_archive else EventStore(f"{root}/archive")
    fanout = Fanout(f"{root}/tables", topics=topics, database=database, archive=archive, archive_every=args.archive_every)
    serve_every, store_every = (None, None) if args.once else (SERVE_EVERY, STORE_EVERY)
    found = {
        "serving": lambda: start_fanout(flow.checked_stream(feed), fanout, f"{root}/checkpoints/serving", serve_every, "serving")
    }
    if args.store_query:

        def store() -> StreamingQuery:
            events = flow.cleaned_stream(feed, horizon=args.dedup_horizon, combine=args.combine)
            place, checkpoint = f"{root}/store", f"{root}/checkpoints/store"
            return start_store(
                events, place, checkpoint, fmt=args.store_format, every=store_every, name="store", writers=args.store_writers
            )

        found["store"] = store
    return found


def start(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    return [begin() for begin in starts(spark, args).values()]


def main(argv: Sequence[str] | None = None) -> None:
    args = settings(argv)
    spark = tune(build_session())
    supervise(starts(spark, args), args.attempts)
