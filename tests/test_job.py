from __future__ import annotations

import datetime as dt

import pytest

from rillstone.operators.orders import decode_orders, describe_orders
from rillstone.operators.wire import envelope
from rillstone.plans import job
from rillstone.sources.files import wire_stream
from rillstone.sources.store import EventStore
from rillstone.streaming.fanout import Tables, archive_days
from rillstone.workload.feed import event_feed, events_table, order_feed

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    """Root of a job that has worked off the whole feed, with both queries and all topics."""
    base = tmp_path_factory.mktemp("job")
    event_feed(events_table(spark, SF)).repartition(2).write.parquet(f"{base}/in")
    args = job.settings(["--files", f"{base}/in", "--root", f"{base}/out", "--once", "--publish", "--store-query"])
    for query in job.start(spark, args):
        query.awaitTermination()
    return f"{base}/out"


def test_both_queries_see_the_same_events(spark, done):
    accepted = Tables(f"{done}/tables").accepted(spark)
    stored = spark.read.parquet(f"{done}/store")
    assert accepted.count() == stored.count() > 0
    assert accepted.select("event_id").exceptAll(stored.select("event_id")).isEmpty()


def test_topics_are_published(spark, done):
    for topic in ("events.cleaned", "events.curated", "events.dlq"):
        rows = spark.read.parquet(f"{done}/topics/{topic}")
        assert {"key", "value"} <= set(rows.columns) and rows.where("value is null").isEmpty() and rows.count() > 0


def test_archive_takes_every_row_of_its_days_and_can_be_repeated(spark, done, tmp_path):
    tables, store = Tables(f"{done}/tables"), EventStore(f"{tmp_path}/archive")
    days = dt.date(2024, 1, 3), dt.date(2024, 1, 9)
    wanted = "event_date between date'2024-01-03' and date'2024-01-09' or event_date is null"
    want = tables.accepted(spark).where(wanted).count()
    for _ in range(2):
        archive_days(spark, tables, store, *days)
        assert store.scan(spark).count() == want > 0


@pytest.mark.parametrize(
    "argv", [[], ["--root", "x"], ["--servers", "a:1", "--files", "b", "--root", "x"], ["--servers", "a:1"]]
)
def test_incomplete_settings(argv):
    with pytest.raises(SystemExit):
        job.settings(argv)


def test_order_feed_as_a_stream_is_replayed_in_full_by_every_new_reader(spark, tmp_path):
    order_feed(spark, SF).limit(500).write.parquet(f"{tmp_path}/orders")
    for reader in range(2):
        lines = describe_orders(decode_orders(envelope(wire_stream(spark, f"{tmp_path}/orders"))))
        out = f"{tmp_path}/out{reader}"
        query = lines.writeStream.format("parquet").option("checkpointLocation", f"{out}-checkpoint")
        query.trigger(availableNow=True).start(out).awaitTermination()
        got = spark.read.parquet(out)
        assert got.count() == 500
        row = got.first()
        assert row["message"] == f"Received order: {row['quantity']} x {row['item']} from {row['user']}"
