from __future__ import annotations

import datetime as dt
import json
import random
import threading
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rillstone.operators import metrics as met
from rillstone.operators.clean import clean, served
from rillstone.operators.decode import dead_letters, decode
from rillstone.operators.dedup import distinct_events
from rillstone.operators.wire import envelope
from rillstone.sinks.topics import FolderTopics
from rillstone.sources.folders import folder_bytes
from rillstone.sources.files import line_stream, line_table, wire_stream, wire_table
from rillstone.streaming import flow
from rillstone.sources.store import EventStore
from rillstone.streaming.fanout import (
    COUNTS,
    MEMBERS,
    RECORDS,
    Fanout,
    Tables,
    archive_days,
    by_batch,
    drop_batches,
    merge_parts,
    write_state,
)
from rillstone.streaming.ids import IDS, IdLedger
from rillstone.streaming.snapshots import Part, Snapshot, Snapshots, due
from rillstone.streaming.launch import await_any, current_windows, start_fanout, start_store, start_windows, supervise
from rillstone.streaming.progress import ProgressLog, consumer_lag, progress_report, state_operators, state_rows
from rillstone.workload.feed import JSON_GROWTH, SLICES, event_feed, events_table, files_for

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def feed(spark):
    return event_feed(events_table(spark, SF)).cache()


@pytest.fixture(scope="module")
def unique(feed):
    rows = clean(decode(envelope(feed), keep=("kafka_key", "kafka_timestamp", "partition", "offset")))
    return distinct_events(rows).cache()


@pytest.fixture(autouse=True)
def forget_ended_queries(spark):
    spark.streams.resetTerminated()


def staged(feed, folder, files, seed=1) -> str:
    """The feed as `files` Parquet files in a random row order, written one after the other."""
    slot = F.pmod(F.xxhash64("offset", F.lit(seed)), F.lit(files))
    order = list(range(files))
    random.Random(seed).shuffle(order)
    for number in order:
        feed.where(slot == number).coalesce(1).write.mode("append").parquet(folder)
    return folder


def bag(rows):
    return Counter(
        tuple(round(v, 9) if isinstance(v, float) else v for v in row)
        for row in rows.select(*sorted(rows.columns)).collect()
    )


def without_stamp(rows):
    return served(rows).drop("processed_at")


def replay(spark, source, folder, files_per_trigger=1, job=Fanout, **options):
    records = envelope(wire_stream(spark, source, files_per_trigger))
    fanout = job(f"{folder}/tables", **options)
    query = start_fanout(flow.checked_stream(records), fanout, f"{folder}/checkpoint", every=None)
    query.awaitTermination()
    return query


@pytest.mark.parametrize("files", [1, 3, 10])
def test_stream_equals_batch(spark, feed, unique, tmp_path, files):
    source = staged(feed, f"{tmp_path}/in", files, seed=files)
    query = replay(spark, source, tmp_path, topics=FolderTopics(f"{tmp_path}/topics"))
    tables = Tables(f"{tmp_path}/tables")

    assert bag(without_stamp(tables.accepted(spark))) == bag(without_stamp(unique))
    rejects = ["kafka_key", "partition", "offset", "reject_reason", "raw_json"]
    assert bag(tables.rejected(spark).select(rejects)) == bag(dead_letters(envelope(feed)).select(rejects))
    for table in met.TABLES.values():
        assert bag(tables.metrics(spark, table)) == bag(met.window_metrics(unique, table))
    by_day = met.clickstream_metrics(unique, "1 day")
    assert bag(tables.metrics(spark, met.CLICKSTREAM, "1 day")) == bag(by_day)

    published = spark.read.parquet(f"{tmp_path}/topics/events.cleaned")
    assert published.count() == unique.count()
    assert spark.read.parquet(f"{tmp_path}/topics/events.dlq").count() == tables.rejected(spark).count()

    counts = progress_report(spark, query.recentProgress)
    observed = {r["name"]: r["value"] for r in counts.select(F.explode("observed").alias("name", "value"))
                .groupBy("name").agg(F.sum("value").alias("value")).collect()}
    assert counts.agg(F.sum("input_rows")).first()[0] == feed.count() == observed["intake.records"]
    kept = tables.row_counts(spark).where("table_name = 'accepted'").agg(F.sum("row_count")).first()[0]
    assert kept == unique.count()
    assert counts.agg(F.max("late_rows_dropped")).first()[0] == 0


def test_batch_rows_add_up(spark, feed, unique, tmp_path):
    """A window cut by batches has a row per batch; the counts add up, the state merges to the final rows."""
    replay(spark, staged(feed, f"{tmp_path}/in", 3), tmp_path)
    tables = Tables(f"{tmp_path}/tables")
    rows = tables.batch_metrics(spark, met.SENSOR)
    assert rows.columns == [*met.SENSOR.columns, "batch_id"]
    assert rows.select("batch_id").distinct().count() == 3
    total = unique.where("event_type = 'sensor' and event_ts is not null").count()
    assert rows.agg(F.sum("reading_count")).first()[0] == total
    written = tables.row_counts(spark).groupBy("table_name").agg(F.sum("row_count").alias("n")).collect()
    counts = {r["table_name"]: r["n"] for r in written}
    assert counts["sensor_metrics"] == rows.count()
    assert counts[RECORDS] == unique.count() + tables.rejected(spark).count()
    close = tables.metrics(spark, met.CLICKSTREAM, "1 day", exact=False)
    assert close.count() == met.clickstream_metrics(unique, "1 day").count()


def test_files_do_not_multiply_with_the_width_of_the_state(spark, feed, tmp_path):
    replay(spark, staged(feed, f"{tmp_path}/in", 1), tmp_path)
    folders = Counter(path.parent for path in (tmp_path / "tables").rglob("*.parquet") if "accepted_ids" not in str(path))
    assert len(folders) > 50 and set(folders.values()) == {1}


class FailsOnce(Fanout):
    """Breaks in the middle of one batch, after part of its tables have been written."""

    armed = True

    def _replace(self, rows, name, batch_id, *more):
        if FailsOnce.armed and batch_id == 1 and name == "log_metrics":
            FailsOnce.armed = False
            raise RuntimeError("broken")
        super()._replace(rows, name, batch_id, *more)


def test_a_failed_batch_is_repeated_without_loss_or_copies(spark, feed, unique, tmp_path):
    source = staged(feed, f"{tmp_path}/in", 3)
    FailsOnce.armed = True
    with pytest.raises(Exception, match="broken"):
        replay(spark, source, tmp_path, job=FailsOnce)
    tables = Tables(f"{tmp_path}/tables")
    assert not FailsOnce.armed
    assert tables.accepted(spark).select("batch_id").distinct().count() == 1  # of batch 1 nothing is to be seen
    assert Tables(f"{tmp_path}/tables").records(spark, 1).count() > 0

    replay(spark, source, tmp_path, job=FailsOnce)
    assert bag(without_stamp(tables.accepted(spark))) == bag(without_stamp(unique))
    for table in met.TABLES.values():
        assert bag(tables.metrics(spark, table)) == bag(met.window_metrics(unique, table))


def test_repeating_a_batch_replaces_it(spark, feed, tmp_path):
    rows = flow.enrich(flow.decode_checked(envelope(feed)))
    job = Fanout(f"{tmp_path}/t")
    counts = []
    for _ in range(2):
        job(rows, 0)
        counts.append({n: spark.read.parquet(f"{job.root}/{n}").count() for n in (RECORDS, MEMBERS, *met.TABLES)})
    assert counts[0] == counts[1] and all(counts[0].values())
    assert job.tables.snapshot(spark).version == 1


def test_an_empty_batch_writes_no_metrics(spark, feed, tmp_path):
    job = Fanout(f"{tmp_path}/t")
    job(flow.enrich(flow.decode_checked(envelope(feed.limit(0)))), 0)
    assert job.tables.records(spark).isEmpty()


def test_errors_are_not_swallowed(spark, feed, tmp_path):
    class Down:
        def append(self, rows, table):
            raise ConnectionError("database down")

    with pytest.raises(ConnectionError):
        Fanout(f"{tmp_path}/t", database=Down())(flow.enrich(flow.decode_checked(envelope(feed))), 0)


def test_database_gets_four_tables_tagged_with_the_batch(spark, feed, tmp_path):
    seen = {}

    class Target:
        def append(self, rows, table):
            seen[table] = (rows.columns, rows.select("batch_id").distinct().collect())

    Fanout(f"{tmp_path}/t", database=Target())(flow.enrich(flow.decode_checked(envelope(feed))), 7)
    assert set(seen) == {"events_cleaned", *met.TABLES}
    for name, table in met.TABLES.items():
        assert seen[name][0] == [*table.columns, "batch_id"]
    assert all([tuple(r) for r in ids] == [(7,)] for _, ids in seen.values())


@pytest.mark.parametrize("combine", [False, True])
def test_store_sink(spark, feed, unique, tmp_path, combine):
    source = staged(feed, f"{tmp_path}/in", 3)
    events = flow.cleaned_stream(envelope(wire_stream(spark, source, 1)), combine=combine)
    for _ in range(2):  # the second start finds nothing new
        start_store(events, f"{tmp_path}/store", f"{tmp_path}/checkpoint", every=None, writers=2).awaitTermination()
    stored = spark.read.parquet(f"{tmp_path}/store")
    assert bag(without_stamp(stored)) == bag(without_stamp(unique))
    scan = EventStore(f"{tmp_path}/store").scan(spark, ["sensor"], "24 hours", "2024-01-31 00:00:00")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "event_kind" in filters and "event_date" in filters


def test_independent_queries(spark, feed, unique, tmp_path):
    """Store and serving tables as two queries over one feed, each with its own offsets and dedup state."""
    records = envelope(wire_stream(spark, staged(feed, f"{tmp_path}/in", 2), 1))
    store = start_store(flow.cleaned_stream(records), f"{tmp_path}/store", f"{tmp_path}/c1", every=None)
    serve = start_fanout(flow.checked_stream(records), Fanout(f"{tmp_path}/t"), f"{tmp_path}/c2", every=None)
    await_any(spark)
    store.awaitTermination()
    serve.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/store").count() == unique.count()
    assert Tables(f"{tmp_path}/t").accepted(spark).count() == unique.count()


def test_supervision_raises_the_error_of_a_failed_query(spark, feed, tmp_path):
    class Broken(Fanout):
        def __call__(self, batch, batch_id):
            raise RuntimeError("broken sink")

    records = envelope(wire_stream(spark, staged(feed, f"{tmp_path}/in", 1)))
    start_fanout(flow.checked_stream(records), Broken(f"{tmp_path}/t"), f"{tmp_path}/c", every="1 second")
    with pytest.raises(Exception, match="broken sink"):
        await_any(spark)


def test_supervision_restarts_and_gives_up(spark, feed, tmp_path):
    """A query that fails is run again while the other goes on; one that never succeeds ends them all."""
    records = envelope(wire_stream(spark, staged(feed, f"{tmp_path}/in", 2), 1))

    class Flaky(Fanout):
        left = 2

        def __call__(self, batch, batch_id):
            if type(self).left:
                type(self).left -= 1
                raise RuntimeError("flaky sink")
            super().__call__(batch, batch_id)

    def serve(job, name):
        return lambda: start_fanout(flow.checked_stream(records), job(f"{tmp_path}/{name}"), f"{tmp_path}/c-{name}", every=None)

    runs = supervise({"flaky": serve(Flaky, "a"), "sound": serve(Fanout, "b")})
    assert [(r.number, r.error is None) for r in runs if r.name == "flaky"] == [(1, False), (2, False), (3, True)]
    assert [(r.number, r.error) for r in runs if r.name == "sound"] == [(1, None)]
    found = [Tables(f"{tmp_path}/{name}").accepted(spark) for name in "ab"]
    assert found[0].select("event_id").exceptAll(found[1].select("event_id")).isEmpty()
    assert found[0].count() == found[1].count() > 0

    Flaky.left = 100
    endless = lambda: start_fanout(flow.checked_stream(records), Fanout(f"{tmp_path}/e"), f"{tmp_path}/c-e", every="1 second")
    with pytest.raises(Exception, match="flaky sink"):
        supervise({"endless": endless, "flaky": serve(Flaky, "d")}, most=2)
    assert not spark.streams.active and Flaky.left == 98


def line(event_id, second, zone="zone_1"):
    stamp = f"2024-01-01T{second // 3600:02}:{second // 60 % 60:02}:{second % 60:02}+00:00"
    return json.dumps({"event_id": event_id, "event_type": "sensor", "timestamp": stamp, "location": zone,
                       "temperature": 1.0, "is_anomaly": False})


def test_closed_windows_and_late_rows(spark, tmp_path):
    """A row older than the watermark is dropped and counted; every closed window appears once.

    Spark lets late rows pass in the batch right after the one that moved the watermark, hence the
    spacer batch before the late row.
    """
    source = tmp_path / "in"
    source.mkdir()

    def run(*lines):
        (source / f"f{len(list(source.iterdir()))}.json").write_text("\n".join(lines))
        records = envelope(line_stream(spark, str(source)))
        metrics = flow.window_stream(records, met.SENSOR, lateness="10 minutes")
        query = start_windows(metrics, f"{tmp_path}/out", f"{tmp_path}/checkpoint", every=None, mode="append")
        query.awaitTermination()
        return progress_report(spark, query.recentProgress).agg(F.sum("late_rows_dropped")).first()[0]

    assert run(line("a", 0), line("b", 30), line("a", 0)) == 0
    assert run(line("c", 7200)) == 0
    assert run(line("d", 7260)) == 0
    assert run(line("late", 10)) > 0
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert [(str(r["window_start"]), r["reading_count"]) for r in got] == [("2024-01-01 00:00:00", 2)]


def reading(event_id, second, value, zone="zone_1"):
    return line(event_id, second, zone).replace('"temperature": 1.0', f'"temperature": {value}')


def test_open_windows_are_current(spark, tmp_path):
    """Updates show windows that are still open, with what later batches added."""
    source = tmp_path / "in"
    source.mkdir()
    counts = []
    for number, lines in enumerate([[line("a", 0)], [line("b", 30), line("a", 0)], [line("c", 65)]]):
        (source / f"{number}.json").write_text("\n".join(lines))
        metrics = flow.window_stream(envelope(line_stream(spark, str(source))), met.SENSOR)
        start_windows(metrics, f"{tmp_path}/out", f"{tmp_path}/checkpoint", every=None).awaitTermination()
        rows = current_windows(spark, f"{tmp_path}/out", met.SENSOR)
        counts.append(sorted(r["reading_count"] for r in rows.collect()))
    assert counts == [[1], [2], [1, 2]]


@pytest.mark.parametrize("combine", [False, True])
def test_an_id_counts_again_after_its_horizon(spark, tmp_path, combine):
    """Copies within the horizon of the accepted one are dropped and do not prolong it."""
    source = tmp_path / "in"
    source.mkdir()
    ids = [f"i{n}" for n in range(200)]

    def run(minute, names):
        (source / f"{minute:03}.json").write_text("\n".join(line(name, 60 * minute) for name in names))
        rows = decode(envelope(line_stream(spark, str(source))), keep=())
        timed = rows.withColumn("at", F.to_timestamp("timestamp"))
        kept = flow.drop_repeats(timed, clock="at", horizon="10 minutes", combine=combine)
        writer = kept.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c")
        writer.trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
        return spark.read.parquet(f"{tmp_path}/out").where(F.col("event_id").startswith("i")).count()

    assert run(0, ids + ids) == 200
    assert run(9, ids) == 200
    assert run(21, ["tick"]) == 200
    assert run(22, ids + ids) == 400


def test_published_metrics_are_final(spark, tmp_path):
    """A window that two batches share is published again as a whole; the newest record of its key is right."""
    source = tmp_path / "in"
    source.mkdir()
    for number, lines in enumerate([[reading("a", 0, 10), reading("b", 1, 20)], [reading("c", 2, 90)]]):
        (source / f"{number}.json").write_text("\n".join(lines))
        records = envelope(line_stream(spark, str(source)))
        job = Fanout(f"{tmp_path}/tables", topics=FolderTopics(f"{tmp_path}/topics"))
        start_fanout(flow.checked_stream(records), job, f"{tmp_path}/c", every=None).awaitTermination()
    topic = spark.read.parquet(f"{tmp_path}/topics/events.curated")
    assert topic.select("key").distinct().count() == 1 and topic.count() == 2
    last = json.loads(topic.orderBy(F.desc("batch_id")).first()["value"])
    assert (last["avg_temperature"], last["max_temperature"], last["reading_count"]) == (40, 90, 3)


def folders_of(tables, name):
    return len(list(Path(tables.root, name).glob("first_batch=*/last_batch=*")))


def test_folders_stay_few(spark, feed, unique, tmp_path, monkeypatch):
    """Parts are merged in levels and archived records go; nothing is counted twice or lost, per batch neither."""
    monkeypatch.setattr(Tables, "snapshots", property(lambda self: Snapshots(self.root, keep=1)))
    replay(spark, staged(feed, f"{tmp_path}/in", 8), tmp_path, fan=2)
    tables = Tables(f"{tmp_path}/tables")
    tables.snapshots.clean_up(spark)
    for name in (MEMBERS, *met.TABLES, *map(by_batch, met.TABLES), COUNTS, IDS):
        assert 1 <= folders_of(tables, name) == len(tables.snapshot(spark).parts(name)) <= 3
    for table in met.TABLES.values():
        assert bag(tables.metrics(spark, table)) == bag(met.window_metrics(unique, table))
    assert tables.ids(spark).select("event_id").exceptAll(unique.select("event_id")).isEmpty()
    assert tables.ids(spark).count() == unique.count()
    rows = tables.batch_metrics(spark, met.SENSOR)
    assert sorted(r[0] for r in rows.select("batch_id").distinct().collect()) == list(range(8))
    total = unique.where("event_type = 'sensor' and event_ts is not null").count()
    assert rows.agg(F.sum("reading_count")).first()[0] == total
    counts = tables.row_counts(spark).where("table_name = 'sensor_metrics'").agg(F.sum("row_count"), F.count("*")).first()
    assert tuple(counts) == (rows.count(), 8)

    store, days = EventStore(f"{tmp_path}/store"), (dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    archive_days(spark, tables, store, *days)
    drop_batches(spark, tables, 6)
    tables.snapshots.clean_up(spark)
    assert folders_of(tables, RECORDS) <= 2
    archive_days(spark, tables, store, *days)
    assert bag(without_stamp(store.scan(spark))) == bag(without_stamp(unique))
    assert store.scan(spark).where("event_ts is null").count() > 0


def test_a_running_job_archives_its_batches(spark, feed, unique, tmp_path):
    """Records of old batches move to the store while the job runs: no more than two spans of them stay."""
    store = EventStore(f"{tmp_path}/archive")
    replay(spark, staged(feed, f"{tmp_path}/in", 7), tmp_path, archive=store, archive_every=2)
    tables = Tables(f"{tmp_path}/tables")
    assert [p.first for p in tables.snapshot(spark).parts(RECORDS)] == [5, 6]
    stored, recent = store.scan(spark), tables.accepted(spark)
    # Whole days are archived, so some events of recent batches are in both.
    both = stored.select("event_id").unionByName(recent.select("event_id")).distinct()
    assert both.count() == unique.count()
    assert stored.count() == stored.select("event_id").distinct().count()
    old = tables.ids(spark).where("batch_id <= 4").select("event_id")
    assert old.exceptAll(stored.select("event_id")).isEmpty()


def test_archive_keeps_each_id_once(spark, tmp_path):
    """Rows accepted in two batches, and rows without a readable time."""
    lines = [line("a", 0), json.dumps({"event_id": "b", "event_type": "sensor", "timestamp": "bad"})]
    rows = spark.createDataFrame([(x,) for x in lines], "raw_json string").select(
        F.lit("k").alias("kafka_key"), "raw_json", F.lit(0).alias("partition"), F.lit(1).cast("long").alias("offset"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("kafka_timestamp"),
    )
    job = Fanout(f"{tmp_path}/t")
    for batch in (0, 1):
        job(flow.enrich(flow.decode_checked(rows)), batch)
    store = EventStore(f"{tmp_path}/store")
    archive_days(spark, job.tables, store, dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    assert sorted(r["event_id"] for r in store.scan(spark).collect()) == ["a", "b"]


def test_progress_outlives_the_report_limit(spark, feed, tmp_path):
    """Totals come from the written reports: Spark itself remembers the last three here."""
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    log = ProgressLog(spark, f"{tmp_path}/progress", fan=2)
    spark.conf.set(key, "3")
    spark.streams.addListener(log)
    try:
        query = replay(spark, staged(feed, f"{tmp_path}/in", 6), tmp_path)
        log.settled(query)
    finally:
        spark.streams.removeListener(log)
        spark.conf.set(key, before)
    assert len(query.recentProgress) <= 3
    assert log.table().agg(F.sum("input_rows")).first()[0] == feed.count()
    assert log.table().where("input_rows > 0").count() == 6
    assert sum(len(parts) for parts in log.snapshots.newest(spark).tables.values()) <= 3
    again = log.snapshots.newest(spark)
    log._add(f"query_id={query.id}", Part(0, 0), log.table().limit(1).drop("query_id"))  # a report that has been merged
    assert log.snapshots.newest(spark) == again


def test_unreadable_time_is_deduplicated_and_kept(spark, tmp_path):
    """The dedup clock is the processing time, so a row without event time is not late and not repeated."""
    bad = json.dumps({"event_id": "x", "event_type": "sensor", "timestamp": "bad"})
    source = tmp_path / "in"
    source.mkdir()
    for number, text in enumerate([bad, line("a", 9000), line("b", 0), bad]):
        (source / f"{number}.json").write_text(text)
        events = flow.cleaned_stream(envelope(line_stream(spark, str(source))), combine=True)
        start_store(events, f"{tmp_path}/store", f"{tmp_path}/checkpoint", every=None).awaitTermination()
    stored = spark.read.parquet(f"{tmp_path}/store").select("event_id", F.isnull("event_ts").alias("no_time"))
    assert sorted(map(tuple, stored.collect())) == [("a", False), ("b", False), ("x", True)]


def test_line_and_wire_tables(spark, feed, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "a.json").write_text(line("a", 0) + "\n" + line("b", 1))
    lines = line_table(spark, str(tmp_path / "l"))
    assert decode(envelope(lines)).count() == 2
    staged(feed, f"{tmp_path}/w", 1)
    table = wire_table(spark, f"{tmp_path}/w")
    assert table.columns == lines.columns == feed.columns
    assert table.count() == feed.count()


def test_consumer_lag(spark):
    report = {
        "sources": [
            {
                "description": "KafkaV2[Subscribe[events.raw]]",
                "endOffset": {"events.raw": {"0": 10, "1": 7}},
                "latestOffset": '{"events.raw": {"0": 15, "1": 7}}',
            },
            {"description": "FileStreamSource[x]", "endOffset": '{"logOffset": 3}', "latestOffset": None},
        ]
    }
    rows = consumer_lag(spark, report).select("topic", "partition", "committed", "latest", "lag").collect()
    assert set(map(tuple, rows)) == {
        ("events.raw", 0, 10, 15, 5), ("events.raw", 1, 7, 7, 0), (None, None, 3, None, None),
    }


# --- parts, snapshots, the ledger --------------------------------------------------------------------


def test_levels_rewrite_each_row_a_few_times():
    """Ten thousand batches: every row is written again about log times, and folders stay few."""
    parts, written, most = [], 0, 0
    for batch in range(10_000):
        parts.append(Part(batch, batch))
        if found := due(parts, 8):
            group, part = found
            assert part.first == group[0].first and part.last == batch == group[-1].last
            assert sorted(n for p in group for n in range(p.first, p.last + 1)) == list(range(part.first, part.last + 1))
            parts = [p for p in parts if p not in group] + [part]
            written += part.last - part.first + 1
        most = max(most, len(parts))
    assert [n for p in sorted(parts) for n in (p.first, p.last)][0] == 0
    assert sum(p.last - p.first + 1 for p in parts) == 10_000
    assert written / 10_000 <= 5 and most <= 7 * 5


@pytest.fixture
def narrow(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    yield
    spark.conf.set(key, before)


def test_a_thousand_small_batches(spark, tmp_path, narrow):
    """State of 1,000 batches merged as they come: bytes written again per batch grow with the logarithm of their number,
    totals and what each batch added stay."""
    tables, now, merged, bytes_of = Tables(str(tmp_path)), Snapshot(), 0, {}
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    schema = "service string, level string, log_count bigint, status_code_sum double, status_code_rows bigint, window_start timestamp, window_end timestamp"

    def row(n):
        at = start + dt.timedelta(minutes=n % 50)
        return (f"s{n % 3}", "INFO", n + 1, float(n), 1, at, at + dt.timedelta(minutes=1))

    few = spark.createDataFrame([row(n) for n in range(1000)], schema).withColumn("n", F.col("log_count") - 1)
    few.withColumn("window_date", F.to_date("window_start")).repartition(1).write.partitionBy("n", "window_date").parquet(f"{tmp_path}/raw")
    for n in range(1000):
        part = Part(n, n)
        target = Path(tables.path("log_metrics", part))
        target.parent.mkdir(parents=True)
        Path(tmp_path, "raw", f"n={n}").rename(target)
        now = tables.snapshots.commit(spark, now.after_batch(n, ["log_metrics"], {"log_metrics": 1}))
        for name, made in merge_parts(spark, tables, 16) if n % 16 == 15 else ():
            if name == "log_metrics":
                size = folder_bytes(spark, tables.path(name, made))
                bytes_of[made] = size
                merged += made.last - made.first + 1
        if n % 16 == 15:
            tables.snapshots.clean_up(spark)
            now = tables.snapshot(spark)
    assert merged == 3 * (15 * 16 + 256) + 14 * 16  # sixteens, every sixteenth with those before at once
    assert len(now.parts("log_metrics")) == 3 + 14 + 8 and max(bytes_of.values()) < 100_000
    final = tables.metrics(spark, met.LOG).agg(F.sum("log_count"), F.count("*")).first()
    assert tuple(final) == (1000 * 1001 // 2, 150)
    rows = tables.batch_metrics(spark, met.LOG).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["log_count"]) for r in rows] == [(n, n + 1) for n in range(1000)]
    assert tuple(tables.row_counts(spark).agg(F.sum("row_count"), F.count("*")).first()) == (1000, 1000)
    assert sum(1 for _ in Path(tmp_path).glob("log_metrics/*/*")) <= 25 + 2 * 16


def test_readers_see_whole_batches_only(spark, feed, unique, tmp_path):
    """While batches are written, fail, are repeated and merged, a reader sees the totals of some whole batches."""
    rows = flow.enrich(flow.decode_checked(envelope(feed))).where("event_type = 'sensor' or reject_reason is not null").cache()
    job, seen, stop, errors = FailsOnce(f"{tmp_path}/t", fan=2), set(), threading.Event(), []
    FailsOnce.armed = False

    def read():
        reader = spark.newSession()
        while not stop.is_set():
            try:
                tables = job.tables.at(job.tables.snapshot(reader))
                counted = tables.metrics(reader, met.SENSOR).agg(F.sum("reading_count")).first()[0] or 0
                stored = tables.accepted(reader).where("event_ts is not null").count()
                seen.add((counted, stored))
            except Exception as e:  # told to the test below
                errors.append(e)
                return

    thread = threading.Thread(target=read)
    thread.start()
    sizes = [0]
    try:
        for batch in range(6):
            part = rows.where(F.pmod(F.xxhash64("event_id"), F.lit(6)) == batch)
            if batch == 3:
                broken = Broken(f"{tmp_path}/t", fan=2)
                with pytest.raises(RuntimeError, match="half-way"):
                    broken(part, batch)
            job(part, batch)
            sizes.append(sizes[-1] + part.where("reject_reason is null and event_ts is not null").select("event_id").distinct().count())
            job(part, batch)  # a batch that is done already changes nothing
    finally:
        stop.set()
        thread.join()
    assert not errors
    assert seen <= {(n, n) for n in sizes} and len(seen) > 2
    assert sizes[-1] == unique.where("event_type = 'sensor' and event_ts is not null").count()


class Broken(Fanout):
    """Ends after all tables of a batch have been written, before its snapshot."""

    def _ids(self, events, batch_id, count):
        super()._ids(events, batch_id, count)
        raise RuntimeError("half-way")


def test_copies_are_known_however_late(spark, tmp_path):
    """Ids return after the horizon of a state: the state takes them again, the ledger does not."""
    source = tmp_path / "in"
    source.mkdir()
    ids = [f"i{n}" for n in range(60)]
    for number, (minute, names) in enumerate([(0, ids + ids), (21, ["tick"]), (22, ["tock"]), (23, ids + ["new"])]):
        (source / f"{number}.json").write_text("\n".join(line(name, 60 * minute) for name in names))
        lines = line_stream(spark, str(source))
        timed = decode(envelope(lines), keep=()).withColumn("at", F.to_timestamp("timestamp"))
        writer = flow.drop_repeats(timed, clock="at", horizon="10 minutes").writeStream.format("parquet")
        writer = writer.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True)
        writer.start(f"{tmp_path}/out").awaitTermination()
        feed = flow.checked_stream(envelope(lines))
        start_fanout(feed, Fanout(f"{tmp_path}/t", fan=2), f"{tmp_path}/f", every=None).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").where("event_id like 'i%'").count() == 120

    tables = Tables(f"{tmp_path}/t")
    assert sorted(r["event_id"] for r in tables.accepted(spark).collect()) == sorted([*ids, "tick", "tock", "new"])
    assert [r["event_id"] for r in tables.ids(spark).orderBy(F.desc("batch_id")).limit(1).collect()] == ["new"]


def test_rejects_cost_no_state(spark, feed):
    """The feed that goes to the fan-out has neither a stateful step nor a shuffle."""
    plan = flow.checked_stream(envelope(feed))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Deduplicate" not in plan


@pytest.mark.parametrize("named, sent", [(1000, 10**6), (0, 10**6), (0, 0)])
def test_ledger_finds_the_same_ids_whichever_way(spark, tmp_path, named, sent):
    ledger = IdLedger(str(tmp_path), buckets=4, named=named, sent=sent)
    parts = [Part(0, 3, 1), Part(4, 4)]
    for part, ids in zip(parts, (range(0, 300), range(300, 320))):
        rows = spark.createDataFrame([(f"e{n}", part.last) for n in ids], "event_id string, batch_id long")
        ledger.write(rows, part, 300)
    batch = spark.createDataFrame([(f"e{n}", i) for i in range(2) for n in range(290, 340)], "event_id string, place int")
    with ledger.naming(spark):
        got = sorted(map(tuple, ledger.unseen(batch, parts, ["place"]).collect()))
    assert got == [(f"e{n}", 0) for n in range(320, 340)]
    assert ledger.unseen(batch, [], ["place"]).count() == 50
    assert ledger.unseen(batch.limit(0), parts, ["place"]).count() == 0


def test_bloom_filters_spare_the_ledger(spark, tmp_path):
    """Ids named in the scan: only the directories they fall into are opened, and row groups without them are skipped."""
    ledger, part = IdLedger(str(tmp_path), buckets=8), Part(0, 0)
    rows = spark.range(200_000).select(F.concat(F.lit("id"), F.xxhash64("id").cast("string")).alias("event_id"), F.lit(0).cast("long").alias("batch_id"))
    ledger.write(rows, part, 200_000)
    strangers = spark.createDataFrame([(f"stranger{n}",) for n in range(5)], "event_id string")
    with ledger.naming(spark):
        known, n = ledger.candidates(strangers, [part])
        assert known.count() == 0 and n == 5
        plan = known._jdf.queryExecution().executedPlan()
        text = plan.toString()
    assert "id_bucket" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "In(event_id" in text.split("PushedFilters: [")[1]
    friend = rows.limit(1)
    with ledger.naming(spark):
        scan = ledger.candidates(friend, [part])[0]
        assert scan.count() == 1
        read = scan_rows(scan)
        assert read < 60_000  # one directory, of 25,000 rows
        assert scan_rows(ledger.candidates(strangers, [part])[0]) == 0
    assert not ledger.unseen(friend, [part], ["event_id"]).count()


def scan_rows(df) -> int:
    """Rows that the file scan of a query hands on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    node = leaves.apply(0)
    node = node.plan() if node.nodeName().endswith("QueryStage") else node
    while node.nodeName() == "AdaptiveSparkPlan":
        node = node.executedPlan().collectLeaves().apply(0)
    return node.metrics().apply("numOutputRows").value()


# --- late events, lag, state as a table ---------------------------------------------------------------


def test_late_events_are_kept_with_a_reason(spark, tmp_path):
    """Windows close two minutes behind the newest event of earlier batches; windows and late events are all events."""
    source = tmp_path / "in"
    source.mkdir()
    batches = [[line("a", 0), line("b", 600)], [line("late", 30), line("edge", 420), line("c", 900), line("d", 485)], [line("e", 700), line("f", 840)]]
    for number, lines in enumerate(batches):
        (source / f"{number}.json").write_text("\n".join(lines))
        feed = flow.checked_stream(envelope(line_stream(spark, str(source))))
        job = Fanout(f"{tmp_path}/t", lateness="2 minutes", fan=2)
        start_fanout(feed, job, f"{tmp_path}/c", every=None).awaitTermination()
    late = {r["event_id"]: (str(r["closed_at"]), r["reason"], r["batch_id"]) for r in job.tables.late(spark).collect()}
    # 600 s less two minutes is 480: the window of 420 ends there and is closed, that of 485 is not.
    assert late.keys() == {"late", "edge", "e"}
    assert late["edge"][:2] == ("2024-01-01 00:08:00", "window_closed") and late["e"][0] == "2024-01-01 00:13:00"
    counted = job.tables.metrics(spark, met.SENSOR).agg(F.sum("reading_count")).first()[0]
    assert counted + len(late) == job.tables.accepted(spark).count() == 8


def test_lag_of_a_job_stopped_half_way(spark, feed, tmp_path):
    replay(spark, staged(feed.where("offset < 600"), f"{tmp_path}/in", 2), tmp_path)
    tables = Tables(f"{tmp_path}/tables")
    rows = {r["partition"]: (r["newest"], r["processed"], r["lag"]) for r in tables.lag(spark, feed).collect()}
    for number in range(3):
        own = feed.where(F.col("partition") == number)
        newest, done = own.agg(F.max("offset")).first()[0], own.where("offset < 600").agg(F.max("offset")).first()[0]
        assert rows[number] == (newest, done, newest - done) and newest > done
    none = Tables(f"{tmp_path}/nothing").lag(spark, feed).collect()
    assert all(r["processed"] is None and r["lag"] is None for r in none) and len(none) == 3


def test_state_is_readable_and_bounded(spark, tmp_path):
    """Over many batches the dedup holds no more ids than came within its horizon."""
    source = tmp_path / "in"
    source.mkdir()
    held = []
    for number in range(7):
        (source / f"{number}.json").write_text("\n".join(line(f"{number}-{n}", 600 * number + n) for n in range(20)))
        rows = decode(envelope(line_stream(spark, str(source))), keep=()).withColumn("at", F.to_timestamp("timestamp"))
        kept = flow.drop_repeats(rows, clock="at", horizon="15 minutes")
        writer = kept.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c")
        writer.trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
        state = state_rows(spark, f"{tmp_path}/c")
        held.append(state.count())
    assert max(held) <= 20 * 4 and held[-1] < 7 * 20
    expiry = {r["event_id"]: r["expires_at"] for r in state.collect()}
    assert expiry["6-3"] == dt.datetime(2024, 1, 1, 1, 0, 3) + dt.timedelta(minutes=15)
    names = state_operators(spark, f"{tmp_path}/c").select("operatorName").distinct().collect()
    assert [r[0] for r in names] == ["dedupeWithinWatermark"]


def test_store_directories_get_few_files_however_wide_the_state(spark, tmp_path):
    days = F.date_format(F.date_add(F.lit("2024-01-01"), (F.col("id") % 3).cast("int")), "yyyy-MM-dd'T'12:00:00'+00:00'")
    event = F.struct(F.col("id").cast("string").alias("event_id"), F.lit("sensor").alias("event_type"), days.alias("timestamp"))
    rows = spark.range(600).select(
        F.lit(None).cast("binary").alias("key"), F.to_json(event).cast("binary").alias("value"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), F.col("id").alias("offset"), F.current_timestamp().alias("timestamp"),
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        events = flow.cleaned_stream(envelope(wire_stream(spark, f"{tmp_path}/in")))
        start_store(events, f"{tmp_path}/store", f"{tmp_path}/checkpoint", every=None, spread=2).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    stored = EventStore(f"{tmp_path}/store").scan(spark)
    assert stored.select("event_id").distinct().count() == stored.count() == 600
    files = Counter(f.parent.name for f in Path(f"{tmp_path}/store").rglob("*.parquet"))
    assert len(files) == 3 and max(files.values()) <= 2


def test_a_slice_of_a_middling_feed_keeps_a_dozen_cores_busy():
    assert files_for(100 << 20, JSON_GROWTH, SLICES) >= 12
    assert files_for(1 << 20, JSON_GROWTH, SLICES) == 2


def test_state_of_many_days_is_few_files_and_a_day_is_still_found(spark, tmp_path):
    start = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 86_400)
    rows = spark.range(300).select(F.lit("z").alias("location"), start.alias("window_start"), F.col("id").alias("reading_count"))
    write_state(rows, f"{tmp_path}/state")
    assert len(list(Path(f"{tmp_path}/state").rglob("*.parquet"))) <= 32
    stored = spark.read.parquet(f"{tmp_path}/state").drop("day_slot")
    assert stored.columns == [*rows.columns, "window_date"]
    found = stored.where(F.col("window_date") == F.date_add(F.lit("2024-01-01"), 70)).collect()
    assert [r["reading_count"] for r in found] == [70]
