from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rillstone.operators.dedup import distinct_events, first_per_key, newest_per_key, repeated_ids
from rillstone.operators.retention import drop_days_before, retained

COLUMNS = "event_id string, kafka_timestamp timestamp, partition int, offset bigint, body string"


def events(spark, *rows):
    return spark.createDataFrame([(i, dt.datetime(2024, 1, 1, 0, m), p, o, b) for i, m, p, o, b in rows], COLUMNS)


def test_earliest_arrival_survives(spark):
    rows = events(spark, ("a", 2, 0, 5, "late"), ("a", 1, 1, 9, "first"), ("b", 1, 0, 1, "only"), ("a", 1, 2, 0, "tie"))
    got = {r["event_id"]: r["body"] for r in distinct_events(rows).collect()}
    assert got == {"a": "first", "b": "only"}


def test_any_copy_without_order(spark):
    rows = events(spark, ("a", 2, 0, 5, "x"), ("a", 1, 1, 9, "x"))
    assert distinct_events(rows, order_by=None).count() == 1


def test_limit_runs_before_the_shuffle(spark, capsys):
    distinct_events(spark.range(10).selectExpr("string(id) event_id", "timestamp'2024-01-01' kafka_timestamp",
                                               "1 partition", "id offset")).explain()
    plan = capsys.readouterr().out
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_hot_key_leaves_one_row_per_task(spark):
    # A third of the rows share one id; after the partial limit each task holds at most one of them.
    rows = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.col("id").alias("offset"),
    )
    got = first_per_key(rows, ["event_id"], ["offset"])
    assert got.count() == 60_001
    assert got.where("event_id = 'hot'").first()["offset"] == 0


def test_repeated_ids(spark):
    rows = events(spark, ("a", 2, 0, 5, "x"), ("a", 1, 1, 9, "x"), ("b", 1, 1, 1, "x"))
    assert [tuple(r) for r in repeated_ids(rows).collect()] == [("a", 2)]


def test_newest_per_key(spark):
    rows = spark.createDataFrame([("w1", 1, 10), ("w1", 2, 11), ("w2", 1, 5)], "w string, batch_id int, n int")
    assert {(r["w"], r["n"]) for r in newest_per_key(rows, ["w"], ["batch_id"]).collect()} == {("w1", 11), ("w2", 5)}


def test_newest_record_of_several_partitions(spark):
    """Offsets of different partitions say nothing about each other; arrival does."""
    rows = spark.createDataFrame(
        [("w", "2024-01-01 00:00:00", 0, 900), ("w", "2024-01-01 00:00:09", 1, 3), ("w", "2024-01-01 00:00:09", 1, 2)],
        "w string, t string, partition int, offset long",
    ).withColumn("kafka_timestamp", F.to_timestamp("t"))
    assert newest_per_key(rows, ["w"]).first()["offset"] == 3


@pytest.mark.parametrize("topic, kept", [("events.cleaned", 24), ("events.curated", 48), ("events.dlq", 72)])
def test_retention_by_topic(spark, topic, kept):
    hours = spark.range(100).selectExpr("timestamp'2024-01-10 00:00:00' - make_dt_interval(0, int(id)) as event_ts")
    assert retained(hours, topic, "2024-01-10 00:00:00", "event_ts").count() == kept


def test_retention_is_by_arrival(spark):
    """A record that came an hour ago is kept, whether its own time is old or missing."""
    rows = spark.sql(
        """select timestamp'2024-01-10 11:00:00' as kafka_timestamp, ts as event_ts, to_date(ts) as event_date
        from values (timestamp'2023-12-01 00:00:00'), (null) as t(ts)"""
    )
    assert retained(rows, "events.cleaned", "2024-01-10 12:00:00").count() == 2
    assert retained(rows, "events.cleaned", "2024-01-12 12:00:00").count() == 0


def test_drop_days(spark, tmp_path):
    rows = spark.createDataFrame(
        [(f"2024-01-0{d}", k) for d in range(1, 6) for k in ("sensor", "app_log")] + [(None, "sensor")],
        "event_date string, event_kind string",
    ).withColumn("v", F.lit(1))
    root = f"{tmp_path}/store"
    rows.write.partitionBy("event_kind", "event_date").parquet(root)
    gone = drop_days_before(spark, root, dt.date(2024, 1, 4))
    assert len(gone) == 6
    left = spark.read.parquet(root)
    assert left.count() == 5
    assert left.where("event_date is null").count() == 1
    assert drop_days_before(spark, root, dt.date(2024, 1, 4)) == []


def test_retention_opens_only_files_that_reach_into_it(spark, tmp_path):
    """Files of one event day with arrivals of several days: the notes tell them apart, the day cannot."""
    import datetime as dt

    from rillstone.operators.retention import retained_of_store
    from rillstone.schemas import TOPIC_CLEANED
    from rillstone.sources.store import EventStore, cleaned_schema

    store, day = EventStore(f"{tmp_path}/store"), dt.datetime(2024, 1, 1)
    names = cleaned_schema().names

    def put(number, arrivals):
        rows = []
        for i, at in enumerate(arrivals):
            values = {"event_id": f"{number}-{i}", "event_type": "sensor", "event_ts": day, "kafka_timestamp": at}
            rows.append(tuple(values.get(n) for n in names))
        store.append(spark.createDataFrame(rows, cleaned_schema()).coalesce(1))

    put(0, [day, day + dt.timedelta(hours=1)])
    put(1, [day + dt.timedelta(days=2), day + dt.timedelta(hours=1)])
    store.note_arrivals(spark)
    put(2, [day + dt.timedelta(hours=2), None])
    store.note_arrivals(spark)
    store.note_arrivals(spark)
    assert spark.read.parquet(store.zones_path).count() == 3
    put(3, [day])  # not noted: read, and found to hold nothing

    def opened(as_of):
        rows = retained_of_store(spark, store, TOPIC_CLEANED, as_of)
        return len(rows.inputFiles()), sorted(r["event_id"] for r in rows.collect())

    assert opened("2024-01-03 12:00:00") == (3, ["1-0"])  # the one that holds it, that with a NULL, and the new one
    assert opened("2024-01-01 03:00:00") == (4, ["0-0", "0-1", "1-1", "2-0", "3-0"])
    store.note_arrivals(spark)
    assert opened("2024-01-03 12:00:00")[0] == 2
    assert store.scan(spark).count() == 7
