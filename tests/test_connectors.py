"""Connector settings. The Kafka and database drivers are not installed, so nothing is loaded here."""

from __future__ import annotations

import pytest

from rillstone import session
from rillstone.sinks.topics import KafkaTopics
from rillstone.sources.jdbc import JdbcDatabase
from rillstone.sources.kafka import KafkaTopic, order_topic


def test_stream_options():
    got = KafkaTopic("localhost:9092", max_per_trigger=1000, min_partitions=64).options()
    assert got == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "events.raw",
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
        "maxOffsetsPerTrigger": "1000",
        "minPartitions": "64",
    }


def test_order_feed_is_replayed_in_full():
    got = order_topic("localhost:9092").options(bounded=True)
    assert (got["subscribe"], got["startingOffsets"], got["endingOffsets"]) == ("orders", "earliest", "latest")


@pytest.mark.parametrize("wrong", [{"servers": ""}, {"starting": "soon"}, {"max_per_trigger": 0}, {"min_partitions": -1}])
def test_wrong_settings(wrong):
    with pytest.raises(ValueError):
        KafkaTopic(**{"servers": "localhost:9092", **wrong})


def test_publish_options():
    got = KafkaTopics("localhost:9092", (("compression.type", "zstd"),)).options("events.dlq")
    assert got["topic"] == "events.dlq" and got["kafka.compression.type"] == "zstd"


def test_jdbc():
    database = JdbcDatabase.postgres("postgres", "5432", "streaming_db", "pipeline", "secret")
    assert database.url == "jdbc:postgresql://postgres:5432/streaming_db"
    write = database.write_options("events_cleaned")
    assert (write["dbtable"], write["driver"], write["numPartitions"]) == ("events_cleaned", "org.postgresql.Driver", "16")
    read = database.read_options("events_cleaned", ("event_ts", "2024-01-01", "2024-02-01"))
    assert (read["partitionColumn"], read["lowerBound"], read["upperBound"]) == ("event_ts", "2024-01-01", "2024-02-01")
    assert "partitionColumn" not in database.read_options("events_cleaned")


class FakeSession:
    """Just the settings `shared_folder` looks at."""

    def __init__(self, named=None, master="spark://host:7077"):
        self.named, self.master, self.made = named, master, None
        self.conf = self.sparkContext = self

    def get(self, key, default):
        return self.named if key == "spark.checkpoint.dir" and self.named else default

    def getCheckpointDir(self):
        return self.made

    def setCheckpointDir(self, folder):
        self.made = folder


def test_shared_folder_comes_from_the_session():
    cluster = FakeSession("hdfs://shared/checkpoints/")
    assert session.shared_folder(cluster) == "hdfs://shared/checkpoints"


def test_fresh_folders(spark):
    one, two = (session.fresh_folder(spark, "x") for _ in range(2))
    assert one != two and one.startswith(f"{session.shared_folder(spark)}/rillstone/x-")


def test_a_cluster_must_name_its_folder():
    with pytest.raises(RuntimeError):
        session.shared_folder(FakeSession())


def test_a_local_master_gets_a_folder_once():
    local = FakeSession(master="local[2]")
    assert session.shared_folder(local) == session.shared_folder(local) == local.made


def test_tune_sets_what_results_depend_on(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert session.tune(spark).conf.get("spark.sql.session.timeZone") == "UTC"
