"""Kafka topics as streaming or bounded input. The connector package is needed only when `load` runs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rillstone.schemas import TOPIC_ORDERS, TOPIC_RAW


@dataclass(frozen=True)
class KafkaTopic:
    """Where and how to read a topic.

    `max_per_trigger` bounds a micro-batch; leave it unset unless the cluster cannot keep up, since it is
    also the throughput ceiling. `min_partitions` splits large broker partitions into more read tasks,
    which is the way out when one broker partition holds most of the records.
    """

    servers: str
    topic: str = TOPIC_RAW
    starting: str = "latest"
    max_per_trigger: int | None = None
    min_partitions: int | None = None
    fail_on_data_loss: bool = True

    def __post_init__(self):
        if not self.servers or not self.topic:
            raise ValueError("servers and topic are required")
        if self.starting not in ("latest", "earliest") and not self.starting.startswith("{"):
            raise ValueError("starting must be latest, earliest or a JSON offset map")
        for value in (self.max_per_trigger, self.min_partitions):
            if value is not None and value <= 0:
                raise ValueError("limits must be positive")

    def options(self, bounded: bool = False) -> dict[str, str]:
        chosen = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.min_partitions:
            chosen["minPartitions"] = str(self.min_partitions)
        if bounded:
            chosen["endingOffsets"] = "latest"
        elif self.max_per_trigger:
            chosen["maxOffsetsPerTrigger"] = str(self.max_per_trigger)
        return chosen

    def stream(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.format("kafka").options(**self.options()).load()

    def batch(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("kafka").options(**self.options(bounded=True)).load()


def order_topic(servers: str) -> KafkaTopic:
    """The order feed, always replayed from its beginning."""
    return KafkaTopic(servers, TOPIC_ORDERS, starting="earliest")
