"""Where keyed records are published: Kafka topics, or folders with the same contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class KafkaTopics:
    """Delivery is at least once: a retried micro-batch publishes again, consumers drop by event id."""

    servers: str
    producer: tuple[tuple[str, str], ...] = ()  # further producer settings, such as ("compression.type", "zstd")

    def options(self, topic: str) -> dict[str, str]:
        settings = {f"kafka.{name}": value for name, value in self.producer}
        return {"kafka.bootstrap.servers": self.servers, "topic": topic, **settings}

    def write(self, records: DataFrame, topic: str, batch_id: int) -> None:
        records.select("key", "value").write.format("kafka").options(**self.options(topic)).save()


@dataclass(frozen=True)
class FolderTopics:
    """One folder per topic and micro-batch; a retry replaces what the failed attempt left."""

    root: str

    def write(self, records: DataFrame, topic: str, batch_id: int) -> None:
        records.select("key", "value").write.mode("overwrite").parquet(f"{self.root}/{topic}/batch_id={batch_id}")
