"""Broker records: take the envelope apart, and build keyed records to publish."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions import record_key
from rillstone.schemas import COMMON_FIELDS, KIND_FIELDS, RECORD_FIELDS

KEEP_NULLS = {"ignoreNullFields": "false"}


def envelope(wire: DataFrame) -> DataFrame:
    """Text key and body plus the record's position and arrival time."""
    return wire.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_json"),
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
    )


def record_json() -> Column:
    """One event as JSON with the fields of its kind, NULLs kept. Other kinds carry every field."""

    def body(names) -> Column:
        return F.to_json(F.struct(*names), KEEP_NULLS)

    known = iter(KIND_FIELDS.items())
    kind, fields = next(known)
    chosen = F.when(F.col("event_type") == kind, body([*COMMON_FIELDS, *fields]))
    for kind, fields in known:
        chosen = chosen.when(F.col("event_type") == kind, body([*COMMON_FIELDS, *fields]))
    return chosen.otherwise(body(list(RECORD_FIELDS)))


def keyed_records(events: DataFrame, *carry: str) -> DataFrame:
    """`key` and `value` text columns for a topic; `carry` names columns to take along."""
    return events.select(
        record_key("user_id", "sensor_id", "event_id").alias("key"), record_json().alias("value"), *carry
    )


def keyed_rows(rows: DataFrame, key: Column, *columns: str) -> DataFrame:
    """Any table as topic records: the given key and all (or the named) columns as JSON."""
    names = columns or rows.columns
    return rows.select(key.cast("string").alias("key"), F.to_json(F.struct(*names), KEEP_NULLS).alias("value"))
