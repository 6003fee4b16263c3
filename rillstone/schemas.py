"""Record layouts, table layouts and topic names.

The names, types and orders below are fixed values: producers, stores and dashboards rely on them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STRING, INT, LONG, DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()
BOOLEAN, TIMESTAMP, BINARY = BooleanType(), TimestampType(), BinaryType()

COMMON_FIELDS: dict[str, DataType] = {
    "event_id": STRING,
    "event_type": STRING,
    "timestamp": STRING,
}

KIND_FIELDS: dict[str, dict[str, DataType]] = {
    "clickstream": {
        "user_id": STRING,
        "session_id": STRING,
        "action": STRING,
        "page": STRING,
        "device": STRING,
        "browser": STRING,
        "country": STRING,
        "response_time_ms": INT,
        "revenue": DOUBLE,
    },
    "sensor": {
        "sensor_id": STRING,
        "temperature": DOUBLE,
        "humidity": DOUBLE,
        "pressure": DOUBLE,
        "vibration": DOUBLE,
        "is_anomaly": BOOLEAN,
        "location": STRING,
    },
    "app_log": {
        "level": STRING,
        "service": STRING,
        "message": STRING,
        "trace_id": STRING,
        "status_code": INT,
    },
}

KINDS = tuple(KIND_FIELDS)

METRIC_TABLE_OF_KIND = {
    "clickstream": "clickstream_metrics",
    "sensor": "sensor_metrics",
    "app_log": "log_metrics",
}

RECORD_FIELDS: dict[str, DataType] = dict(COMMON_FIELDS)
for _fields in KIND_FIELDS.values():
    RECORD_FIELDS.update(_fields)

ORDER_FIELDS: dict[str, DataType] = {
    "order_id": STRING,
    "user": STRING,
    "item": STRING,
    "quantity": INT,
}

# What a broker hands over for every record.
WIRE_FIELDS: dict[str, DataType] = {
    "key": BINARY,
    "value": BINARY,
    "topic": STRING,
    "partition": INT,
    "offset": LONG,
    "timestamp": TIMESTAMP,
}

CLEANED_COLUMNS = (
    "kafka_key",
    "kafka_timestamp",
    *RECORD_FIELDS,
    "event_ts",
    "processed_at",
    "pipeline_version",
    "is_slow_request",
)

SERVED_COLUMNS = (
    "event_id",
    "event_type",
    "event_ts",
    "user_id",
    "sensor_id",
    "action",
    "page",
    "device",
    "country",
    "revenue",
    "temperature",
    "humidity",
    "vibration",
    "is_anomaly",
    "location",
    "level",
    "service",
    "status_code",
    "response_time_ms",
    "is_slow_request",
    "processed_at",
)

METRIC_COLUMNS = {
    "clickstream_metrics": (
        "page",
        "device",
        "country",
        "event_count",
        "avg_response_ms",
        "total_revenue",
        "unique_users",
        "window_start",
        "window_end",
    ),
    "sensor_metrics": (
        "location",
        "avg_temperature",
        "max_temperature",
        "avg_humidity",
        "avg_vibration",
        "anomaly_count",
        "reading_count",
        "window_start",
        "window_end",
    ),
    "log_metrics": (
        "service",
        "level",
        "log_count",
        "avg_status_code",
        "window_start",
        "window_end",
    ),
}

TOPIC_RAW = "events.raw"
TOPIC_CLEANED = "events.cleaned"
TOPIC_CURATED = "events.curated"
TOPIC_DEAD = "events.dlq"
TOPIC_ORDERS = "orders"

RETENTION = {
    TOPIC_RAW: "24 hours",
    TOPIC_CLEANED: "24 hours",
    TOPIC_CURATED: "48 hours",
    TOPIC_DEAD: "72 hours",
}


def struct_of(fields: dict[str, DataType]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


def record_schema(only: Iterable[str] | None = None) -> StructType:
    """The union record, or just the named fields of it (in record order)."""
    if only is None:
        return struct_of(RECORD_FIELDS)
    wanted = set(only)
    unknown = wanted - set(RECORD_FIELDS)
    if unknown:
        raise ValueError(f"not record fields: {sorted(unknown)}")
    return struct_of({n: t for n, t in RECORD_FIELDS.items() if n in wanted})


def kind_schema(kind: str) -> StructType:
    return struct_of({**COMMON_FIELDS, **KIND_FIELDS[kind]})


def wire_schema() -> StructType:
    return struct_of(WIRE_FIELDS)


def order_schema() -> StructType:
    return struct_of(ORDER_FIELDS)
