"""Keep recent data, drop expired days."""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions import at_or_after_day, within
from rillstone.functions.timing import AsOf, as_instant
from rillstone.schemas import RETENTION
from rillstone.sources.store import EventStore


def retained(
    rows: DataFrame, topic: str, as_of: AsOf = None, ts: str = "kafka_timestamp", day: str | None = None
) -> DataFrame:
    """Rows a topic still keeps at `as_of`. A broker expires records by arrival, whatever time they carry.

    `day` names a date directory that belongs to `ts`; it is used to skip days. An event-date directory says
    nothing about arrival.
    """
    keep = RETENTION[topic]
    recent = rows.where(within(ts, keep, as_of))
    return recent.where(at_or_after_day(day, keep, as_of)) if day else recent


def retained_of_store(spark: SparkSession, store: EventStore, topic: str, as_of: AsOf = None) -> DataFrame:
    """The same of the event store, opening only files whose noted arrivals reach into the time that is kept."""
    since = as_instant(as_of) - F.expr(f"INTERVAL {RETENTION[topic]}")
    return retained(store.arrived_since(spark, since), topic, as_of)


def drop_days_before(spark: SparkSession, root: str, day: dt.date, column: str = "event_date") -> list[str]:
    """Delete the day partitions of a Parquet store that lie wholly before `day`; returns their paths.

    Only directory names are read, so the cost follows the number of partitions, not the data. Rows
    without a date sit in the default partition and are kept.
    """
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dropped: list[str] = []
    pending = [base]
    while pending:
        for status in fs.listStatus(pending.pop()):
            name = status.getPath().getName()
            if not status.isDirectory() or name.startswith(("_", ".")):
                continue
            label, _, value = name.partition("=")
            if label != column:
                pending.append(status.getPath())
                continue
            try:
                expired = dt.date.fromisoformat(unquote(value)) < day
            except ValueError:
                expired = False
            if expired:
                fs.delete(status.getPath(), True)
                dropped.append(status.getPath().toString())
    return sorted(dropped)
