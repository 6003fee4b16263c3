"""Dashboard queries over the cleaned events and the metric tables.

Each takes the table it reads, a reference instant and a span. On a store with an `event_date` partition
the span also prunes days. Orderings carry a tiebreak so that results are reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions import as_instant, at_or_after_day, decimal_round, severity, within
from rillstone.functions.timing import AsOf
from rillstone.operators.clean import of_kind

HOUR = "1 hour"


def recent(rows: DataFrame, span: str | None, as_of: AsOf, ts: str = "event_ts") -> DataFrame:
    if span is None:
        return rows
    kept = rows.where(within(ts, span, as_of))
    if ts == "event_ts" and "event_date" in rows.columns:
        kept = kept.where(at_or_after_day("event_date", span, as_of))
    return kept


def _minute() -> Column:
    return F.date_trunc("minute", "event_ts")


def _total(rows: DataFrame, as_of: AsOf) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("value")).select(as_instant(as_of).alias("time"), "value")


# --- views -------------------------------------------------------------------------------------------


def event_rate_view(events: DataFrame) -> DataFrame:
    """`minute`, `event_type`, `event_count`."""
    return events.groupBy(_minute().alias("minute"), "event_type").agg(F.count(F.lit(1)).alias("event_count"))


def top_pages_view(events: DataFrame) -> DataFrame:
    """`page`, `visits`, `avg_ms`, `revenue`; consumers order it by visits."""
    return (
        of_kind(events, "clickstream")
        .groupBy("page")
        .agg(
            F.count(F.lit(1)).alias("visits"),
            decimal_round(F.avg("response_time_ms"), 0).alias("avg_ms"),
            F.sum("revenue").alias("revenue"),
        )
    )


def sensor_anomalies_view(events: DataFrame) -> DataFrame:
    """Sensor readings their producer flagged."""
    return (
        of_kind(events, "sensor")
        .where("is_anomaly")
        .select("event_id", "event_ts", "sensor_id", "location", "temperature", "humidity", "vibration")
    )


# --- panels ------------------------------------------------------------------------------------------


def event_rate_panel(events: DataFrame) -> DataFrame:
    return (
        event_rate_view(events)
        .select(F.col("minute").alias("time"), F.col("event_type").alias("metric"), F.col("event_count").alias("value"))
        .orderBy("time", "metric")
    )


def total_events(events: DataFrame, as_of: AsOf = None, span: str | None = HOUR) -> DataFrame:
    return _total(recent(events, span, as_of), as_of)


def anomaly_stat(events: DataFrame, as_of: AsOf = None, span: str | None = HOUR) -> DataFrame:
    flagged = of_kind(recent(events, span, as_of), "sensor").where("is_anomaly")
    return _total(flagged, as_of).withColumn("severity", severity("value"))


def slow_requests(events: DataFrame, as_of: AsOf = None, span: str | None = HOUR) -> DataFrame:
    # Only web requests can be slow: naming the kind lets a store partitioned by it skip the others.
    return _total(of_kind(recent(events, span, as_of), "clickstream").where("is_slow_request"), as_of)


def response_by_page(events: DataFrame, as_of: AsOf = None, span: str | None = HOUR) -> DataFrame:
    return (
        of_kind(recent(events, span, as_of), "clickstream")
        .groupBy("page")
        .agg(decimal_round(F.avg("response_time_ms"), 0).alias("avg_ms"))
        .orderBy(F.desc_nulls_first("avg_ms"), "page")
    )


def temperature_by_zone(metrics: DataFrame, as_of: AsOf = None, span: str | None = HOUR) -> DataFrame:
    return (
        recent(metrics, span, as_of, "window_start")
        .select(
            F.col("window_start").alias("time"),
            F.col("location").alias("metric"),
            decimal_round("avg_temperature", 2).alias("value"),
        )
        .orderBy("time", "metric")
    )


def revenue_per_minute(events: DataFrame, as_of: AsOf = None, span: str | None = HOUR) -> DataFrame:
    return (
        of_kind(recent(events, span, as_of), "clickstream")
        .groupBy(_minute().alias("time"))
        .agg(F.sum("revenue").alias("value"))
        .orderBy("time")
    )


def errors_by_service(metrics: DataFrame, as_of: AsOf = None, span: str | None = HOUR) -> DataFrame:
    return (
        recent(metrics, span, as_of, "window_start")
        .where(F.col("level") == "ERROR")
        .select(
            F.col("window_start").alias("time"),
            F.col("service").alias("metric"),
            F.col("log_count").alias("value"),
        )
        .orderBy("time", "metric")
    )


def top_pages(events: DataFrame, limit: int = 10) -> DataFrame:
    return (
        top_pages_view(events)
        .withColumn("revenue", decimal_round("revenue", 2))
        .orderBy(F.desc("visits"), "page")
        .limit(limit)
    )


def active_users(events: DataFrame, as_of: AsOf = None, span: str | None = HOUR) -> DataFrame:
    return (
        of_kind(recent(events, span, as_of), "clickstream")
        .groupBy(_minute().alias("time"))
        .agg(F.count_distinct("user_id").alias("value"))
        .orderBy("time")
    )


# --- ad-hoc queries ----------------------------------------------------------------------------------


def event_rate_recent(events: DataFrame, as_of: AsOf = None, span: str | None = "10 minutes") -> DataFrame:
    return event_rate_view(recent(events, span, as_of)).orderBy("minute", "event_type")


def revenue_by_page(events: DataFrame, as_of: AsOf = None, span: str | None = HOUR) -> DataFrame:
    return (
        of_kind(recent(events, span, as_of), "clickstream")
        .groupBy("page")
        .agg(decimal_round(F.sum("revenue"), 2).alias("revenue"))
        .orderBy(F.desc_nulls_first("revenue"), "page")
    )


def sensor_anomalies(events: DataFrame, limit: int = 20) -> DataFrame:
    return sensor_anomalies_view(events).orderBy(F.desc("event_ts"), "event_id").limit(limit)
