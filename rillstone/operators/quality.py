"""Counts that tell how healthy a feed is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.functions import event_time
from rillstone.operators.clean import metric_table
from rillstone.operators.decode import MALFORMED, NO_ID, NO_TYPE
from rillstone.schemas import KINDS

REPORT_FIELDS = ("event_id", "event_type", "timestamp", "temperature", "response_time_ms")


def quality_report(checked: DataFrame) -> DataFrame:
    """`check_name`, `row_count` over the output of decode_checked: one pass, one row per check."""
    accepted = F.col("reject_reason").isNull()
    checks = {
        "records": F.lit(True),
        "accepted": accepted,
        MALFORMED: F.col("reject_reason") == MALFORMED,
        NO_ID: F.col("reject_reason") == NO_ID,
        NO_TYPE: F.col("reject_reason") == NO_TYPE,
        "field_fault": F.col("field_fault"),
        "unreadable_timestamp": accepted & event_time("timestamp").isNull(),
        "unknown_kind": accepted & ~F.col("event_type").isin(*KINDS),
        "sensor_without_temperature": accepted
        & (F.col("event_type") == "sensor")
        & F.col("temperature").isNull(),
    }
    totals = checked.agg(*[F.count_if(test).alias(name) for name, test in checks.items()])
    return totals.unpivot([], list(checks), "check_name", "row_count")


def kind_routing(rows: DataFrame) -> DataFrame:
    """How many cleaned rows of each kind go to which metric table (NULL: none)."""
    return (
        rows.groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("metric_table", metric_table("event_type"))
    )
