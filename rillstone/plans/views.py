"""The serving tables and views under their SQL names."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rillstone.plans.serving import event_rate_view, sensor_anomalies_view, top_pages_view
from rillstone.schemas import METRIC_COLUMNS


def register_views(events: DataFrame, metrics: dict[str, DataFrame] | None = None) -> list[str]:
    """Make events_cleaned, the given metric tables and the three views available to spark.sql."""
    made = {
        "events_cleaned": events,
        "v_event_rate_per_minute": event_rate_view(events),
        "v_top_pages": top_pages_view(events).orderBy("visits", ascending=False),
        "v_sensor_anomalies": sensor_anomalies_view(events).orderBy("event_ts", ascending=False),
    }
    for name, table in (metrics or {}).items():
        if name not in METRIC_COLUMNS:
            raise ValueError(f"unknown metric table {name!r}")
        made[name] = table
    for name, table in made.items():
        table.createOrReplaceTempView(name)
    return list(made)
