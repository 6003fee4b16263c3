"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Every query is run to the end over all its rows into a sink that discards them. The shared tables are built
first and timed on their own (`build_*`), as are the streaming replays (`replay_*`), so that a panel's time
is the panel's. The feed is read from stored wire files, as it would be from a topic.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from rillstone.operators import metrics as met
from rillstone.session import build_session, tune
from rillstone.workload import registry

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

DIRECT = [
    "raw_parse", "dead_letters", "record_quality", "events_cleaned", "dedup_events", "kind_to_table",
    "clickstream_metrics", "clickstream_metrics_day", "sensor_metrics", "sensor_metrics_day", "log_metrics",
    "log_metrics_day", "partials_merge_clickstream", "active_users_sketch", "order_lines",
]
PANELS = [
    "event_rate_per_minute", "total_events", "anomaly_stat", "response_by_page", "temperature_by_zone",
    "revenue_per_minute", "errors_by_service", "top_pages", "active_users", "slow_requests", "revenue_by_page",
    "sensor_anomalies", "retained_events", "response_by_page_last_day", "active_users_last_day",
]
REPLAYED = ["fanout_clickstream_metrics", "fanout_sensor_metrics", "fanout_log_metrics", "stream_store_scan"]


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return time.perf_counter() - start


def main() -> None:
    spark = tune(
        build_session(
            "rillstone-bench",
            **{
                "spark.master": f"local[{CPUS}]",
                "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
                "spark.sql.shuffle.partitions": CPUS,
                "spark.ui.enabled": "false",
                "spark.ui.showConsoleProgress": "false",
            },
        )
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    times: dict[str, float] = {}

    def run(name: str) -> None:
        queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    spark.read.parquet(f"{SF_DIR}/events.parquet").groupBy("event_type").count().collect()  # start the JVM's engine
    times["build_wire"] = timed(lambda: registry._wire(spark, SF_DIR))
    for name in DIRECT:
        times[name] = min(timed(lambda n=name: run(n)) for _ in range(RUNS))
    times["build_event_store"] = timed(lambda: registry._events(spark, SF_DIR))
    for table in (met.SENSOR, met.LOG):
        times[f"build_{table.name}"] = timed(lambda t=table: registry._metrics(spark, SF_DIR, t))
    for name in PANELS:
        times[name] = min(timed(lambda n=name: run(n)) for _ in range(RUNS))
    times["replay_fanout"] = timed(lambda: registry._fanout(spark, SF_DIR))
    times["replay_store"] = timed(lambda: registry._replayed_store(spark, SF_DIR))
    times["replay_windows"] = timed(lambda: registry._windows(spark, SF_DIR, met.CLICKSTREAM))
    for name in REPLAYED:
        times[name] = min(timed(lambda n=name: run(n)) for _ in range(RUNS))
    event_rows = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    result = {
        "metric": "total seconds, headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {name: round(seconds, 3) for name, seconds in times.items()},
        "sf": Path(SF_DIR).name.removeprefix("sf"),
        "rows": {"events": event_rows},
        "replay_events_per_second": round(event_rows / times["replay_fanout"]),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
