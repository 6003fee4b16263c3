from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rillstone.operators import metrics as met
from rillstone.operators.clean import clean
from rillstone.operators.decode import decode
from rillstone.operators.dedup import distinct_events
from rillstone.operators.wire import envelope
from rillstone.plans import serving
from rillstone.plans.views import register_views
from rillstone.sources.store import EventStore
from rillstone.workload.feed import event_feed, events_table

SF = "/root/testdata/sf0.001"
NOW = "2024-01-31 00:00:00"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    made = EventStore(f"{tmp_path_factory.mktemp('store')}/events")
    records = envelope(event_feed(events_table(spark, SF)))
    made.append(distinct_events(clean(decode(records, keep=("kafka_key", "kafka_timestamp", "partition", "offset")))))
    return made


def plan_of(rows) -> str:
    return rows._jdf.queryExecution().explainString(
        rows.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def scan_lines(rows) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in plan_of(rows).splitlines() if ": " in line)


def test_time_range_reaches_the_scan(spark, store):
    lines = scan_lines(serving.slow_requests(store.scan(spark), NOW, "24 hours"))
    assert "event_kind" in lines["PartitionFilters"] and "event_date" in lines["PartitionFilters"]
    for part in ("EqualTo(is_slow_request,true)", "GreaterThan(event_ts", "LessThanOrEqual(event_ts", "EqualTo(event_type"):
        assert part in lines["PushedFilters"]
    assert set(lines["ReadSchema"].removeprefix("struct<").rstrip(">").split(",")) == {
        "event_type:string", "event_ts:timestamp", "is_slow_request:boolean",
    }


def test_only_the_days_asked_for_are_read(spark, store):
    rows = store.scan(spark, span="24 hours", as_of=NOW)
    assert {r["event_date"] for r in rows.select("event_date").distinct().collect()} == {dt.date(2024, 1, 30)}


def test_scan_by_kind(spark, store):
    assert {r[0] for r in store.scan(spark, ["sensor"]).select("event_type").distinct().collect()} == {"sensor"}
    unknown = store.scan(spark, ["heartbeat"])
    assert unknown.count() > 0
    assert {r["event_kind"] for r in unknown.select("event_kind").distinct().collect()} == {"other"}


def test_pruned_and_unpruned_answers_agree(spark, store):
    pruned = serving.response_by_page(store.scan(spark), NOW, "72 hours").collect()
    plain = serving.response_by_page(store.scan(spark).drop("event_date", "event_kind"), NOW, "72 hours").collect()
    assert pruned == plain and pruned


def test_files_are_sorted_by_time(spark, store):
    """The layout's sort is the only one before the write, and it reaches the files."""
    rows = store.scan(spark, ["clickstream"]).where("event_ts is not null").select(
        F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"), "event_ts"
    )
    order = Window.partitionBy("f").orderBy("i")
    steps = rows.withColumn("before", F.lag("event_ts").over(order))
    assert steps.where("before > event_ts").isEmpty() and not steps.where("before < event_ts").isEmpty()


def test_top_k_is_not_a_full_sort(spark, store):
    for rows in (serving.top_pages(store.scan(spark)), serving.sensor_anomalies(store.scan(spark))):
        assert "TakeOrderedAndProject" in plan_of(rows)


def test_default_instant_is_now(spark, store):
    row = serving.total_events(store.scan(spark)).first()
    assert row["value"] == 0 and abs((row["time"] - dt.datetime.now()).total_seconds()) < 86_400 * 1.1


def test_order_by_average_puts_null_first(spark):
    rows = spark.createDataFrame(
        [("/a", 5), ("/b", None), ("/c", 9)], "page string, response_time_ms int"
    ).withColumns({"event_type": F.lit("clickstream"), "event_ts": F.current_timestamp()})
    assert [r["page"] for r in serving.response_by_page(rows).collect()] == ["/b", "/c", "/a"]


def test_unreadable_time_is_a_group_of_its_own(spark, store):
    assert serving.event_rate_view(store.scan(spark)).where("minute is null").count() > 0


def test_replacing_days_twice_changes_nothing(spark, store, tmp_path):
    copy = EventStore(f"{tmp_path}/copy")
    copy.append(store.scan(spark))
    before = copy.scan(spark).count()
    for _ in range(2):
        copy.replace_days(store.scan(spark, ["sensor"], "72 hours", NOW))
    lost = copy.scan(spark).count() - before
    # Whole days are replaced; the first day of the range is only partly in it.
    first_day = store.scan(spark, ["sensor"]).where("event_date = date'2024-01-28'")
    in_range = store.scan(spark, ["sensor"], "72 hours", NOW).where("event_date = date'2024-01-28'")
    assert lost == in_range.count() - first_day.count()


def test_sql_text_over_views(spark, store):
    events = store.scan(spark)
    metrics = {"sensor_metrics": met.sensor_metrics(events), "log_metrics": met.log_metrics(events)}
    register_views(events, metrics)
    by_sql = spark.sql(
        f"""select window_start as time, service as metric, log_count as value from log_metrics
        where level = 'ERROR' and window_start > timestamp'{NOW}' - interval '30 days' order by 1, 2"""
    )
    assert by_sql.collect() == serving.errors_by_service(metrics["log_metrics"], NOW, "30 days").collect()
    top = spark.sql("select page, visits from v_top_pages limit 10").collect()
    assert [r["visits"] for r in top] == sorted((r["visits"] for r in top), reverse=True)
    assert spark.sql("select * from v_sensor_anomalies limit 20").count() > 0
    rate = spark.sql(
        "select date_trunc('minute', event_ts), event_type, count(*) from events_cleaned group by 1, 2 order by 1"
    )
    assert rate.count() == spark.table("v_event_rate_per_minute").count()
    with pytest.raises(ValueError):
        register_views(events, {"nope": events})
