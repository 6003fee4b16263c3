from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rillstone.operators import metrics as met
from rillstone.operators.metrics import CLICKSTREAM, LOG, SENSOR, TABLES
from rillstone.schemas import METRIC_COLUMNS, RECORD_FIELDS, struct_of

T0 = dt.datetime(2024, 1, 1, 0, 0)


def events(spark, *rows):
    """Rows as (seconds after T0, dict of fields)."""
    schema = struct_of(RECORD_FIELDS).add("event_ts", "timestamp")
    data = []
    for second, fields in rows:
        stamp = None if second is None else T0 + dt.timedelta(seconds=second)
        data.append((*[fields.get(name) for name in RECORD_FIELDS], stamp))
    return spark.createDataFrame(data, schema)


def click(user, ms=100, revenue=0.0, page="/home"):
    return {"event_type": "clickstream", "page": page, "device": "mobile", "country": "US", "user_id": user,
            "response_time_ms": ms, "revenue": revenue}


def reading(temperature=20.0, anomaly=False, zone="zone_1"):
    return {"event_type": "sensor", "location": zone, "temperature": temperature, "humidity": 50.0, "vibration": 0.5,
            "is_anomaly": anomaly}


@pytest.fixture(scope="module")
def many(spark):
    """Three days of all kinds with NULLs, skewed to one page and one user."""
    n = F.col("id")
    rows = spark.range(20_000)
    pick = {
        "event_id": n.cast("string"),
        "event_type": F.element_at(F.array(*map(F.lit, ("clickstream", "sensor", "app_log"))), (n % 3 + 1).cast("int")),
        "page": F.when(n % 2 == 0, "/home").otherwise(F.concat(F.lit("/p"), (n % 5).cast("string"))),
        "device": F.when(n % 7 == 0, "tablet").otherwise("mobile"),
        "country": F.when(n % 11 != 0, "US"),
        "user_id": F.when(n % 13 != 0, F.when(n % 3 == 0, "u0").otherwise(F.concat(F.lit("u"), (n % 40).cast("string")))),
        "response_time_ms": F.when(n % 17 != 0, (n % 2000).cast("int")),
        "revenue": (n % 100).cast("double"),
        "location": F.concat(F.lit("zone_"), (n % 5).cast("string")),
        "temperature": F.when(n % 19 != 0, (n % 90).cast("double")),
        "humidity": (n % 100).cast("double"),
        "vibration": (n % 9).cast("double"),
        "is_anomaly": F.when(n % 23 != 0, n % 20 == 0),
        "service": F.concat(F.lit("s"), (n % 4).cast("string")),
        "level": F.when(n % 5 == 0, "ERROR").otherwise("INFO"),
        "status_code": F.when(n % 29 != 0, (200 + n % 300).cast("int")),
        "event_ts": F.timestamp_seconds(F.lit(1704067200) + n * 13),
        "part": (n % 7).cast("int"),
    }
    return rows.select(*[expr.alias(name) for name, expr in pick.items()]).cache()


def as_set(rows):
    return {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows.collect()}


@pytest.mark.parametrize("name", TABLES)
def test_column_order(spark, name):
    rows = met.window_metrics(events(spark, (0, click("a"))), TABLES[name])
    assert tuple(rows.columns) == METRIC_COLUMNS[name]


def test_clickstream(spark):
    rows = events(spark, (0, click("a", 100, 1.5)), (59, click("b", 300, None)), (30, click("a", None, 2.5)),
                  (60, click("a")), (10, reading()))
    got = {r["window_start"]: r for r in met.clickstream_metrics(rows).collect()}
    first = got[T0]
    assert (first["event_count"], first["avg_response_ms"], first["total_revenue"], first["unique_users"]) == (3, 200.0, 4.0, 2)
    assert first["window_end"] == T0 + dt.timedelta(minutes=1)
    assert len(got) == 2


def test_sensor_nulls(spark):
    rows = events(spark, (0, reading(None, None)), (1, reading(None, None)), (61, reading(70.0, True)),
                  (62, reading(30.0, None)))
    first, second = met.sensor_metrics(rows).orderBy("window_start").collect()
    assert (first["avg_temperature"], first["max_temperature"], first["anomaly_count"], first["reading_count"]) == (
        None, None, None, 2,
    )
    assert (second["avg_temperature"], second["max_temperature"], second["anomaly_count"]) == (50.0, 70.0, 1)


def test_rows_without_time_are_in_no_window(spark):
    assert met.clickstream_metrics(events(spark, (None, click("a")))).isEmpty()


def test_unknown_kind_is_in_no_table(spark):
    rows = events(spark, (0, {"event_type": "heartbeat", "page": "/home"}))
    assert all(met.window_metrics(rows, table).isEmpty() for table in TABLES.values())


@pytest.mark.parametrize("every", [None, "1 day"])
@pytest.mark.parametrize("table", [SENSOR, LOG])
def test_merged_state_equals_direct(many, table, every):
    state = met.metric_state(many, table, "1 hour", split_by=["part"])
    assert as_set(met.finish(met.merge_state(state, table, every), table)) == as_set(
        met.window_metrics(many, table, every or "1 hour")
    )


@pytest.mark.parametrize("every", [None, "1 day"])
def test_merged_members_equal_direct(many, every):
    state = met.metric_state(many, CLICKSTREAM, "1 hour", members=True, split_by=["part"])
    assert as_set(met.finish_members(state, CLICKSTREAM, every)) == as_set(
        met.clickstream_metrics(many, every or "1 hour")
    )


def test_sketch_is_close(spark):
    users = spark.range(60_000).select(
        F.lit("clickstream").alias("event_type"), F.lit("/home").alias("page"), F.lit("m").alias("device"),
        F.lit("US").alias("country"), F.lit(1).alias("response_time_ms"), F.lit(0.0).alias("revenue"),
        (F.col("id") % 20_000).cast("string").alias("user_id"), (F.col("id") % 3).alias("part"),
        F.lit("2024-01-01").cast("timestamp").alias("event_ts"),
    )
    state = met.metric_state(users, CLICKSTREAM, split_by=["part"])
    assert state.count() == 3
    row = met.finish(met.merge_state(state, CLICKSTREAM), CLICKSTREAM).first()
    assert row["event_count"] == 60_000
    assert abs(row["unique_users"] - 20_000) < 20_000 * 0.05


def test_partial_aggregation_runs_before_the_shuffle(many, capsys):
    met.sensor_metrics(many).explain()
    plan = capsys.readouterr().out
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_avg")
    assert plan.count("Exchange") == 1
