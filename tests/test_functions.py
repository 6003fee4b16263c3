from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from rillstone import functions as fn
from rillstone.operators.clean import metric_table


def evaluate(spark, expr, **values):
    """One expression over one row of typed values given as (value, type)."""
    names = ", ".join(f"`{name}` {kind}" for name, (_, kind) in values.items()) or "x int"
    row = tuple(value for value, _ in values.values()) or (0,)
    return spark.createDataFrame([row], names).select(expr.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "given, expected",
    [(-100.0, -50.0), (200.0, 150.0), (37.0, 37.0), (-50.0, -50.0), (150.0, 150.0), (None, 150.0), (math.nan, 150.0)],
)
def test_clamp(spark, given, expected):
    assert evaluate(spark, fn.clamp("t"), t=(given, "double")) == expected


def test_clamp_can_keep_null(spark):
    assert evaluate(spark, fn.clamp("t", preserve_null=True), t=(None, "double")) is None
    assert evaluate(spark, fn.clamp("t", preserve_null=True), t=(-99.0, "double")) == -50.0


@pytest.mark.parametrize(
    "kind, millis, slow",
    [
        ("clickstream", 2000, True),
        ("clickstream", 1501, True),
        ("clickstream", 1500, False),
        ("clickstream", 500, False),
        ("clickstream", None, False),
        ("sensor", 2000, False),
        (None, 2000, False),
    ],
)
def test_slow_request(spark, kind, millis, slow):
    got = evaluate(spark, fn.slow_request("k", "ms"), k=(kind, "string"), ms=(millis, "int"))
    assert got is slow


def test_hot_temperature(spark):
    assert evaluate(spark, fn.hot_temperature("t"), t=(70.0, "double")) is True
    assert evaluate(spark, fn.hot_temperature("t"), t=(55.0, "double")) is False
    assert evaluate(spark, fn.hot_temperature("t"), t=(30.0, "double")) is False


@pytest.mark.parametrize(
    "user, sensor, event, key",
    [("u", "s", "e", "u"), ("", "s", "e", "s"), (None, "", "e", "e"), (None, None, "", ""), (None, None, None, None)],
)
def test_record_key(spark, user, sensor, event, key):
    got = evaluate(
        spark, fn.record_key("u", "s", "e"), u=(user, "string"), s=(sensor, "string"), e=(event, "string")
    )
    assert got == key


@pytest.mark.parametrize("value, places, expected", [(2.675, 2, 2.68), (-13.115, 2, -13.12), (0.5, 0, 1.0), (1.005, 2, 1.01)])
def test_decimal_round(spark, value, places, expected):
    assert evaluate(spark, fn.decimal_round("v", places), v=(value, "double")) == expected


@pytest.mark.parametrize("count, colour", [(0, "green"), (4, "green"), (5, "yellow"), (9, "yellow"), (10, "red")])
def test_severity(spark, count, colour):
    assert evaluate(spark, fn.severity("n"), n=(count, "bigint")) == colour


def test_order_line(spark):
    got = evaluate(spark, fn.order_line("q", "i", "u"), q=(3, "int"), i=("Milk", "string"), u=("Ann", "string"))
    assert got == "Received order: 3 x Milk from Ann"


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-05T10:00:00+00:00", "2024-01-05 10:00:00"),
        ("2024-01-05T10:00:00.123456+00:00", "2024-01-05 10:00:00.123456"),
        ("2024-01-05T10:00:00+05:30", "2024-01-05 04:30:00"),
        ("bad", None),
        ("", None),
        ("2024-13-05T10:00:00+00:00", None),
        (None, None),
    ],
)
def test_event_time(spark, text, expected):
    assert evaluate(spark, fn.event_time("t").cast("string"), t=(text, "string")) == expected


@pytest.mark.parametrize(
    "ts, inside", [("09:00:00", False), ("09:00:01", True), ("10:00:00", True), ("10:00:01", False)]
)
def test_within_is_half_open(spark, ts, inside):
    expr = fn.within(F.to_timestamp(F.lit(f"2024-01-05 {ts}")), "1 hour", "2024-01-05 10:00:00")
    assert evaluate(spark, expr) is inside


def test_within_without_instant_is_open_above(spark):
    ahead = F.current_timestamp() + F.expr("interval 1 day")
    assert evaluate(spark, fn.within(ahead, "1 hour")) is True
    assert evaluate(spark, fn.within(ahead, "1 hour", dt.datetime.now())) is False


def test_routing(spark):
    assert evaluate(spark, metric_table("k"), k=("clickstream", "string")) == "clickstream_metrics"
    assert evaluate(spark, metric_table("k"), k=("sensor", "string")) == "sensor_metrics"
    assert evaluate(spark, metric_table("k"), k=("app_log", "string")) == "log_metrics"
    assert evaluate(spark, metric_table("k"), k=("heartbeat", "string")) is None
