from __future__ import annotations

import json
import math

import pytest
from pyspark.sql import functions as F

from rillstone.operators import decode as dec
from rillstone.operators.clean import clean, enrich, served
from rillstone.operators.quality import quality_report
from rillstone.operators.wire import envelope, keyed_records, record_json
from rillstone.schemas import CLEANED_COLUMNS, KIND_FIELDS, RECORD_FIELDS, SERVED_COLUMNS, record_schema, struct_of

EDGE = {
    "not json": dec.MALFORMED,
    "": dec.MALFORMED,
    "   ": dec.MALFORMED,
    '{"event_id":"a"': dec.MALFORMED,
    "{}": dec.NO_ID,
    '{"event_type":"sensor"}': dec.NO_ID,
    '{"event_id":"a"}': dec.NO_TYPE,
    '{"event_id":"a","event_type":null}': dec.NO_TYPE,
    '{"event_id":"a","event_type":"sensor"}': None,
    '{"event_id":"a","event_type":"other","extra":[1,2]}': None,
    '{"event_id":17,"event_type":"sensor"}': None,
    '{"event_id":"a","event_type":"clickstream","response_time_ms":"abc"}': None,
}


def wire(spark, texts):
    rows = [(None, text.encode() if text is not None else None, i) for i, text in enumerate(texts)]
    base = spark.createDataFrame(rows, "key binary, value binary, i int")
    return base.select(
        "key",
        "value",
        F.lit("events.raw").alias("topic"),
        (F.col("i") % 3).cast("int").alias("partition"),
        F.col("i").cast("bigint").alias("offset"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
    )


def parsed(spark, **record):
    rows = dec.decode(envelope(wire(spark, [json.dumps(record)])))
    return rows.first().asDict()


def test_reject_reasons(spark):
    rows = dec.decode_checked(envelope(wire(spark, list(EDGE)))).orderBy("offset").collect()
    assert [row["reject_reason"] for row in rows] == list(EDGE.values())
    for text, row in zip(EDGE, rows):
        assert row["raw_json"] == (text if EDGE[text] else None)


def test_the_reason_does_not_depend_on_the_fields_decoded(spark):
    """A wrong-typed field makes no record unreadable, whether it is decoded or not."""
    texts = [
        '{"response_time_ms":"abc"}', '{"status_code":"bad","page":"p"}', '{"event_id":"a","status_code":"bad"}',
        '{"event_id":"a","event_type":"sensor","temper', "{", "[]", "", None, '{"event_type":"sensor"}', "{}",
    ]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, raw_json string")
    few, some, every = (
        [r["reject_reason"] for r in dec.decode_checked(rows, fields, keep=["n"]).orderBy("n").collect()]
        for fields in (["event_id", "event_type"], ["event_id", "event_type", "page"], None)
    )
    assert few == some == every == [
        dec.NO_ID, dec.NO_ID, dec.NO_TYPE, *[dec.MALFORMED] * 5, dec.NO_ID, dec.NO_ID,
    ]


def test_missing_body_is_rejected(spark):
    row = dec.decode_checked(envelope(wire(spark, [None]))).first()
    assert row["reject_reason"] == dec.MALFORMED


def test_rejects_are_what_cleaning_drops(spark):
    records = envelope(wire(spark, list(EDGE)))
    kept = clean(dec.decode(records, keep=("offset",))).select("offset")
    dropped = dec.dead_letters(records).select("offset")
    everything = {(i,) for i in range(len(EDGE))}
    assert {tuple(r) for r in kept.collect()} | {tuple(r) for r in dropped.collect()} == everything
    assert kept.intersect(dropped).isEmpty()


@pytest.mark.parametrize(
    "field, value, expected",
    [
        ("response_time_ms", 12, 12),
        ("response_time_ms", "abc", None),
        ("response_time_ms", 12.5, None),
        ("response_time_ms", 99999999999, None),
        ("revenue", 3, 3.0),
        ("revenue", "3.5", None),
        ("is_anomaly", True, True),
        ("is_anomaly", "true", None),
        ("user_id", 7, "7"),
    ],
)
def test_a_bad_field_nulls_only_itself(spark, field, value, expected):
    row = parsed(spark, **{"event_id": "a", "event_type": "sensor", "location": "zone_1", field: value})
    assert row[field] == expected
    assert (row["event_id"], row["location"]) == ("a", "zone_1")


def test_nan_and_repeated_key(spark):
    rows = dec.decode(envelope(wire(spark, ['{"event_id":"a","event_id":"b","revenue":NaN}']))).first()
    assert rows["event_id"] == "b"
    assert math.isnan(rows["revenue"])


def test_field_fault_is_flagged_on_accepted_rows(spark):
    texts = [
        '{"event_id":"a","event_type":"clickstream","response_time_ms":"abc"}',
        '{"event_id":"b","event_type":"clickstream","response_time_ms":5}',
        "not json",
    ]
    rows = dec.decode_checked(envelope(wire(spark, texts))).orderBy("offset").collect()
    assert [row["field_fault"] for row in rows] == [True, False, False]


def test_json_is_parsed_once_per_row(spark, capsys):
    clean(dec.decode(envelope(wire(spark, ["{}"])), ["event_id", "event_type", "page"])).explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("from_json(") == 1
    assert "StructField(page" in plan and "StructField(browser" not in plan


def test_unknown_field_name_is_an_error():
    with pytest.raises(ValueError):
        record_schema(["event_id", "nope"])


def test_decode_kind_has_the_kinds_fields(spark):
    text = json.dumps({"event_id": "a", "event_type": "sensor", "temperature": 1.5, "page": "/home"})
    rows = dec.decode_kind(envelope(wire(spark, [text])), "sensor", keep=())
    assert rows.columns == ["event_id", "event_type", "timestamp", *KIND_FIELDS["sensor"]]
    assert rows.first()["temperature"] == 1.5


def test_clean_columns_and_values(spark):
    text = json.dumps(
        {"event_id": "a", "event_type": "sensor", "timestamp": "2024-01-05T10:00:00+00:00", "temperature": 999.0}
    )
    rows = clean(dec.decode(envelope(wire(spark, [text]))))
    assert tuple(rows.columns) == CLEANED_COLUMNS
    row = rows.first()
    assert (row["temperature"], row["revenue"], row["pipeline_version"], row["is_slow_request"]) == (
        150.0, 0.0, "1.0.0", False,
    )
    assert str(row["event_ts"]) == "2024-01-05 10:00:00"
    assert tuple(served(rows).columns) == SERVED_COLUMNS


def test_clamp_applies_to_sensors_only(spark):
    texts = [json.dumps({"event_id": k, "event_type": k, "temperature": 999.0}) for k in ("sensor", "app_log")]
    rows = clean(dec.decode(envelope(wire(spark, texts)))).collect()
    assert {r["event_type"]: r["temperature"] for r in rows} == {"sensor": 150.0, "app_log": 999.0}


def test_enrich_works_on_any_subset(spark):
    rows = enrich(dec.decode(envelope(wire(spark, ['{"event_id":"a"}'])), ["event_id"], keep=()), stamp=False)
    assert rows.columns == ["event_id"]


def test_encode_keeps_nulls_of_the_kind_only(spark):
    values = {"event_id": "a", "event_type": "sensor", "sensor_id": "s", "temperature": 1.0}
    row = tuple(values.get(name) for name in RECORD_FIELDS)
    events = spark.createDataFrame([row], struct_of(RECORD_FIELDS))
    body = json.loads(events.select(record_json().alias("v")).first()["v"])
    assert list(body) == ["event_id", "event_type", "timestamp", *KIND_FIELDS["sensor"]]
    assert body["humidity"] is None and body["temperature"] == 1.0
    assert keyed_records(events).first()["key"] == "s"


def test_encode_of_unknown_kind_keeps_everything(spark):
    row = tuple("x" if name in ("event_id", "event_type") else None for name in RECORD_FIELDS)
    events = spark.createDataFrame([row], struct_of(RECORD_FIELDS))
    assert list(json.loads(events.select(record_json().alias("v")).first()["v"])) == list(RECORD_FIELDS)


def test_quality_report(spark):
    rows = quality_report(dec.decode_checked(envelope(wire(spark, list(EDGE)))))
    counts = {r["check_name"]: r["row_count"] for r in rows.collect()}
    assert counts["records"] == len(EDGE)
    assert counts["accepted"] == 4
    assert (counts[dec.MALFORMED], counts[dec.NO_ID], counts[dec.NO_TYPE]) == (4, 2, 2)
    assert counts["field_fault"] == 1
    assert counts["unknown_kind"] == 1
    assert counts["unreadable_timestamp"] == 4
    assert counts["sensor_without_temperature"] == 2


def test_undeclared_fields(spark):
    texts = [
        '{"event_id":"a","page":"/x","extra":1}', '{"event_id":"b","extra":"one","deep":{"page":1}}', '{"extra":2,"deep":{"page":3}}',
        "[1]", "not json", "", None, '{"none":null}', '"text"', '{"event_id":"c"}',
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "raw_json string")
    found = dec.undeclared_fields(rows)
    want = {("extra", "BIGINT", 2), ("extra", "STRING", 1), ("deep", "OBJECT<page: BIGINT>", 2), ("none", "VOID", 1)}
    assert set(map(tuple, found.collect())) == want
    plan = dec.undeclared_fields(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1 and "NestedLoop" not in plan
