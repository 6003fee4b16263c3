"""Schema-on-read JSON decoding and the split into accepted and rejected records.

The struct from `from_json` is flattened through `inline`, not through `select("data.*")`. A filter on a
flattened field would otherwise be pushed below the projection, and Spark would parse the text once per
filtered field and once more for the row. A generator's output cannot be pushed through, so each text is
parsed once. For the same reason the caller says which fields it needs: the parser then builds no others.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rillstone.schemas import RECORD_FIELDS, kind_schema, record_schema

POSITION = ("partition", "offset")
ARRIVAL = ("kafka_key", "kafka_timestamp")

MALFORMED = "malformed_json"
NO_ID = "missing_event_id"
NO_TYPE = "missing_event_type"

_CORRUPT = "_corrupt_text"


def _parse(rows: DataFrame, schema: StructType, keep: Iterable[str], text: str, options=None) -> DataFrame:
    return rows.select(*keep, F.inline(F.array(F.from_json(text, schema, options))))


def decode(
    records: DataFrame,
    fields: Iterable[str] | None = None,
    keep: Iterable[str] = ARRIVAL,
    text: str = "raw_json",
) -> DataFrame:
    """Every record as a flat row; unreadable text gives a row of NULLs, a bad field a single NULL."""
    return _parse(records, record_schema(fields), keep, text)


def decode_kind(records: DataFrame, kind: str, keep: Iterable[str] = ARRIVAL) -> DataFrame:
    """Rows of one kind with that kind's fields only."""
    return _parse(records, kind_schema(kind), keep, "raw_json").where(F.col("event_type") == kind)


def is_object(text: Column) -> Column:
    """The text is a JSON object, whatever its fields hold."""
    return F.coalesce(F.ltrim(text).startswith("{") & F.get_json_object(text, "$").isNotNull(), F.lit(False))


def reject_reason(event_id: Column, event_type: Column, text: Column) -> Column:
    """Why a record is set aside; NULL if it is not. The rule does not know which other fields were decoded, so
    every report of the same record agrees. Only records without both ids are looked at a second time."""
    return (
        F.when(event_id.isNull() & event_type.isNull() & ~is_object(text), MALFORMED)
        .when(event_id.isNull(), NO_ID)
        .when(event_type.isNull(), NO_TYPE)
    )


def decode_checked(
    records: DataFrame,
    fields: Iterable[str] | None = None,
    keep: Iterable[str] = (*ARRIVAL, *POSITION),
) -> DataFrame:
    """Decoded rows plus `reject_reason` (NULL when accepted), `field_fault` and, for rejects, `raw_json`.

    `field_fault` marks an accepted row in which one of the decoded fields had a value of the wrong type.
    """
    schema = record_schema(fields)
    keep = list(keep)
    checked = StructType([*schema.fields, StructField(_CORRUPT, StringType(), True)])
    rows = _parse(records, checked, [*keep, "raw_json"], "raw_json", {"columnNameOfCorruptRecord": _CORRUPT})
    reason = reject_reason(F.col("event_id"), F.col("event_type"), F.col("raw_json"))
    with_reason = rows.withColumn("reject_reason", reason)
    return with_reason.select(
        *keep,
        *schema.names,
        "reject_reason",
        (F.col("reject_reason").isNull() & F.col(_CORRUPT).isNotNull()).alias("field_fault"),
        F.when(F.col("reject_reason").isNotNull(), F.col("raw_json")).alias("raw_json"),
    )


def dead_letters(records: DataFrame, keep: Iterable[str] = (*ARRIVAL, *POSITION)) -> DataFrame:
    """The records that cleaning would drop, as text, with the reason. Only the two ids are parsed."""
    keep = list(keep)
    checked = decode_checked(records, ["event_id", "event_type"], keep)
    return checked.where(F.col("reject_reason").isNotNull()).select(
        *keep, "event_id", "reject_reason", "raw_json"
    )


def undeclared_fields(records: DataFrame, text: str = "raw_json") -> DataFrame:
    """(field, type, records) of the fields that the declared layouts do not have, whatever they hold.

    Each text is parsed once, into a VARIANT; text that is no object has no fields. A field that comes in several types
    has a row for each.
    """
    parsed = records.select(F.inline(F.array(F.struct(F.try_parse_json(F.col(text)).alias("v")))))
    objects = parsed.where(F.schema_of_variant("v").startswith("OBJECT"))
    each = objects.lateralJoin(records.sparkSession.tvf.variant_explode(F.col("v").outer()))
    strange = each.where(~F.col("key").isin(*RECORD_FIELDS)).select("key", F.schema_of_variant("value").alias("kind"))
    return strange.groupBy(F.col("key").alias("field"), F.col("kind").alias("type")).agg(F.count(F.lit(1)).alias("records"))
