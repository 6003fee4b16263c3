"""Validation and enrichment of decoded records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions import clamp, event_time, slow_request
from rillstone.functions.scalars import HIGHEST_TEMPERATURE, LOWEST_TEMPERATURE, SLOW_ABOVE_MS
from rillstone.schemas import KINDS, METRIC_TABLE_OF_KIND, SERVED_COLUMNS


@dataclass(frozen=True)
class CleaningRules:
    lowest_temperature: float = LOWEST_TEMPERATURE
    highest_temperature: float = HIGHEST_TEMPERATURE
    preserve_null_temperature: bool = False
    slow_above_ms: int = SLOW_ABOVE_MS
    version: str = "1.0.0"


DEFAULT_RULES = CleaningRules()


def has_required_fields() -> Column:
    return F.col("event_id").isNotNull() & F.col("event_type").isNotNull()


def enrich(rows: DataFrame, rules: CleaningRules = DEFAULT_RULES, stamp: bool = True) -> DataFrame:
    """Apply every rule whose input columns are present, in one projection.

    Working on whatever columns are there lets a query decode three fields and still clean them by the
    same rules as the full record.
    """
    present = set(rows.columns)
    replaced: dict[str, Column] = {}
    added: dict[str, Column] = {}
    if {"event_type", "temperature"} <= present:
        bounded = clamp(
            "temperature", rules.lowest_temperature, rules.highest_temperature, rules.preserve_null_temperature
        )
        is_sensor = F.col("event_type") == "sensor"
        replaced["temperature"] = F.when(is_sensor, bounded).otherwise(F.col("temperature"))
    if "revenue" in present:
        replaced["revenue"] = F.coalesce("revenue", F.lit(0.0))
    if "timestamp" in present:
        added["event_ts"] = event_time("timestamp")
    if stamp:
        added["processed_at"] = F.current_timestamp()
        added["pipeline_version"] = F.lit(rules.version)
    if {"event_type", "response_time_ms"} <= present:
        added["is_slow_request"] = slow_request(above=rules.slow_above_ms)
    kept = [replaced.get(name, F.col(name)).alias(name) for name in rows.columns]
    return rows.select(*kept, *[expr.alias(name) for name, expr in added.items()])


def clean(rows: DataFrame, rules: CleaningRules = DEFAULT_RULES, stamp: bool = True) -> DataFrame:
    """Drop rows without id or kind, then enrich the rest. Same plan on batch and streaming input."""
    return enrich(rows.where(has_required_fields()), rules, stamp)


def served(rows: DataFrame) -> DataFrame:
    """The 21 columns of the serving table."""
    return rows.select(*SERVED_COLUMNS)


def of_kind(rows: DataFrame, kind: str) -> DataFrame:
    """Rows of one kind; on a store this reads the kind's directories only."""
    wanted = F.col("event_type") == kind
    if "event_kind" in rows.columns and kind in KINDS:
        wanted &= F.col("event_kind") == kind
    return rows.where(wanted)


def metric_table(kind: Column | str = "event_type") -> Column:
    """Name of the metric table a kind feeds; NULL for other kinds."""
    kind = F.col(kind) if isinstance(kind, str) else kind
    chosen = None
    for name, table in METRIC_TABLE_OF_KIND.items():
        hit = kind == name
        chosen = F.when(hit, table) if chosen is None else chosen.when(hit, table)
    return chosen
