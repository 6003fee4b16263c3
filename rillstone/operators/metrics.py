"""Tumbling-window metrics per event kind, as one-step aggregates and as mergeable state.

A row of *state* holds only sums, counts, maxima and a distinct-count sketch, so state rows of the same
window from different batches, files or days can be added up; averages and distinct counts cannot.
`finish` turns state into the published metric columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.operators.clean import of_kind
from rillstone.schemas import METRIC_COLUMNS, METRIC_TABLE_OF_KIND

MINUTE = "1 minute"
WINDOW = ("window_start", "window_end")
KIND_OF_TABLE = {table: kind for kind, table in METRIC_TABLE_OF_KIND.items()}


@dataclass(frozen=True)
class MetricTable:
    """What one metric table groups by, reads, keeps as state and publishes."""

    name: str
    dims: tuple[str, ...]
    measures: tuple[str, ...]
    means: dict[str, str]  # published average -> measure
    maxima: dict[str, str]  # published maximum -> measure
    sums: dict[str, str]  # published sum -> measure
    flags: dict[str, str]  # published count of true -> measure
    count: str
    distinct: tuple[str, str] | None = None  # published distinct count, measure

    @property
    def kind(self) -> str:
        return KIND_OF_TABLE[self.name]

    @property
    def columns(self) -> tuple[str, ...]:
        return METRIC_COLUMNS[self.name]

    @property
    def record_fields(self) -> tuple[str, ...]:
        """Record fields a decoder has to build for this table."""
        return ("event_id", "event_type", "timestamp", *self.dims, *self.measures)


CLICKSTREAM = MetricTable(
    name="clickstream_metrics",
    dims=("page", "device", "country"),
    measures=("response_time_ms", "revenue", "user_id"),
    means={"avg_response_ms": "response_time_ms"},
    maxima={},
    sums={"total_revenue": "revenue"},
    flags={},
    count="event_count",
    distinct=("unique_users", "user_id"),
)
SENSOR = MetricTable(
    name="sensor_metrics",
    dims=("location",),
    measures=("temperature", "humidity", "vibration", "is_anomaly"),
    means={"avg_temperature": "temperature", "avg_humidity": "humidity", "avg_vibration": "vibration"},
    maxima={"max_temperature": "temperature"},
    sums={},
    flags={"anomaly_count": "is_anomaly"},
    count="reading_count",
)
LOG = MetricTable(
    name="log_metrics",
    dims=("service", "level"),
    measures=("status_code",),
    means={"avg_status_code": "status_code"},
    maxima={},
    sums={},
    flags={},
    count="log_count",
)
TABLES = {table.name: table for table in (CLICKSTREAM, SENSOR, LOG)}


def _windowed(rows: DataFrame, ts: str, every: str, *by: str):
    return rows.groupBy(F.window(ts, every).alias("_w"), *by)


def _unnest(rows: DataFrame, *names: str) -> DataFrame:
    bounds = [F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end")]
    return rows.select(*bounds, *names)


def _direct(table: MetricTable, distinct) -> list[Column]:
    aggs = [F.count(F.lit(1)).alias(table.count)]
    aggs += [F.avg(F.col(m).cast("double")).alias(out) for out, m in table.means.items()]
    aggs += [F.max(m).alias(out) for out, m in table.maxima.items()]
    aggs += [F.sum(m).alias(out) for out, m in table.sums.items()]
    aggs += [F.sum(F.col(m).cast("int")).alias(out) for out, m in table.flags.items()]
    if table.distinct:
        out, measure = table.distinct
        aggs.append(distinct(measure).alias(out))
    return aggs


def window_metrics(
    events: DataFrame, table: MetricTable, every: str = MINUTE, exact: bool = True
) -> DataFrame:
    """One final row per window and dimension.

    Partial aggregation runs before each shuffle, so a window or page that holds most rows costs one
    partial row per task. Exact distinct counts add a shuffle on (group, user), which spreads the hot
    group's users; streams cannot do that and use exact=False.
    """
    distinct = F.count_distinct if exact else F.approx_count_distinct
    grouped = _windowed(of_kind(events, table.kind), "event_ts", every, *table.dims)
    return _unnest(grouped.agg(*_direct(table, distinct)), *table.columns[:-2]).select(*table.columns)


def clickstream_metrics(events: DataFrame, every: str = MINUTE, exact: bool = True) -> DataFrame:
    return window_metrics(events, CLICKSTREAM, every, exact)


def sensor_metrics(events: DataFrame, every: str = MINUTE) -> DataFrame:
    return window_metrics(events, SENSOR, every)


def log_metrics(events: DataFrame, every: str = MINUTE) -> DataFrame:
    return window_metrics(events, LOG, every)


# --- mergeable state ---------------------------------------------------------------------------------


def _additive(table: MetricTable) -> dict[str, Column]:
    """State column -> aggregate over events; all of them add up with `sum`."""
    state = {table.count: F.count(F.lit(1))}
    for measure in dict.fromkeys(table.means.values()):
        state[f"{measure}_sum"] = F.sum(F.col(measure).cast("double"))
        state[f"{measure}_rows"] = F.count(measure)
    for measure in table.sums.values():
        state[f"{measure}_sum"] = F.sum(measure)
    for out, measure in table.flags.items():
        state[out] = F.sum(F.col(measure).cast("int"))
    return state


def _sketch_name(table: MetricTable) -> str | None:
    return f"{table.distinct[1]}_sketch" if table.distinct else None


def _sketch(table: MetricTable) -> Column:
    """Of hashes, as the sketch leaves out empty text, which counts as a value everywhere else."""
    member = F.col(table.distinct[1])
    return F.hll_sketch_agg(F.when(member.isNotNull(), F.xxhash64(member)))


def metric_state(
    events: DataFrame,
    table: MetricTable,
    every: str = MINUTE,
    members: bool = False,
    split_by: Sequence[str] = (),
) -> DataFrame:
    """State rows per window and dimension; with members=True per distinct member (user) as well.

    Member rows replace the sketch where distinct counts must be exact. `split_by` names further columns
    to keep apart, such as a batch number.
    """
    by = [*table.dims, *split_by, *([table.distinct[1]] if members else [])]
    aggs = {**_additive(table), **{out: F.max(m) for out, m in table.maxima.items()}}
    if table.distinct and not members:
        aggs[_sketch_name(table)] = _sketch(table)
    grouped = _windowed(of_kind(events, table.kind), "event_ts", every, *by)
    return _unnest(grouped.agg(*[expr.alias(name) for name, expr in aggs.items()]), *by, *aggs)


def merge_state(states: DataFrame, table: MetricTable, every: str | None = None) -> DataFrame:
    """Add up state rows of the same group, or roll them up to a longer window."""
    members = bool(table.distinct) and _sketch_name(table) not in states.columns
    by = [*table.dims, table.distinct[1]] if members else list(table.dims)
    aggs = {name: F.sum(name) for name in _additive(table)}
    aggs.update({out: F.max(out) for out in table.maxima})
    if table.distinct and not members:
        aggs[_sketch_name(table)] = F.hll_union_agg(_sketch_name(table))
    exprs = [expr.alias(name) for name, expr in aggs.items()]
    if every is None:
        return states.groupBy(*WINDOW, *by).agg(*exprs)
    return _unnest(_windowed(states, "window_start", every, *by).agg(*exprs), *by, *aggs)


def sketch_members(states: DataFrame, table: MetricTable) -> DataFrame:
    """Member rows to state rows with a sketch, without going back to the events."""
    aggs = {name: F.sum(name) for name in _additive(table)}
    aggs.update({out: F.max(out) for out in table.maxima})
    aggs[_sketch_name(table)] = _sketch(table)
    return states.groupBy(*WINDOW, *table.dims).agg(*[expr.alias(name) for name, expr in aggs.items()])


def _published(table: MetricTable, distinct: Column | None) -> list[Column]:
    exprs = {c: F.col(c) for c in (*table.dims, *WINDOW, table.count, *table.maxima, *table.flags)}
    exprs.update({out: F.try_divide(f"{m}_sum", f"{m}_rows") for out, m in table.means.items()})
    exprs.update({out: F.col(f"{m}_sum") for out, m in table.sums.items()})
    if table.distinct:
        exprs[table.distinct[0]] = distinct
    return [exprs[c].alias(c) for c in table.columns]


def finish(states: DataFrame, table: MetricTable, *carry: str) -> DataFrame:
    """Published metric columns of state rows; distinct counts are the sketch's estimate."""
    estimate = F.hll_sketch_estimate(_sketch_name(table)) if table.distinct else None
    return states.select(*_published(table, estimate), *carry)


def finish_members(states: DataFrame, table: MetricTable, every: str | None = None) -> DataFrame:
    """Published metric columns with exact distinct counts, from member rows of any number of batches.

    Merging first leaves one row per group and member, so the second step only counts rows.
    """
    member = table.distinct[1]
    aggs = [F.sum(name).alias(name) for name in _additive(table)]
    aggs += [F.max(name).alias(name) for name in table.maxima]
    groups = (
        merge_state(states, table, every)
        .groupBy(*WINDOW, *table.dims)
        .agg(*aggs, F.count(member).alias("_members"))
    )
    return groups.select(*_published(table, F.col("_members")))
