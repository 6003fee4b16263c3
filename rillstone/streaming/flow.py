"""Stateful steps on an unbounded feed."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.operators.clean import DEFAULT_RULES, CleaningRules, clean, enrich
from rillstone.operators.decode import decode, decode_checked
from rillstone.operators.metrics import MINUTE, MetricTable, window_metrics

DAY = "24 hours"


def fewer_copies(rows: DataFrame, key: str) -> DataFrame:
    """Drop copies of a key within each Arrow batch of a task, without state and without a shuffle.

    A streaming dedup has no map-side step, so all copies of a key travel to one state partition. Where a key may
    hold a large part of the rows this sends a ten-thousandth of them; elsewhere it only costs the way to Python
    and back.
    """

    def first_of_each(batches):
        for batch in batches:
            seen = pc.value_counts(batch.column(key))
            if len(seen) == batch.num_rows:
                yield batch
                continue
            first = pa.table({"k": batch.column(key), "i": pa.array(range(batch.num_rows))}).group_by("k")
            yield batch.take(first.aggregate([("i", "min")]).column("i_min").combine_chunks().sort())

    return rows.mapInArrow(first_of_each, rows.schema)


def drop_repeats(
    rows: DataFrame, key: str = "event_id", clock: str = "processed_at", horizon: str = DAY, combine: bool = False
) -> DataFrame:
    """Drop rows whose key was accepted within the horizon. State expires with the watermark on `clock`.

    One stateful step decides, so the rule does not depend on how rows are laid out: a key's state starts with the
    copy that was accepted, later copies do not prolong it, and the first copy after its end is accepted again.

    With `processed_at` as the clock no row is ever late: it is never NULL and never runs backwards, so nothing is
    lost for having an old or unreadable event time. `combine` thins out hot keys first; see `fewer_copies`.
    """
    thinned = fewer_copies(rows, key) if combine else rows
    return thinned.withWatermark(clock, horizon).dropDuplicatesWithinWatermark([key])


def cleaned_stream(
    records: DataFrame, rules: CleaningRules = DEFAULT_RULES, horizon: str = DAY, combine: bool = False
) -> DataFrame:
    """Envelope rows to cleaned, de-duplicated events (30 columns)."""
    return drop_repeats(clean(decode(records), rules), horizon=horizon, combine=combine)


def checked_stream(records: DataFrame, rules: CleaningRules = DEFAULT_RULES) -> DataFrame:
    """Events, repeats included, together with every rejected record, told apart by reject_reason.

    One plan for both means the feed is read and parsed once. It has no state: the fan-out drops repeats by its ledger
    of accepted ids, and rejects, which have no id to compare, cost neither state nor a shuffle.
    """
    checked = enrich(decode_checked(records), rules)
    return checked.observe(
        "intake",
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
        F.count_if(F.col("field_fault")).alias("field_faults"),
    )


def window_stream(
    records: DataFrame,
    table: MetricTable,
    every: str = MINUTE,
    lateness: str = "10 minutes",
    combine: bool = False,
) -> DataFrame:
    """Metrics per window as they stand, for `start_windows`: as updates, or once a window has closed.

    Only the fields of this table are decoded. Repeats are dropped while their window can still change; as in the
    store, an id counts once whatever its kind. Distinct counts are estimates here and named so; the fan-out job
    keeps exact ones.
    """
    rows = clean(decode(records, table.record_fields, keep=()), stamp=False)
    timed = rows.where(F.col("event_ts").isNotNull())
    unique = drop_repeats(timed, clock="event_ts", horizon=lateness, combine=combine)
    metrics = window_metrics(unique, table, every, exact=False)
    return metrics.withColumnRenamed(table.distinct[0], f"{table.distinct[0]}_estimate") if table.distinct else metrics
