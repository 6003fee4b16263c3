"""Duplicate elimination on batch tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_RANK = "_arrival_rank"


def first_per_key(
    rows: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]
) -> DataFrame:
    """One whole row per key: the first in the given order.

    Spark turns `row_number() = 1` into a group limit that runs before the shuffle as well, so each task
    sends at most one row per key: a key held by a third of all rows does not land on one reducer. Unlike
    `dropDuplicates` the survivor does not depend on task timing, the row needs no aggregation buffer per
    column, and columns nobody reads are still pruned.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return rows.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def distinct_events(
    rows: DataFrame,
    key: str = "event_id",
    order_by: Sequence[Column | str] | None = ("kafka_timestamp", "partition", "offset"),
) -> DataFrame:
    """One row per event id: the earliest arrival, or any copy when no order is given.

    Rows without an id must have been dropped before.
    """
    if order_by is None:
        return rows.dropDuplicates([key])
    return first_per_key(rows, [key], order_by)


def newest_per_key(
    rows: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ("kafka_timestamp", "partition", "offset")
) -> DataFrame:
    """Newest row per key of an append-only table: the keyed-upsert view over it. Offsets alone do not order
    records of different partitions, so the arrival time comes first."""
    return first_per_key(rows, keys, [F.col(name).desc_nulls_last() for name in order_by])


def repeated_ids(rows: DataFrame, key: str = "event_id") -> DataFrame:
    """Ids seen more than once, with the number of copies."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
