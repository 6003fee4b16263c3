"""Exact distinct counts that can be merged: members as numbers, sets of them as bitmaps.

A dictionary gives every member a number, once. Numbers are handed out per bucket of a hash, each bucket counting by
itself, so no single task sees all members, and they stay dense: number = place in bucket * BUCKETS + bucket. A set of
members is then one row for each 32,768 numbers it reaches into, whatever its size; sets are merged by OR.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 64
DICTIONARY_SCHEMA = "member string, number bigint"


def _bucket(member: Column) -> Column:
    return F.pmod(F.xxhash64(member), F.lit(BUCKETS))


def numbered(members: DataFrame, known: DataFrame) -> DataFrame:
    """(member, number) of the members that the dictionary does not know yet. NULL is no member.

    `members` has one column. How far each bucket has counted is read from the dictionary itself.
    """
    name = members.columns[0]
    new = members.select(F.col(name).alias("member")).where("member is not null").distinct()
    new = new.join(known.select("member"), "member", "left_anti").withColumn("bucket", _bucket(F.col("member")))
    used = known.groupBy((F.col("number") % BUCKETS).alias("bucket")).agg(F.max("number").alias("last"))
    first = F.coalesce(F.expr(f"last div {BUCKETS} + 1"), F.lit(0))  # the bucket's next place
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("member")) - 1
    numbers = new.withColumn("place", place).join(F.broadcast(used), "bucket", "left")  # one row a bucket
    return numbers.select("member", ((first + F.col("place")) * BUCKETS + F.col("bucket")).alias("number"))


def member_bitmaps(rows: DataFrame, by: Sequence[str], member: str, dictionary: DataFrame) -> DataFrame:
    """One row per group and bitmap bucket: the members found there. Members must be in the dictionary."""
    pairs = rows.where(F.col(member).isNotNull()).groupBy(*by, F.col(member).alias("member")).agg(F.lit(1))
    numbers = pairs.join(dictionary, "member")
    at, bucket = F.bitmap_bit_position("number"), F.bitmap_bucket_number("number").alias("bitmap_bucket")
    return numbers.groupBy(*by, bucket).agg(F.bitmap_construct_agg(at).alias("bits"))


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    return bitmaps.groupBy(*by, "bitmap_bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_sizes(bitmaps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Members per group, of merged bitmaps."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))
