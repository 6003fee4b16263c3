"""Order records: decode and describe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.functions import order_line
from rillstone.schemas import order_schema


def decode_orders(records: DataFrame, text: str = "raw_json") -> DataFrame:
    return records.select(F.inline(F.array(F.from_json(text, order_schema()))))


def describe_orders(orders: DataFrame) -> DataFrame:
    """The decoded fields and the line a tracker prints for each order."""
    return orders.select("*", order_line().alias("message"))
