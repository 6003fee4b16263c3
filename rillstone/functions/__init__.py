from rillstone.functions.scalars import (
    clamp,
    decimal_round,
    event_time,
    hot_temperature,
    order_line,
    record_key,
    severity,
    slow_request,
)
from rillstone.functions.timing import as_instant, at_or_after_day, within

__all__ = [
    "as_instant",
    "at_or_after_day",
    "clamp",
    "decimal_round",
    "event_time",
    "hot_temperature",
    "order_line",
    "record_key",
    "severity",
    "slow_request",
    "within",
]
