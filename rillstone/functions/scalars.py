"""Row-level rules as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data contract.
LOWEST_TEMPERATURE = -50.0
HIGHEST_TEMPERATURE = 150.0
SLOW_ABOVE_MS = 1500
HOT_ABOVE = 55.0
YELLOW_FROM, RED_FROM = 5, 10


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time(text: Column | str) -> Column:
    """ISO-8601 text to an instant; unreadable text gives NULL instead of failing the job."""
    return F.try_to_timestamp(_col(text))


def clamp(
    value: Column | str,
    low: float = LOWEST_TEMPERATURE,
    high: float = HIGHEST_TEMPERATURE,
    preserve_null: bool = False,
) -> Column:
    """Bound a number. greatest/least skip NULL, so NULL becomes `high` unless preserve_null is set."""
    value = _col(value)
    bounded = F.greatest(F.lit(low), F.least(F.lit(high), value))
    return F.when(value.isNotNull(), bounded) if preserve_null else bounded


def slow_request(
    kind: Column | str = "event_type",
    millis: Column | str = "response_time_ms",
    above: int = SLOW_ABOVE_MS,
) -> Column:
    """True for web requests strictly slower than the limit, else false; never NULL."""
    return F.coalesce((_col(kind) == "clickstream") & (_col(millis) > above), F.lit(False))


def hot_temperature(value: Column | str = "temperature", above: float = HOT_ABOVE) -> Column:
    return _col(value) > F.lit(above)


def record_key(user: Column | str, sensor: Column | str, event: Column | str) -> Column:
    """First of user, sensor, event id that is neither NULL nor empty; the event id is taken as it is."""
    return F.coalesce(F.nullif(_col(user), F.lit("")), F.nullif(_col(sensor), F.lit("")), _col(event))


def decimal_round(value: Column | str, places: int) -> Column:
    """Round half up on the decimal value, so that 0.125-like doubles round the same in every engine."""
    return F.round(_col(value).cast("decimal(28,10)"), places).cast("double")


def severity(count: Column | str) -> Column:
    count = _col(count)
    return F.when(count >= RED_FROM, "red").when(count >= YELLOW_FROM, "yellow").otherwise("green")


def order_line(
    quantity: Column | str = "quantity", item: Column | str = "item", user: Column | str = "user"
) -> Column:
    return F.format_string("Received order: %d x %s from %s", _col(quantity), _col(item), _col(user))
