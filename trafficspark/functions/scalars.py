"""Scalar expressions over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KMH_PER_MS = 3.6
FEET_PER_METER = 3.28084
#: Smallest relative step of a double: the least denominator of a percentage error.
EPSILON = 2.220446049250313e-16


def from_epoch(seconds: Column) -> Column:
    """Epoch seconds as a naive timestamp (the session's time zone is UTC)."""
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def to_epoch(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def hour_start(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def iso_weekday(ts: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(ts) + 1


def weekday_columns(ts: Column, mode: str = "observed") -> tuple[Column, Column]:
    """day_of_week and is_weekend. observed: 1 to 7, Friday on counts as weekend; documented: 0 to 6, Saturday on."""
    if mode not in ("observed", "documented"):
        raise ValueError(f"unknown weekday mode {mode!r}")
    day = iso_weekday(ts) if mode == "observed" else F.weekday(ts)
    return day.cast("int"), (day >= 5).cast("int")


def kmh(ms: Column) -> Column:
    return ms * KMH_PER_MS


def feet(meters: Column) -> Column:
    return meters * FEET_PER_METER


def flight_phase(vertical_rate: Column) -> Column:
    """climbing above 2, descending below -2, else level; null is level."""
    return F.when(vertical_rate > 2, "climbing").when(vertical_rate < -2, "descending").otherwise("level")


def split_category(message: Column) -> tuple[Column, Column]:
    """Category and text of "[CATEGORY] text", of any number of lines; UNKNOWN and the whole message without one."""
    pattern = r"(?s)^\[([^\]]+)\]\s*(.*)\z"
    found = message.rlike(pattern)
    return F.when(found, F.regexp_extract(message, pattern, 1)).otherwise("UNKNOWN"), F.when(found, F.regexp_extract(message, pattern, 2)).otherwise(message)


def absolute_percentage_error(actual: Column, predicted: Column) -> Column:
    return F.abs(actual - predicted) / F.greatest(F.abs(actual), F.lit(EPSILON))


def partition_columns(ts: Column) -> dict[str, Column]:
    return {"year": F.year(ts), "month": F.month(ts), "day": F.day(ts)}
