"""Column functions on timestamps without zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("timestamp_ntz")


def midnight(col: Column | str) -> Column:
    """The day a timestamp falls on, as a timestamp without zone."""
    return F.to_date(col).cast("timestamp_ntz")


def day(value: str) -> Column:
    """A date literal; operators take every 'today' or cutoff as an argument."""
    return F.to_date(F.lit(value))


def floor_to(unit: str, col: Column | str) -> Column:
    """``date_trunc`` that stays without zone."""
    return F.date_trunc(unit, col).cast("timestamp_ntz")


def horizon_days_calendar(datetime: str = "datetime", reference: str = "reference_datetime") -> Column:
    """Number of midnights between issue time and valid time."""
    return F.date_diff(F.col(datetime), F.col(reference))


def horizon_days_exact(datetime: str = "datetime", reference: str = "reference_datetime") -> Column:
    """Lead time in days with its fraction."""
    return F.timestamp_diff("MICROSECOND", F.col(reference), F.col(datetime)) / F.lit(86400.0e6)


def span_days(first: Column, last: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", first, last) / F.lit(86400.0e6)


def hour_of_day(col: str) -> Column:
    """Time of day in hours with its fraction (minutes resolution)."""
    return F.hour(col) + F.minute(col) / F.lit(60.0)
