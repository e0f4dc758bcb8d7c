"""Event-time expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.schema import SECONDS_PER_DAY

Day = dt.date | str


def as_date(day: Day) -> dt.date:
    """A date from ``YYYY-MM-DD`` text, a date or a datetime."""
    if isinstance(day, dt.datetime):
        return day.date()
    return day if isinstance(day, dt.date) else dt.datetime.strptime(day, "%Y-%m-%d").date()


def midnight(day: Day) -> Column:
    return F.lit(as_date(day).isoformat()).cast("timestamp")


def days_to_seconds(days: int) -> int:
    return days * SECONDS_PER_DAY


def event_seconds(ts: Column | str = "tx_datetime") -> Column:
    """Whole epoch seconds, floored."""
    return F.unix_seconds(_col(ts).cast("timestamp"))


def weekend_flag(ts: Column | str = "tx_datetime") -> Column:
    """1 on Saturday and Sunday, else 0; 0 without a time."""
    return F.when(F.dayofweek(_col(ts)).isin(1, 7), 1).otherwise(0)


def night_flag(ts: Column | str = "tx_datetime") -> Column:
    """1 up to 06:59:59, else 0; 0 without a time."""
    return F.when(F.hour(_col(ts)) <= 6, 1).otherwise(0)


def time_from_offset(seconds: Column | str, origin: Day) -> Column:
    """Batch start plus an offset in seconds."""
    return F.timestamp_seconds(F.unix_seconds(midnight(origin)) + _col(seconds))


def seconds_since(ts: Column | str, origin: Day) -> Column:
    return event_seconds(ts) - F.unix_seconds(midnight(origin))


def days_since(ts: Column | str, origin: Day) -> Column:
    return F.floor(seconds_since(ts, origin) / SECONDS_PER_DAY)


def day_start(ts: Column | str) -> Column:
    return F.date_trunc("day", _col(ts))


def day_end(ts: Column | str) -> Column:
    """The last whole second of the day."""
    return day_start(ts) + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")


def day_text(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd")


def days_between_inclusive(first: Day, last: Day) -> int:
    return (as_date(last) - as_date(first)).days + 1


def day_spine(spark: SparkSession, first: Day, last: Day) -> DataFrame:
    """One row per calendar day of the closed interval."""
    days = F.sequence(F.lit(as_date(first)), F.lit(as_date(last)))
    return spark.range(1).select(F.explode(days).alias("tx_date"))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
