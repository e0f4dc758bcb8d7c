"""Interval, day and membership filters; null filling."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.calendar import Day, as_date, day_end, midnight
from cardwatch.schema import AMOUNT_LIMIT, DELAY_DAYS, WINDOW_DAYS

PARTITION_DAY = "tx_date"


def between_days(
    df: DataFrame, first: Day, last: Day, *, ts: str = "tx_datetime", closed: bool = False
) -> DataFrame:
    """Rows of the calendar days ``first`` to ``last``, both included.

    The bound is half-open (before the midnight after ``last``). ``closed=True`` stops at
    23:59:59.000 instead and so leaves out the last fraction of a second. On a table partitioned
    by day the bound on the partition column is added, so that only those folders are listed.
    """
    end = midnight(last)
    upper = F.col(ts) <= day_end(end) if closed else F.col(ts) < end + F.expr("INTERVAL 1 DAY")
    keep = (F.col(ts) >= midnight(first)) & upper
    if PARTITION_DAY in df.columns:
        keep &= F.col(PARTITION_DAY).between(F.lit(as_date(first)), F.lit(as_date(last)))
    return df.filter(keep)


def lookback_days(windows: Iterable[int] = WINDOW_DAYS, delay: int = DELAY_DAYS) -> int:
    """History the window columns of one day need: the delay plus the longest window."""
    return delay + max(windows)


def with_lookback(
    df: DataFrame, first: Day, last: Day, days: int | None = None, *, closed: bool = False
) -> DataFrame:
    """Rows of ``first`` to ``last`` and the history before them.

    ``days`` defaults to the full reach of the delayed windows. Seven days truncates the delayed
    windows of the first output week.
    """
    reach = lookback_days() if days is None else days
    start = as_date(first) - dt.timedelta(days=reach)
    return between_days(df, start, last, closed=closed)


def days_before(df: DataFrame, first: Day, days: int) -> DataFrame:
    """Rows of the ``days`` calendar days before ``first``."""
    start = as_date(first)
    day = dt.timedelta(days=1)
    if days < 1:
        return df.filter(F.lit(False))
    return between_days(df, start - days * day, start - day)


def trailing_days(df: DataFrame, days: int, *, ts: str = "tx_datetime") -> DataFrame:
    """Rows no older than ``days`` days before the latest row of the data itself.

    On a table partitioned by day only the last day is read for the latest row, and only the
    trailing days for the result.
    """
    by_day = PARTITION_DAY in df.columns
    last = df
    if by_day:
        last = df.filter(F.col(PARTITION_DAY) == df.agg(F.max(PARTITION_DAY)).scalar())
    start = last.agg((F.max(ts) - F.make_dt_interval(F.lit(days))).alias("start"))
    keep = F.col(ts) >= start.scalar()
    if by_day:
        keep &= F.col(PARTITION_DAY) >= start.select(F.to_date("start")).scalar()
    return df.filter(keep)


def on_day(df: DataFrame, day: int) -> DataFrame:
    return df.filter(F.col("tx_time_days") == day)


def in_day_range(df: DataFrame, day: int, length: int) -> DataFrame:
    """Day numbers in ``[day, day + length)``."""
    return df.filter(day_range(F.lit(day), length))


def day_range(day: Column, length: int, number: str = "tx_time_days") -> Column:
    return (F.col(number) >= day) & (F.col(number) < day + length)


def members(df: DataFrame, column: str, allowed: DataFrame | Iterable) -> DataFrame:
    """Rows whose ``column`` is in a literal list or in the one column of another table."""
    if isinstance(allowed, DataFrame):
        keys = allowed.select(F.col(allowed.columns[0]).alias(column))
        return df.join(keys, column, "left_semi")
    return df.filter(F.col(column).isin(list(allowed)))


def frauds(df: DataFrame) -> DataFrame:
    return df.filter(F.col("tx_fraud") == 1)


def over_limit(limit: float = AMOUNT_LIMIT, amount: str = "tx_amount") -> Column:
    """1 where the amount is above the limit, else 0."""
    return F.when(F.col(amount) > limit, 1).otherwise(0).cast("long")


def fill_zero(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """NULL and NaN to 0 in the given numeric columns; in all numeric columns when none is given."""
    return df.na.fill(0) if columns is None else df.na.fill(0, subset=list(columns))
