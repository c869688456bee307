"""Days, epochs and horizons.

A day is ISO text (`2024-01-30`) in every table; literals are shifted on the driver so that the
bounds reach the scan as constants.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

FAR_DAY = "9999-12-31"
HORIZONS = (1, 7, 30)
SHOP_ZONE = "GMT+8"
# Epoch values below this are seconds, the others milliseconds (fixed value).
SECONDS_LIMIT = 10_000_000_000
# First and last millisecond of the years 1 to 9999, a day less at either end for time zones.
TIME_RANGE = (-62_135_510_400_000, 253_402_214_399_999)


def shift(day: str, days: int) -> str:
    return (date.fromisoformat(day) + timedelta(days=days)).isoformat()


def horizon_start(day: str, length: int) -> str:
    """First day of the `length` days that end with `day`."""
    return shift(day, 1 - length)


def last_days(col: Column, day: str, length: int) -> Column:
    return col.between(horizon_start(day, length), day)


def iso_day(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def iso_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def in_range(epoch_ms: Column) -> Column:
    """The epoch in milliseconds, null outside of the years 1 to 9999: such a number is no time, and
    turning it into one would end the job."""
    return F.when(epoch_ms.between(*TIME_RANGE), epoch_ms)


def millis_time(epoch_ms: Column) -> Column:
    return F.timestamp_millis(in_range(epoch_ms))


def shop_time(epoch_ms: Column) -> Column:
    """Wall clock of the shop for an epoch in milliseconds."""
    return F.from_utc_timestamp(millis_time(epoch_ms), SHOP_ZONE)


def to_millis(epoch: Column) -> Column:
    """Accept seconds or milliseconds."""
    return F.when(epoch.between(-SECONDS_LIMIT, SECONDS_LIMIT - 1), epoch * 1000).otherwise(epoch)


def day_bucket(epoch: Column) -> Column:
    """`day=yyyyMMdd` for an epoch in seconds or milliseconds, `error_bucket` without a usable one."""
    day = F.date_format(millis_time(to_millis(epoch)), "yyyyMMdd")
    return F.coalesce(F.concat(F.lit("day="), day), F.lit("error_bucket"))


def day_numbers(first: Column, last: Column) -> Column:
    """All days from `first` to `last` as yyyyMMdd integers, empty when `first` is later."""
    days = F.transform(F.sequence(first, last),
                       lambda d: F.date_format(d, "yyyyMMdd").cast("int"))
    return F.when(first <= last, days).otherwise(F.array().cast("array<int>"))


def day_part(ts: Column) -> Column:
    """Time-of-day band in six-hour steps."""
    hour = F.hour(ts)
    return (F.when(hour < 6, "night").when(hour < 12, "morning")
            .when(hour < 18, "afternoon").otherwise("evening"))
