"""Event time and watermarks from JSON messages (column `value`).

Messages without a usable time are not given a made-up one, they go to the rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.days import millis_time


def field_millis(value: Column, field: str) -> Column:
    """A top-level epoch field in milliseconds; null when it is absent or no time."""
    return millis_time(F.get_json_object(value, f"$.{field}").try_cast("bigint"))


def field_seconds(value: Column, first: str, second: str) -> Column:
    """An epoch field in seconds, or the second field where the first is missing."""
    number = F.coalesce(F.get_json_object(value, f"$.{first}").try_cast("bigint"),
                        F.get_json_object(value, f"$.{second}").try_cast("bigint"))
    # Larger numbers would overflow as milliseconds; none of them is a time.
    return millis_time(F.when(F.abs(number) < 1 << 50, number * 1000))


def first_window_start(value: Column) -> Column:
    """`window_start_time` (milliseconds) of the first element of a JSON list."""
    windows = F.from_json(value, "array<struct<window_start_time: bigint>>")
    return millis_time(F.get(windows, 0)["window_start_time"])


def with_watermark(stream: DataFrame, time: Column, delay_seconds: int,
                   name: str = "event_time") -> DataFrame:
    """Messages with an event time, under a bounded-lateness watermark."""
    return (stream.withColumn(name, time).where(F.col(name).isNotNull())
            .withWatermark(name, f"{delay_seconds} seconds"))


def rejects(stream: DataFrame, time: Column) -> DataFrame:
    """The messages `with_watermark` leaves out."""
    return stream.where(time.isNull())


def without_repeats(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Drop messages repeated within the watermark; state is given up when it has passed."""
    return stream.dropDuplicatesWithinWatermark(keys)


def routed(stream: DataFrame, time: Column) -> DataFrame:
    """All messages with `event_time` and `route`: `ok`, or `reject` without a usable time.

    Written by one query into a folder per route, so that the source is read once.
    """
    return stream.withColumn("event_time", time).withColumn(
        "route", F.when(F.col("event_time").isNull(), "reject").otherwise("ok"))


def daily_counts(stream: DataFrame, delay_seconds: int) -> DataFrame:
    """(day, message_count) from `event_time` under a watermark.

    A day is given out when the watermark has passed its end; messages that come for it later are
    dropped, earlier ones are counted however much out of order they are.
    """
    timed = stream.withWatermark("event_time", f"{delay_seconds} seconds")
    counts = timed.groupBy(F.window("event_time", "1 day").alias("w")).agg(
        F.count("*").cast("bigint").alias("message_count"))
    return counts.select(F.col("w.start").alias("day"), "message_count")
