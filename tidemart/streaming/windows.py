"""Sessions, minute counts and bans that expire, as windows with state and a watermark.

Each function takes a stream or a table. On a stream a window is given out once, when the watermark has
passed its end; what is still open stays in the state store and goes on from the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.plans.moderation import BLACKLIST_DAYS, strongest


def by_lateness(rows: DataFrame, event: str, arrival: str, delay_seconds: int) -> DataFrame:
    """All rows with `route`: `ok`, `late`, `ahead` (event after arrival) or `reject` (no time).

    Decided by each row alone, so a restart or another cut into batches decides alike. Where arrivals do not go back
    from batch to batch, a row on route `ok` is never behind a watermark of the same delay: no event before it is later than its
    arrival. Spark therefore drops nothing unseen; what would be dropped is on the other routes.
    """
    lag = F.unix_micros(arrival) - F.unix_micros(event)
    return rows.withColumn("route", F.when(lag.isNull(), "reject").when(lag < 0, "ahead")
                           .when(lag > delay_seconds * 1_000_000, "late").otherwise("ok"))


def _watermarked(rows: DataFrame, time: str, delay_seconds: int) -> DataFrame:
    return rows.withWatermark(time, f"{delay_seconds} seconds") if rows.isStreaming else rows


def sessions(rows: DataFrame, key: str, time: str, gap_seconds: int, measures: list[Column],
             delay_seconds: int = 0) -> DataFrame:
    """(key, session_start, session_end, measures) per run of rows no more than the gap apart.

    A row between two open sessions joins them. For tables with hot keys there is
    `operators.sessions.gap_sessions` with the same result.
    """
    window = F.session_window(time, f"{gap_seconds} seconds")
    used = _watermarked(rows.where(F.col(key).isNotNull()), time, delay_seconds)
    found = used.groupBy(key, window.alias("w")).agg(*measures)
    return found.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"),
                        *found.columns[2:])


def window_counts(rows: DataFrame, keys: list[str], time: str, length: str, delay_seconds: int = 0) -> DataFrame:
    """(keys, window_start, row_count) per tumbling window such as `1 minute`; rows without a time count nowhere."""
    used = _watermarked(rows, time, delay_seconds)
    return used.groupBy(*keys, F.window(time, length).alias("w")).agg(
        F.count(F.lit(1)).cast("bigint").alias("row_count")).select(*keys, F.col("w.start").alias("window_start"), "row_count")


def ban_periods(offences: DataFrame, delay_seconds: int = 0) -> DataFrame:
    """(user_id, banned_from, expires, worst_grade, offences) per uninterrupted ban.

    `offences` has user_id, offended_at and grade. Each opens a window as long as its grade says; windows that
    overlap are one ban, so the longest counts and an offence during a ban prolongs it. On a stream the row comes when
    the ban has expired; a table gives all periods. In a table the offences of a user, day and grade are combined first, which bounds a hot user: as
    every ban is longer than a day, they are always in one period. Grades without a ban, null users and times are left out.
    """
    days = F.when(F.col("grade") == "P0", BLACKLIST_DAYS["P0"]).when(F.col("grade") == "P1", BLACKLIST_DAYS["P1"])
    used = offences.where(days.isNotNull() & F.col("user_id").isNotNull() & F.col("offended_at").isNotNull())
    if used.isStreaming:
        single = _watermarked(used, "offended_at", delay_seconds).withColumn("last", F.col("offended_at")).withColumn("n", F.lit(1))
    else:
        single = used.groupBy("user_id", "grade", F.to_date("offended_at").alias("day")).agg(
            F.min("offended_at").alias("offended_at"), F.max("offended_at").alias("last"), F.count(F.lit(1)).alias("n"))
    span = F.unix_micros("last") - F.unix_micros("offended_at") + days.cast("bigint") * 86_400_000_000
    window = F.session_window("offended_at", F.concat(span.cast("string"), F.lit(" microseconds")))
    return single.groupBy("user_id", window.alias("w")).agg(
        strongest().alias("worst_grade"), F.sum("n").cast("bigint").alias("offences")).select(
        "user_id", F.col("w.start").alias("banned_from"), F.col("w.end").alias("expires"), "worst_grade", "offences")
