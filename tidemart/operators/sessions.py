"""Gap sessions over a whole table, when one key may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.operators.history import as_of
from tidemart.operators.placing import fresh
from tidemart.operators.ranking import next_values


def gap_sessions(rows: DataFrame, key: str, time: str, gap_seconds: int, measures: list[Column],
                 part_rows: int = 100_000) -> DataFrame:
    """(key, session_start, session_end, measures) of runs of rows no more than the gap apart.

    The end is the last time plus the gap; a row exactly at it still belongs, as with `session_window`, which
    `streaming.windows.sessions` uses on a stream. There one task holds all rows of a key; here distinct times are put in order by
    a range sort, times after a longer pause start a session, and each row takes the last start of its
    key by a point-in-time join, so a session of any length is spread and its measures are combined before the shuffle.
    Rows without a key or time are in no session.
    """
    used = rows.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    times = (used.select(F.col(key).alias("k"), F.col(time).alias("t")).distinct()
             .select("k", "t", F.lit(0).alias("tie"), F.col("t").alias("v")))
    steps = next_values(times, ["k"], "t", "tie", "v", ["following"], slice_rows=part_rows)
    pause = F.unix_micros("following") - F.unix_micros("t") > gap_seconds * 1_000_000
    starts = F.array_compact(F.array(F.when(F.col("place") == 0, F.col("t")), F.when(pause, F.col("following"))))
    begin, start = fresh(used, "begin"), fresh(used, "session_start")
    begun = steps.select(F.col("k").alias(key), F.explode(starts).alias(begin)).withColumn(start, F.col(begin))
    found = as_of(used, begun, key, time, [begin], [start], part_rows=part_rows)
    last = F.timestamp_micros(F.unix_micros(F.max(time)) + gap_seconds * 1_000_000)
    return (found.groupBy(key, start).agg(last.alias("session_end"), *measures)
            .withColumnRenamed(start, "session_start"))
