"""Splitting the event log by content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.sources.readers import parse_log

ROUTES = ("err", "start", "display", "action", "page", "dirty")


def split_log(stream: DataFrame, text: str = "value") -> DataFrame:
    """One row per line and section it holds, `route` naming the section; unparsable lines are
    routed to `dirty`. `value` is the JSON of the section, or the whole text for `dirty`."""
    def section(route, column):
        content = F.to_json(F.struct("common", F.col(column).alias(route), "ts"))
        return F.when(F.col("ts").isNotNull() & F.col(column).isNotNull(),
                      F.struct(F.lit(route).alias("route"), content.alias("value")))

    dirty = F.when(F.col("ts").isNull(), F.struct(F.lit("dirty").alias("route"),
                                                  F.col(text).alias("value")))
    clean = [section(route, name) for route, name in (
        ("err", "err"), ("start", "start"), ("display", "displays"), ("action", "actions"),
        ("page", "page"))]
    keep = [c for c in stream.columns if c != text]
    return (parse_log(stream, text)
            .select(*keep, F.inline(F.array_compact(F.array(dirty, *clean)))))


def with_topic(routed: DataFrame, topics: dict[str, str]) -> DataFrame:
    """Messages for a Kafka sink that takes the topic from each row."""
    names = F.create_map(*[F.lit(x) for pair in topics.items() for x in pair])
    return routed.select(F.element_at(names, F.col("route")).alias("topic"), "value")
