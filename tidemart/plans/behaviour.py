"""Behaviour indicators: visits, searches, regions, paths, devices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.days import in_range
from tidemart.operators.ranking import next_values
from tidemart.operators.sequences import frequent_sequences
from tidemart.sources.readers import TIME, parse_log


def page_visits(views: DataFrame) -> DataFrame:
    """Visits per page and day; every stored day and the current one."""
    return views.groupBy("ds", "page_id").agg(F.count("*").cast("bigint").alias("visit_count"))


def search_top(searches: DataFrame, k: int = 10) -> DataFrame:
    """The day's `k` most frequent search terms; equal counts are ordered by the term.

    Terms are counted first, and Spark keeps `k` terms per day and task before the shuffle.
    """
    counts = searches.groupBy("ds", "term").agg(F.count("*").cast("bigint").alias("search_count"))
    order = Window.partitionBy("ds").orderBy(F.col("search_count").desc(), "term")
    return (counts.withColumn("place", F.row_number().over(order).cast("bigint"))
            .where(F.col("place") <= k))


def login_region_heat(logins: DataFrame, provinces: DataFrame) -> DataFrame:
    """Logins and users per region, province and day."""
    facts = logins.groupBy("ds", F.col("province_id").try_cast("bigint").alias("province_id")).agg(
        F.count("*").cast("bigint").alias("login_count"),
        F.count_distinct("user_id").cast("bigint").alias("user_count"))
    labels = provinces.select(F.col("id").alias("province_id"), "province_name", "region_name")
    return (facts.join(labels, "province_id", "left")
            .select("ds", "province_id", "province_name", "region_name", "login_count",
                    "user_count"))


def _page_sequence(log: DataFrame) -> DataFrame:
    """Pages with session and time; a view without a session belongs to no path."""
    schema = f"common struct<sid: string>, page struct<page_id: string>, {TIME}"
    session = F.col("common.sid")
    usable = in_range(F.col("ts")).isNotNull() & session.isNotNull()
    return (parse_log(log, schema=schema).where(usable)
            .select("id", "ts", session.alias("session_id"), "page.page_id"))


def page_path_edges(log: DataFrame) -> DataFrame:
    """How often one page follows another within a session; the last page leads nowhere (null)."""
    steps = next_values(_page_sequence(log), ["session_id"], "ts", "id", "page_id",
                        ["next_page_id"])
    return steps.groupBy("page_id", "next_page_id").agg(
        F.count("*").cast("bigint").alias("step_count"))


def page_paths(log: DataFrame, length: int = 3) -> DataFrame:
    """`length` pages in a row within a session, as text `a>b>c`, with their frequency; a session of
    fewer pages is a path of its own.

    Paths of a bounded length can be counted for sessions of any length; a whole session as one
    text would have to be gathered in one row.
    """
    names = [f"page_{i}" for i in range(2, length + 1)]
    steps = next_values(_page_sequence(log), ["session_id"], "ts", "id", "page_id", names)
    path = F.concat_ws(">", "page_id", *names)
    whole = F.col(names[-1]).isNotNull() | (F.col("place") == 0) if names else F.lit(True)
    return (steps.where(whole).groupBy(path.alias("path"))
            .agg(F.count("*").cast("bigint").alias("path_count")))


def frequent_paths(log: DataFrame, one_in: int = 100, longest: int | None = None) -> DataFrame:
    """Paths of any length that at least one in `one_in` sessions takes, as text `a>b>c`, with their sessions.

    Pages come in that order, others may be visited between. A view without a page belongs to no path.
    """
    found = frequent_sequences(_page_sequence(log), "session_id", "ts", "id", "page_id", one_in, longest)
    return found.select(F.array_join("path", ">").alias("path"), F.col("length").alias("page_count"),
                        F.col("support").alias("session_count"))


def device_rollup(views: DataFrame) -> DataFrame:
    """Views and visitors by system, then brand, then version, with the totals of each level.

    `level` is 0 for a version, 1 for a brand, 3 for a system and 7 for everything. Views are
    reduced to one row per visitor and version before they are repeated for the four levels.
    """
    visitors = views.groupBy("operate_system", "brand", "version_code", "mid_id").agg(
        F.count("*").alias("n"))
    return (visitors.rollup("operate_system", "brand", "version_code").agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.sum("n").cast("bigint").alias("view_count"),
        F.count_distinct("mid_id").cast("bigint").alias("visitor_count")))


def category_rollup(daily: DataFrame) -> DataFrame:
    """Order lines and amounts by category level, for drill-down reports."""
    leaves = daily.groupBy("category1_id", "category2_id", "category3_id").agg(
        F.sum("order_count_1d").alias("n"), F.sum("order_total_amount_1d").alias("amount"))
    return leaves.rollup("category1_id", "category2_id", "category3_id").agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.sum("n").cast("bigint").alias("order_count"),
        F.sum("amount").cast("decimal(26,2)").alias("order_total_amount"))
