"""Ranks, first rows and following rows that hold up when one group has most of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.operators.placing import ranked, stored


def top_ranks(df: DataFrame, group: list[str], measure: str, k: int,
              rank_name: str = "rk") -> DataFrame:
    """Rows whose descending `rank()` of `measure` within the group is at most `k`, ties kept.

    Ranking every row would put a whole group into one task. Rows with equal measures share a
    rank, so counting rows per (group, measure) is enough: at most `k` values per group can reach
    rank `k`, and Spark cuts the values to `k` per task before they are shuffled. The rows
    themselves only meet that small list.
    """
    values = df.groupBy(*group, measure).agg(F.count("*").alias("__rows"))
    by_value = Window.partitionBy(*group).orderBy(F.col(measure).desc())
    best = values.withColumn("__no", F.row_number().over(by_value)).where(F.col("__no") <= k)
    before = by_value.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (best
              .withColumn(rank_name, (F.coalesce(F.sum("__rows").over(before), F.lit(0)) + 1)
                          .cast("bigint"))
              .where(F.col(rank_name) <= k)
              .select(*group, measure, rank_name))
    # Own column names, because both sides descend from the same frame.
    renamed = ranked.toDF(*[f"__{c}" for c in [*group, measure]], rank_name)
    match = reduce(lambda a, b: a & b,
                   [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in [*group, measure]])
    return df.join(renamed, match, "inner").select(*df.columns, rank_name)


def first_rows(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The first row of each group. A minimum over structs is combined before the shuffle."""
    rest = [c for c in df.columns if c not in group and c not in order]
    first = df.groupBy(*group).agg(F.min(F.struct(*order, *rest)).alias("__first"))
    return first.select(*group, "__first.*").select(*df.columns)


def latest_rows(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, by `order`; also combined before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    last = df.groupBy(*key).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("__last"))
    return last.select(*key, "__last.*").select(*df.columns)


def lead_within(df: DataFrame, group: list[str], order: list[str], value: str, offset: int,
                default, name: str) -> DataFrame:
    """Plain `lead` for groups with a known bound, such as one row per user and day."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.lead(value, offset, default).over(window))


def next_values(df: DataFrame, group: list[str], time: str, tie: str, value: str,
                names: list[str], slice_rows: int = 100_000) -> DataFrame:
    """`lead(value, 1)`, `lead(value, 2)`, ... along `time`, `tie`, one column per name, and `place`,
    the row's number in its group from 0, for sequences of any length and density.

    Rows get their exact place by a range sort, and each sequence is cut into slices of as many
    rows, whatever their times; slices are separate window groups, so a sequence with a large share
    of all rows is spread over many tasks, also when it happens within one second. Where a slice
    ends, its last rows take over the first values of the following slices. The group columns must
    not be null. The result has the group, `time`, `tie`, `value`, `place` and the names.
    """
    n = len(names)
    wanted = df.select(*group, time, tie, value)
    placed = ranked(stored(wanted, "sequence"), group, [F.col(time), F.col(tie)], "place")
    # Values travel in structs: a successor may exist and hold null.
    cut = placed.select(*group, time, tie, "place", F.floor(F.col("place") / slice_rows).alias("__slice"),
                        F.struct(F.col(value).alias("v")).alias("__item"))
    inside = Window.partitionBy(*group, "__slice").orderBy("place")
    leads = [F.lead("__item", i).over(inside).alias(f"__lead{i}") for i in range(1, n + 1)]
    rows = cut.select("*", *leads)
    successors = F.array_compact(F.array(*[F.col(f"__lead{i}") for i in range(1, n + 1)]))
    heads = rows.where(F.col("place") % slice_rows == 0).select(
        *group, "__slice", F.slice(F.concat(F.array("__item"), successors), 1, n).alias("__head"))
    along = Window.partitionBy(*group).orderBy("__slice")
    none = F.slice("__head", 1, 0)
    later = [F.coalesce(F.lead("__head", i).over(along), none) for i in range(1, n + 1)]
    follow = heads.select(*[F.col(c).alias(f"__{c}") for c in group],
                          F.col("__slice").alias("__slice_no"),
                          F.slice(F.concat(*later), 1, n).alias("__after"))
    match = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__{c}") for c in group],
                   (F.col("__slice") == F.col("__slice_no")) & F.col(f"__lead{n}").isNull())
    joined = rows.withColumn("__inside", successors).join(follow, match, "left")
    after = F.coalesce("__after", F.slice("__inside", 1, 0))
    found = joined.withColumn("__found", F.concat("__inside", after))
    return found.select(*group, time, tie, F.col("__item")["v"].alias(value), "place",
                        *[F.get("__found", i)["v"].alias(name) for i, name in enumerate(names)])
