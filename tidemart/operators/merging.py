"""Combining stored rows with new rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.days import FAR_DAY, shift


def union_distinct(history: DataFrame | None, new: DataFrame) -> DataFrame:
    """Stored rows and new rows without duplicates; running it twice changes nothing."""
    rows = new if history is None else history.select(*new.columns).unionByName(new)
    return rows.distinct()


def fill_columns(df: DataFrame, later: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Fill the null cells of `columns` from `later`, which holds at most one row per key."""
    right = later.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in columns])
    joined = df.join(right, F.col(key) == F.col("__key"), "left")
    return joined.select(*[
        F.coalesce(F.col(c), F.col(f"__{c}")).alias(c) if c in columns else F.col(c)
        for c in df.columns])


def without_keys(df: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """Delete by key list."""
    return df.join(keys.select(*columns).distinct(), columns, "left_anti")


def merge_validity(current: DataFrame, changed: DataFrame, key: str, day: str) -> DataFrame:
    """One step of a validity-dated ("zip") dimension.

    `current` holds the open rows, `changed` the day's new or modified entities, both one row per
    key with the same columns except `start_date`, `end_date`, which only `current` carries. The
    result has the open rows (`ds` = far day) and the rows closed by this step (`ds` = day - 1).
    A change that touches no attribute leaves the open row as it is.
    """
    attributes = [c for c in changed.columns if c != key]
    old = current.select(F.col(key).alias("__old_key"),
                         F.struct(*attributes).alias("__old"), "start_date")
    new = changed.select(F.col(key).alias("__new_key"), F.struct(*attributes).alias("__new"))
    both = old.join(new, F.col("__old_key") == F.col("__new_key"), "full_outer")
    differs = (F.col("__new_key").isNotNull()
               & ~F.col("__old").eqNullSafe(F.col("__new")))
    yesterday = shift(day, -1)

    def version(source, start, end):
        return F.struct(source.alias("attributes"), start.alias("start_date"),
                        F.lit(end).alias("end_date"), F.lit(end).alias("ds"))

    kept = F.when(~differs, version(F.col("__old"), F.col("start_date"), FAR_DAY))
    opened = F.when(differs, version(F.col("__new"), F.lit(day), FAR_DAY))
    closed = F.when(differs & F.col("__old_key").isNotNull(),
                    version(F.col("__old"), F.col("start_date"), yesterday))
    return (both
            .select(F.coalesce("__old_key", "__new_key").alias(key),
                    F.explode(F.array_compact(F.array(kept, opened, closed))).alias("__v"))
            .select(key, "__v.attributes.*", "__v.start_date", "__v.end_date", "__v.ds"))


def sum_branches(branches: list[DataFrame], columns: list[str]) -> DataFrame:
    """Put one-row results side by side.

    Each branch fills some of the columns; absent ones count as zero, and one small aggregate
    brings all of them into a single row.
    """
    full = [b.select(*[F.col(c).cast("bigint").alias(c) if c in b.columns
                       else F.lit(0).cast("bigint").alias(c) for c in columns])
            for b in branches]
    return reduce(DataFrame.unionByName, full).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in columns])
