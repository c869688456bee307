"""Several look-back horizons from one pass over the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fan_out(df: DataFrame, horizons: tuple[int, ...], name: str = "recent_days") -> DataFrame:
    """Repeat each row once per horizon. Meant for rows that are already aggregated."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(h).cast("bigint") for h in horizons])))


def by_horizon(df: DataFrame, keys: list[str], columns: dict[int, dict[str, Column]],
               name: str = "recent_days") -> DataFrame:
    """Turn a wide row (one group of columns per horizon) into one row per horizon."""
    rows = F.array(*[
        F.struct(F.lit(h).cast("bigint").alias(name), *[c.alias(n) for n, c in cols.items()])
        for h, cols in columns.items()])
    return df.select(*keys, F.explode(rows).alias("__h")).select(*keys, "__h.*")
