"""Written intermediate tables, and exact places of rows in groups of any size."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage and survives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ranked(df: DataFrame, group: list[str], order: list[Column], name: str,
           part_rows: int = 100_000) -> DataFrame:
    """Adds the exact place (long, from 0) of each row within its `group` in the given order.

    Rows are dealt by ranges of the sort key, so a group of any size is spread over tasks. A row's
    place is its place in its sorted range less the group's first one there, plus the group's rows
    in earlier ranges. Only counts per (range, group) are summed up in a window; there are about
    as many as ranges and groups, and ranges grow with the root of the input.
    """
    total = df.count()
    parts = max(1, math.ceil(total / max(part_rows, math.isqrt(total))), min(8, total // 2000 + 1))
    at, part, idx = (fresh(df, f"__{x}_{name}") for x in ("at", "part", "idx"))
    sort = [*[F.col(g).asc_nulls_last() for g in group], *order]
    placed = stored(df.repartitionByRange(parts, *sort).sortWithinPartitions(*sort)
                    .withColumn(at, F.monotonically_increasing_id()), "placed")
    placed = (placed.withColumn(part, F.shiftright(at, 33))
              .withColumn(idx, F.col(at).bitwiseAND(F.lit((1 << 33) - 1))).drop(at))
    keys = [*group, part]
    counts = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min(idx).alias("__first"))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                          (F.coalesce(F.sum("__n").over(before), F.lit(0))
                           - F.col("__first")).alias("__shift"))
    same = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    return placed.join(shift, same).select(*df.columns, (F.col(idx) + F.col("__shift")).alias(name))
