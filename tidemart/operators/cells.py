"""Rows as key-value cells (row_key, qualifier, value) and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_to_cells(df: DataFrame, key: Column, skip: tuple[str, ...] = ()) -> DataFrame:
    """One cell per non-null field, the value as text."""
    fields = [c for c in df.columns if c not in skip]
    cells = F.array(*[F.struct(F.lit(c).alias("qualifier"), F.col(c).cast("string").alias("value"))
                      for c in fields])
    return (df.select(key.alias("row_key"), F.explode(cells).alias("cell"))
            .select("row_key", "cell.qualifier", "cell.value")
            .where(F.col("value").isNotNull()))


def cells_to_rows(cells: DataFrame, limit: int | None = None) -> DataFrame:
    """One JSON text per row key, which is part of the JSON, qualifiers in alphabetic order.

    A row has as many cells as its table has qualifiers. Repeated cells of a qualifier are
    reduced to one (the largest value) before they are gathered. `limit` keeps the first rows in
    key order, as a scan with a row limit does.
    """
    if limit is not None:
        keys = cells.select("row_key").distinct().orderBy("row_key").limit(limit)
        cells = cells.join(keys, "row_key", "left_semi")
    single = cells.groupBy("row_key", "qualifier").agg(F.max("value").alias("value"))
    entries = F.array_sort(F.collect_list(F.struct("qualifier", "value")))
    own = F.array(F.struct(F.lit("row_key").alias("qualifier"), F.col("row_key").alias("value")))
    return (single.groupBy("row_key").agg(entries.alias("entries"))
            .select("row_key",
                    F.to_json(F.map_from_entries(F.concat(own, "entries"))).alias("row_json")))


def one_row(cells: DataFrame, row_key: str) -> DataFrame:
    """All cells of one row."""
    return cells.where(F.col("row_key") == row_key)


def count_rows(cells: DataFrame) -> DataFrame:
    """Number of row keys."""
    return cells.agg(F.count_distinct("row_key").cast("bigint").alias("row_count"))
