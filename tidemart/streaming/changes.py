"""Applying a change stream (before/after images) to a keyed table.

A batch is written as the latest version of each key it changes, into the folder of its number, which a replay overwrites.
The table is the latest version per key over the compacted rows and the batches since then. Taking the latest does
not depend on order or repetition: a batch that was cut short, is applied twice or is already compacted does no harm.
Deleted keys stay as marked rows, so that an older change arriving later cannot revive them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.ranking import latest_rows
from tidemart.sources.writers import exists, replace_table, restore

DELETE = "d"
# Batches between two compactions.
COMPACT_EVERY = 64


def _parsed(stream: DataFrame, row_schema: str) -> DataFrame:
    envelope = f"before {row_schema}, after {row_schema}, op string, ts bigint, pos bigint"
    c = stream.select("value", F.from_json("value", envelope).alias("c"))
    row = F.when(F.col("c.op") == DELETE, F.col("c.before")).otherwise(F.col("c.after"))
    return c.select("value", row.alias("r"), "c.op", "c.ts", "c.pos")


def _usable(key: str):
    return F.col("op").isNotNull() & F.col("r").isNotNull() & F.col(f"r.{key}").isNotNull()


def parse_changes(stream: DataFrame, row_schema: str, key: str) -> DataFrame:
    """Envelope text `{before, after, op, ts, pos}` as columns of the row plus `op`, `ts`, `pos`.

    Deletes carry the row in `before`. Messages without operation, row or key are in
    `rejected_changes`.
    """
    return _parsed(stream, row_schema).where(_usable(key)).select("r.*", "op", "ts", "pos")


def rejected_changes(stream: DataFrame, row_schema: str, key: str) -> DataFrame:
    """The messages (`value`) that `parse_changes` cannot use."""
    return _parsed(stream, row_schema).where(~F.coalesce(_usable(key), F.lit(False))).select("value")


def merge_changes(stored: DataFrame | None, changes: DataFrame, key: str) -> DataFrame:
    """The latest version of every key, by time and position, then by operation and content."""
    rows = changes if stored is None else stored.select(*changes.columns).unionByName(changes)
    rest = [c for c in changes.columns if c not in (key, "ts", "pos", "op")]
    return latest_rows(rows, [key], ["ts", "pos", "op", *rest])


def _batches(path: str) -> str:
    return f"{path}/changes"


def _versions(spark: SparkSession, path: str) -> DataFrame:
    """Compacted rows and those of all batches; a key may have several versions."""
    base = f"{path}/base"
    restore(spark, base)
    parts = [spark.read.parquet(p) for p in (_batches(path), base) if exists(spark, p)]
    rows = [p.drop("batch") for p in parts]
    return rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])


def _remove(spark: SparkSession, folders: list) -> None:
    for folder in folders:
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def compact(spark: SparkSession, path: str, key: str) -> None:
    """Put the latest version of every key into `base` and remove the batches it holds.

    To be run where batches are applied, not beside it. Stopped at any point it leaves the same table: batches that are
    in `base` already change nothing, and a swap that was cut short is put right by the next reader.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(_batches(path))
    held = [s.getPath() for s in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)]
    replace_table(merge_changes(None, _versions(spark, path), key), f"{path}/base", "parquet")
    # The last batch stays, so that the folder can always be read.
    _remove(spark, sorted((p for p in held if p.getName().startswith("batch=")), key=lambda p: p.getName())[:-1])


def apply_batch(path: str, key: str, compact_every: int = COMPACT_EVERY) -> Callable[[DataFrame, int], None]:
    """Batch function: writes one row per changed key, however often a hot key changed."""
    def apply(batch: DataFrame, number: int) -> None:
        (merge_changes(None, batch, key).write.mode("overwrite")
         .parquet(f"{_batches(path)}/batch={number:019d}"))
        if (number + 1) % compact_every == 0:
            compact(batch.sparkSession, path, key)
    return apply


def current_rows(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The table without deleted keys and bookkeeping columns, as of the last batch."""
    latest = merge_changes(None, _versions(spark, path), key)
    return latest.where(F.col("op") != DELETE).drop("op", "ts", "pos")
