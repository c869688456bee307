"""Catalog entries for stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import MB, table_bytes
from tidemart.sources.writers import COMPRESSION, FORMAT

# Bytes of the largest table stored behind one bucket.
BUCKET_BYTES = 16 * MB


def declare_table(df: DataFrame, name: str, path: str, partition: str | None = "ds",
                  fmt: str = FORMAT) -> None:
    """Declare an external table with the columns of a job's result over the folder it is written
    to: columnar, compressed, partitioned by day. Dropping it leaves the files."""
    spark = df.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    parts = f"PARTITIONED BY (`{partition}`)" if partition in df.columns else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}"
              f" OPTIONS (compression '{COMPRESSION}') {parts} LOCATION '{path}'")


def declare_tsv(df: DataFrame, name: str, path: str) -> None:
    """Declare an external table over tab-separated text, as written by `write_tsv`."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    df.sparkSession.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING csv"
                        f" OPTIONS (sep '\\t', nullValue '\\\\N') LOCATION '{path}'")


def insert_day(df: DataFrame, name: str) -> None:
    """Replace the days that occur in the rows of a declared table, columns matched by name."""
    spark = df.sparkSession
    # `insertInto` heeds the session setting only; with `static` it would empty the other days.
    if spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() != "dynamic":
        raise RuntimeError("set spark.sql.sources.partitionOverwriteMode to dynamic")
    target = spark.table(name)
    (df.select(*target.columns).hint("rebalance", F.col("ds")).write.mode("overwrite")
     .insertInto(name))


def buckets_for(spark: SparkSession, path: str, least: int = 8) -> int:
    """Number of buckets that fits a table; above Spark's own limit of buckets they grow instead."""
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(max(least, -(-table_bytes(spark, path) // BUCKET_BYTES)), max(least, most))


def store_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Replace an external table by the rows of `df` in buckets of the key columns, and read it.

    Tables stored with the same keys and number of buckets are joined and aggregated by these keys without an
    exchange; the rows are shuffled once, when they are written, one file per bucket. All rows of a key are in one
    bucket, so this is for keys with few rows each (orders, lines by order), not for users or products. A task sorts
    whole buckets, unpacked and never merged or split, so a bucket should stay at some dozen stored megabytes
    (`buckets_for`); the number grows with the table, and both sides are stored anew then.
    """
    (df.repartition(buckets, *keys).write.mode("overwrite").format(FORMAT).option("compression", COMPRESSION)
     .option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return df.sparkSession.table(name)


def refresh_days(spark, name: str) -> None:
    """Make days visible that were written to the folder directly."""
    spark.sql(f"MSCK REPAIR TABLE {name}")
