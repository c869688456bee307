"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import documents, ranked, stored


def shard_rows(rows: DataFrame, source: str = "source", keys: tuple[str, ...] = ("doc_id",),
               shards: int = 24, seed: int = 17) -> DataFrame:
    """Adds `shard` (from 0) and `slot` (gapless from 0 in its shard); counts differ by one at most.

    Rows of a source are put in a seeded random order, by the hash of `keys`; place r of n rows has the
    fraction (r + 0.5) / n. All rows sorted by that fraction interleave the sources in their proportions, and
    equal cuts of this order give every shard the mixture of the whole. Ties go by source and
    hash; rows alike in source and keys are interchangeable. A null source is a source of its own. Both sorts are
    range sorts, so a hot source is spread over tasks. No row: no shard. Columns named like the
    results are replaced, all others are kept.
    """
    base = stored(rows.drop("shard", "slot").select(
        F.struct("*").alias("row"), F.col(source).alias("source"),
        F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]).alias("mix")), "shard")
    sizes = base.groupBy(F.col("source").alias("of")).agg(F.count(F.lit(1)).alias("n"))
    placed = ranked(base, ["source"], [F.col("mix")], "place").join(
        sizes, F.col("source").eqNullSafe(F.col("of")))
    spread = stored(placed.select("row", "source", "mix", (
        (F.col("place") + 0.5) / F.col("n")).alias("fraction")), "shard")
    order = [F.col("fraction"), F.col("source").asc_nulls_last(), F.col("mix")]
    total = spread.count()
    small, more = divmod(total, shards)  # `more` shards have one row more than the others
    edge = more * (small + 1)
    p = F.col("at")
    shard = F.when(p < edge, F.floor(p / (small + 1))).otherwise(
        more + F.floor((p - edge) / max(small, 1))).cast("int")
    start = F.when(F.col("shard") < more, F.col("shard") * F.lit(small + 1).cast("long")).otherwise(
        F.lit(edge).cast("long") + (F.col("shard") - more) * F.lit(small).cast("long"))
    return (ranked(spread, [], order, "at").select("row", "at", shard.alias("shard"))
            .select("row.*", "shard", (p - start).alias("slot")))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in one of 24 shards, law `rows`. A null text has no bytes and checksum 0."""
    docs = documents(spark, folder, "doc_id", "source", "text").select(
        "doc_id", "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    return shard_rows(docs, keys=("doc_id", "text_crc32")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
