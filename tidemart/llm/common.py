"""Helpers shared by the operators: input, stored intermediate tables, exact ranks, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.placing import fresh, ranked, stored

__all__ = ["components", "documents", "fresh", "ranked", "stored", "wide_key"]


def documents(spark: SparkSession, folder: str, *columns: str, table: str = "documents") -> DataFrame:
    df = spark.read.parquet(f"{folder}/{table}.parquet")
    return df.select(*columns) if columns else df


def wide_key(*columns: str) -> Column:
    """Text of two hashes of the columns' values, 128 bits together."""
    return F.concat_ws("-", F.hex(F.xxhash64(*columns)), F.hex(F.xxhash64(F.lit(7), *columns)))


def components(edges: DataFrame, node: str, hub: str) -> DataFrame:
    """Connected components of a two-sided graph: (node, `component`), component the least node.

    `edges` holds (node, hub) rows, ids long. Each round every hub takes the least label of its
    nodes and every node the least of its hubs, then labels jump to the label of their label, so
    long chains need few rounds. Both steps are sums over keys that combine before the shuffle; joins
    meet one row per key on one side, so a hot hub can be split.
    """
    edges = stored(edges.select(F.col(node).alias("n"), F.col(hub).alias("h")).distinct(), "edges")
    labels = stored(edges.groupBy("n").agg(F.col("n").alias("l")), "labels")
    while True:
        # Stored, so that the join with it can split a hub's many nodes.
        hubs = stored(edges.join(labels, "n").groupBy("h").agg(F.min("l").alias("m")), "hubs")
        near = edges.join(hubs, "h").groupBy("n").agg(F.min("m").alias("m"))
        jump = labels.select(F.col("n").alias("m"), F.col("l").alias("far"))
        step = (labels.join(near, "n").join(jump, "m")
                .select("n", F.least("m", "far").alias("new"), F.col("l").alias("old")))
        step = stored(step, "labels")
        changed = step.filter("new < old").limit(1).count()
        labels = step.select("n", F.col("new").alias("l"))
        if not changed:
            return labels.select(F.col("n").alias(node), F.col("l").alias("component"))
