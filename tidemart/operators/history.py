"""Versions in time: point-in-time join, histories from deliveries in any order, differences of snapshots."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.days import FAR_DAY
from tidemart.operators.placing import stored
from tidemart.operators.ranking import latest_rows


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right, strict=True)])


def as_of(facts: DataFrame, versions: DataFrame, key: str, fact_time: str, start: list[str],
          columns: list[str], part_rows: int = 100_000) -> DataFrame:
    """Facts with `columns` of the version that holds at their time: the last one of their key that starts by then.

    Facts and versions become one sequence sorted by key and time, and a fact takes the last version before it. The
    sequence is dealt by ranges, so a hot key is spread over tasks; what a range takes over is the last version of
    the earlier ranges of its key, found over one row per key and range. So there is no range join and no row is
    repeated. `start` is the version's time and what breaks ties, the largest wins; a version at the very time of a fact holds.
    A fact without an earlier version, key or time has nulls.
    """
    time, ties = start[0], start[1:]
    sequence = facts.select(
        F.col(key).alias("k"), F.col(fact_time).alias("t"), F.lit(1).alias("side"), F.struct("*").alias("fact")
    ).unionByName(versions.where(F.col(time).isNotNull()).select(
        F.col(key).alias("k"), F.col(time).alias("t"), F.lit(0).alias("side"),
        F.struct(*[F.col(c).alias(f"tie{i}") for i, c in enumerate(ties)], F.struct(*columns).alias("v")).alias("version")),
        allowMissingColumns=True)
    parts = max(1, math.ceil(sequence.count() / part_rows))
    order = ["t", "side", *[f"version.tie{i}" for i in range(len(ties))]]
    placed = stored(sequence.repartitionByRange(parts, "k", *order, F.rand(3))
                    .withColumn("part", F.spark_partition_id()), "as-of")
    upto = Window.partitionBy("part", "k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    last = (placed.groupBy("part", "k").agg(F.max(F.when(F.col("side") == 0, F.struct(*[
        F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.col("version.v").alias("v")))).alias("last"))
        .select(F.col("part").alias("of_part"), F.col("k").alias("of_k"),
                F.last("last.v", ignorenulls=True).over(earlier).alias("carried")))
    found = placed.withColumn("own", F.last("version.v", ignorenulls=True).over(upto)).where("side = 1")
    found = found.join(last, _same(["part", "k"], ["of_part", "of_k"]))
    held = F.when(F.col("t").isNotNull() & F.col("k").isNotNull(), F.coalesce("own", "carried"))
    return found.select("fact", held.alias("held")).select(
        "fact.*", *[F.col(f"held.{c}").alias(c) for c in columns])


def history_of(log: DataFrame, key: str, attributes: list[str], delivered: str) -> DataFrame:
    """Validity-dated rows (key, attributes, start_date, end_date) from a log of (key, attributes, start_date, delivered).

    A function of the set of deliveries, so their order does not matter: of several for a key and day the one
    delivered last counts, days that change nothing open no version, a late one in between splits an interval. A key
    has one row per day at most before its days are put in order, which bounds a hot key.
    """
    days = latest_rows(log.select(key, "start_date", delivered, *attributes), [key, "start_date"],
                       [delivered, *attributes])
    order = Window.partitionBy(key).orderBy("start_date")
    value = F.struct(*attributes)
    opened = days.withColumn("changed", F.row_number().over(order).eqNullSafe(1) | ~value.eqNullSafe(
        F.lag(value).over(order))).where("changed")
    end = F.date_sub(F.lead(F.to_date("start_date")).over(order), 1).cast("string")
    return opened.select(key, *attributes, "start_date", F.coalesce(end, F.lit(FAR_DAY)).alias("end_date"))


def revise_history(history: DataFrame, log: DataFrame, new: DataFrame, key: str, attributes: list[str],
                   delivered: str) -> DataFrame:
    """The history after further deliveries: keys that `new` names are rebuilt from the log, the others stay."""
    touched = new.select(key).distinct()
    rebuilt = history_of(log.unionByName(new).join(touched, key, "left_semi"), key, attributes, delivered)
    return history.join(touched, key, "left_anti").unionByName(rebuilt)


def digests(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """(bucket, n, total, mixed) per hash bucket of the key: digests that do not depend on the order of rows."""
    row = F.struct(*sorted(df.columns))
    return df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(row).cast("decimal(38,0)")).alias("total"),
        F.bit_xor(F.xxhash64(F.lit(5), row)).alias("mixed"))


def snapshot_changes(old: DataFrame, new: DataFrame, keys: list[str], buckets: int = 4096) -> DataFrame:
    """Keys with `change` I, U or D from one snapshot to the next, each with one row per key and the same columns.

    Both are digested per bucket first, which sends one row per bucket and task; only rows of buckets that differ are
    joined, so a table that did not change costs that aggregate alone. Two different buckets with equal counts and
    equal 64-bit sums and xors of different hashes would be missed. Columns compare null-safe.
    """
    was, now = digests(old, keys, buckets), digests(new, keys, buckets)
    was = was.withColumnsRenamed({c: f"old_{c}" for c in was.columns})
    same = _same(["n", "total", "mixed"], ["old_n", "old_total", "old_mixed"])
    differ = stored(now.join(was, F.col("bucket") == F.col("old_bucket"), "full_outer").where(~same).select(
        F.coalesce("bucket", "old_bucket").alias("bucket")), "buckets")
    rest = [c for c in new.columns if c not in keys]

    def rows(df: DataFrame, side: str) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
        return (df.withColumn("bucket", bucket).join(differ, "bucket", "left_semi")
                .select(*[F.col(k).alias(f"{side}_{k}") for k in keys],
                        F.struct(F.lit(1).alias("there"), *rest).alias(side)))

    both = rows(old, "old").join(rows(new, "new"), _same([f"old_{k}" for k in keys], [f"new_{k}" for k in keys]),
                                 "full_outer")
    change = (F.when(F.col("old").isNull(), "I").when(F.col("new").isNull(), "D")
              .when(~F.col("old").eqNullSafe(F.col("new")), "U"))
    return both.select(*[F.when(F.col("new").isNull(), F.col(f"old_{k}")).otherwise(F.col(f"new_{k}")).alias(k)
                         for k in keys], change.alias("change")).where("change IS NOT NULL")
