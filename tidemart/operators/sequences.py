"""Frequent sequences of items in groups of any length."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.operators.history import as_of
from tidemart.operators.placing import ranked, stored


def frequent_sequences(rows: DataFrame, group: str, time: str, tie: str, item: str, one_in: int,
                       longest: int | None = None, part_rows: int = 100_000) -> DataFrame:
    """(path array, length, support) of all sequences of items that at least one in `one_in` groups holds.

    A group holds a sequence if its items come in that order along `time`, `tie`, others may lie between; it counts once
    however often it holds it. Sequences grow by one item as long as any is frequent, or to `longest` items. Rows
    without a group, time or item are left out; groups that are left count as the whole. An empty table gives no row.

    A group and sequence are one row with the place where the sequence is first complete. It goes on with an item whose
    last place in the group is later, so support needs the first and last place of each item, not the rows. Only for
    frequent sequences the place of the next occurrence is looked up, if the item was also seen before: by a point-in-time
    join over places in descending order, dealt by ranges. So rows of a hot group are read where its items repeat and never meet in
    one task; it has a row per frequent sequence and item. A sequence is tried only if its part without the first item is frequent too.
    """
    used = rows.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (group, time, item)])).select(
        F.col(group).alias("g"), F.col(time).alias("t"), F.col(tie).alias("i"), F.col(item).alias("x"))
    places = stored(ranked(stored(used, "items"), ["g"], [F.col("t"), F.col("i"), F.col("x")], "place", part_rows)
                    .select("g", "x", "place"), "places")
    every = stored(places.groupBy("g", "x").agg(F.min("place").alias("first"), F.max("place").alias("last")), "seats")
    total = every.agg(F.count_distinct("g")).first()[0]
    enough = F.col("support") * one_in >= total
    kept = stored(every.groupBy(F.array("x").alias("path")).agg(F.count(F.lit(1)).alias("support")).where(enough), "kept")
    seats = stored(every.join(kept.select(F.col("path")[0].alias("x")), "x", "left_semi")
                   .withColumn("seat", F.monotonically_increasing_id()), "seats")
    # Places count downwards, so the last one up to a place is the next occurrence.
    again = stored(places.join(seats.where("first < last").select("g", "x", "seat"), ["g", "x"]).select(
        "seat", (-F.col("place")).alias("back"), F.col("place").alias("following")), "again")
    held = seats.select("g", F.array("x").alias("path"), F.col("first").alias("at"))
    found = [kept]
    while longest is None or len(found) < longest:
        if len(found) == 1:
            reach = held.join(seats, "g")
        else:
            steps = kept.select("path", F.expr("slice(path, 2, size(path) - 1)").alias("inner")).join(kept.select(
                F.expr("slice(path, 1, size(path) - 1)").alias("inner"), F.element_at("path", -1).alias("x")), "inner")
            reach = held.join(stored(steps.select("path", "x"), "steps"), "path").join(seats, ["g", "x"])
        reach = stored(reach.where("last > at").select(
            "g", F.concat("path", F.array("x")).alias("path"), "at", "first", "seat"), "reach")
        kept = stored(reach.groupBy("path").agg(F.count(F.lit(1)).alias("support")).where(enough), "kept")
        if kept.isEmpty():
            break
        found.append(kept)
        reach = reach.join(kept.select("path"), "path", "left_semi")
        seen = as_of(reach.where("first <= at").withColumn("after", -F.col("at") - 1), again, "seat", "after",
                     ["back"], ["following"], part_rows)
        held = stored(reach.where("first > at").select("g", "path", F.col("first").alias("at")).unionByName(
            seen.select("g", "path", F.col("following").alias("at"))), "held")
    out = reduce(DataFrame.unionByName, found)
    return out.select("path", F.size("path").cast("long").alias("length"), "support")
