"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemart.llm.common import documents, fresh, ranked, stored, wide_key

OFFSETS = 16
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cap: float = 3.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, weigh 1, 2, 3 and again; they share the sum of all sizes by
    weight. A target stops at `cap` times its source's size and the rest is shared among the others by
    weight, until none is above. The level is found in one pass: sources in order of cap / weight
    are full as long as their cap is at most their part of what the earlier ones left; the first
    other one has the level of all that follow. The windows run over the sources only.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranks = sizes.select("source", "source_size",
                         ((F.row_number().over(order) - 1) % 3 + 1).cast("long").alias("weight"))
    full = F.col("source_size") * F.lit(cap)
    filling = Window.orderBy(full / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = ranks.select(
        "source", "source_size", "weight", full.alias("full"), F.row_number().over(filling).alias("at"),
        ((F.sum("source_size").over(everything) - F.coalesce(F.sum(full).over(before), F.lit(0.0)))
         / F.sum("weight").over(onward)).alias("level"))
    free = F.col("full") > F.col("level") * F.col("weight")
    return levels.select(
        "source", "source_size", "weight", "full",
        F.min(F.when(free, F.struct("at", "level"))).over(everything)["level"].alias("level")).select(
        "source", "source_size",
        F.least("full", F.coalesce(F.col("level") * F.col("weight"), F.col("full"))).alias("target"))


def systematic_copies(rows: DataFrame, keys: list[str], seed: int = 29, cap: float = 3.0) -> DataFrame:
    """Adds source_size, target and `copies` to rows with `source` and `size`.

    Each row of a source is expected target / source_size times. Within a source the rows are placed
    from large to small, ties by a seeded hash of `keys`; their expected copies are summed up
    along this order, one random offset per source is added, and a row is taken once for every integer
    its part crosses. Of `OFFSETS` seeded random offsets a source takes the one whose taken size is
    nearest to its target, which matters where a few long rows make up a small source. Sums are place times expectation, so no running sum is needed; ordering by
    size keeps the taken size within about one large row of the target. Rows alike in source, size and
    keys are interchangeable. A source without words is not taken. `copies` never exceeds `cap`. A null
    source is a source, no row gives no row; columns of rows must not begin with two underscores.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    heads = [F.substr(F.md5(F.concat_ws("|", F.lit(f"{seed}|{j}"), "source")), F.lit(1), F.lit(5))
             for j in range(OFFSETS)]
    offsets = F.array(*[F.conv(h, 16, 10).cast("long") / float(1 << 20) for h in heads])
    tie = fresh(rows, "__tie")
    base = rows.withColumn(tie, F.md5(F.concat_ws("|", F.lit(str(seed)), *[
        F.col(k).cast("string") for k in keys])))
    places = ranked(base, ["source"], [F.col("size").desc(), F.col(tie)], "__place")
    expected = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))

    def crossed(offset: Column) -> Column:
        upto = F.floor(F.col("__place") * expected + offset)
        after = F.floor((F.col("__place") + 1) * expected + offset)
        return F.least(after - upto, F.lit(int(cap)).cast("long"))

    targets = source_targets(sizes, cap).withColumn("__offsets", offsets).withColumnRenamed(
        "source", "__source")
    placed = places.join(targets, F.col("source").eqNullSafe(F.col("__source")))
    trials = placed.groupBy("__source", "target").agg(F.first("__offsets").alias("__offsets"), *[
        F.sum(F.col("size") * crossed(F.col("__offsets")[j])).alias(f"__t{j}") for j in range(OFFSETS)])
    nearest = F.array_min(F.array(*[F.struct(
        F.abs(F.col(f"__t{j}") - F.col("target")).alias("off"), F.lit(j).alias("j"),
        F.col("__offsets")[j].alias("u")) for j in range(OFFSETS)]))["u"]
    chosen = trials.select(F.col("__source").alias("__of"), nearest.alias("__offset"))
    return (placed.drop("__offsets").join(chosen, F.col("__source").eqNullSafe(F.col("__of")))
            .withColumn("copies", crossed(F.col("__offset")))
            .drop("__source", "__of", "__place", "__offset", tie))


def mix(docs: DataFrame, seed: int = 29) -> DataFrame:
    """Documents repeated as often as the mix takes them, with the columns of `docs`.

    Copies are decided on (source, size, key) rows and joined back by key, a hash of id and text.
    Rows that agree in all of these share their copies: each gets the whole part, the first of
    them one more. Null texts have size 0 and are taken like others, null ids and sources are values of their
    own, columns of any name are kept; an empty table stays empty.
    """
    rows = docs.select(F.struct("*").alias("row"), wide_key("doc_id", "source", "text").alias("key"))
    small = stored(docs.select(wide_key("doc_id", "source", "text").alias("key"), "source",
                               word_count().alias("size")), "mix")
    taken = (systematic_copies(small, ["key"], seed).groupBy("key")
             .agg(F.sum("copies").alias("taken"), F.count(F.lit(1)).alias("alike")).filter("taken > 0"))
    joined = rows.join(taken, "key")
    spare, whole = F.col("taken") % F.col("alike"), F.floor(F.col("taken") / F.col("alike"))
    first = F.row_number().over(Window.partitionBy("key").orderBy("key")) <= spare
    single = joined.filter(spare == 0).select("row", whole.alias("copies"))
    shared = joined.filter(spare > 0).select("row", (whole + first.cast("int")).alias("copies"))
    return (single.unionByName(shared).filter("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "source", "text").select(
        "doc_id", "source", word_count().alias("size"))
    return systematic_copies(stored(docs, "mix"), ["doc_id"]).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
        "source", "copies")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, 3.0::DOUBLE * source_size AS cap,
        (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
l AS (SELECT *, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS place,
        (CAST(sum(source_size) OVER () AS DOUBLE)
         - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / CAST(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM w),
t AS (SELECT source, source_size,
        least(cap, coalesce((SELECT min_by(level, place) FROM l WHERE cap > level * weight) * weight, cap)) AS target
      FROM l),
r AS (SELECT d.*, t.source_size, t.target, coalesce(t.target / nullif(t.source_size, 0), 0) AS f,
        row_number() OVER (PARTITION BY d.source ORDER BY size DESC,
                           md5(concat_ws('|', '29', CAST(d.doc_id AS VARCHAR)))) - 1 AS i
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
o AS (SELECT source, j,
        CAST('0x' || substr(md5(concat_ws('|', '29|' || j, source)), 1, 5) AS BIGINT) / 1048576.0::DOUBLE AS u
      FROM t CROSS JOIN (SELECT unnest(range(16)) AS j)),
e AS (SELECT o.source, o.j, o.u,
        abs(sum(size * least(floor((i + 1) * f + u) - floor(i * f + u), 3)) - any_value(target)) AS off
      FROM r JOIN o ON r.source IS NOT DISTINCT FROM o.source GROUP BY o.source, o.j, o.u),
b AS (SELECT source, arg_min(u, (off, j)) AS u FROM e GROUP BY source),
c AS (SELECT r.*, CAST(least(floor((i + 1) * f + u) - floor(i * f + u), 3) AS BIGINT) AS copies
      FROM r JOIN b ON r.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM c
"""
