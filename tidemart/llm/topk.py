"""Exact top-k search by inner product: ball trees per shard, branch and bound, shared kth scores."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import documents, ranked, stored
from tidemart.llm.vectors import FOUND, QUERY_STEP, Top, best, by_dimension, floors, matrix, usable

LEAF_ROWS = 64
EXACT = 2.0 ** 53  # whole numbers up to here are exact in double
LARGEST = 2 ** 63 - 1


class BallTree:
    """Nodes with centre and radius over the rows of one shard; leaves hold up to `leaf` rows.

    A node is split by the projection on the line between a far row and the row farthest from it, at
    the median, so equal rows do not stop the split.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF_ROWS):
        self.centres, self.radii, self.parents, self.leaves = [], [], [], []
        pending = [(np.arange(len(points)), -1)]
        while pending:
            rows, parent = pending.pop()
            own = points[rows]
            centre = own.mean(axis=0)
            distance = np.sqrt(((own - centre) ** 2).sum(axis=1))
            node = len(self.centres)
            self.centres.append(centre)
            self.radii.append(distance.max())
            self.parents.append(parent)
            if len(rows) <= leaf:
                self.leaves.append((node, rows))
                continue
            one = own[distance.argmax()]
            other = own[((own - one) ** 2).sum(axis=1).argmax()]
            order = np.argsort((own - one) @ (other - one), kind="stable")
            half = len(rows) // 2
            pending += [(rows[order[:half]], node), (rows[order[half:]], node)]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest possible inner product per query and node, never above that of the node's parent."""
        norms = np.sqrt((queries ** 2).sum(axis=1))
        centres = np.array(self.centres)
        top = queries @ centres.T + norms[:, None] * np.array(self.radii)
        slack = 1e-9 * (1 + norms[:, None] * (np.sqrt((centres ** 2).sum(axis=1)) + np.array(self.radii)))
        top += slack  # rounding must not cut a row
        for node, parent in enumerate(self.parents):  # parents come first
            if parent >= 0:
                np.minimum(top[:, node], top[:, parent], out=top[:, node])
        return top

    def search(self, queries: np.ndarray, points: np.ndarray, ids: np.ndarray, rows: np.ndarray,
               top: Top, places: np.ndarray) -> None:
        """Every query visits leaves from the largest bound down until the bound is below its kth score."""
        nodes = np.array([n for n, _ in self.leaves])
        bounds = self.bounds(queries)[:, nodes]
        order = np.argsort(-bounds, axis=1, kind="stable")
        active = np.arange(len(queries))
        for step in range(len(nodes)):
            leaf = order[active, step]
            open_ = bounds[active, leaf] >= top.kth()[places[active]]
            active, leaf = active[open_], leaf[open_]
            if not len(active):
                return
            for number in np.unique(leaf):
                asking = active[leaf == number]
                members = self.leaves[number][1]
                top.add(places[asking], queries[asking] @ points[members].T, ids[members], rows[members])


def quantised(vectors: pd.Series, scale: float = 64.0) -> np.ndarray:
    return np.floor(matrix(vectors) * scale)


def _large(queries: pd.DataFrame, rows: pd.DataFrame, q: np.ndarray, x: np.ndarray, k: int) -> pd.DataFrame:
    """Whole numbers beyond double's: plain Python arithmetic, scores cut at the ends of long."""
    own = [[int(v) for v in row] for row in x]
    found = []
    for i, row_id in enumerate(queries["row_id"]):
        vec = [int(v) for v in q[i]]
        scores = [(-max(-LARGEST, min(LARGEST, sum(a * b for a, b in zip(vec, y, strict=True)))), v, r)
                  for y, v, r in zip(own, rows["vec_id"], rows["row_id"], strict=True) if r != row_id]
        found += [(row_id, queries["vec_id"].iloc[i], r, v, -s) for s, v, r in sorted(scores)[:k]]
    return pd.DataFrame(found, columns=["query_row", "query_id", "row_id", "vec_id", "score"]).astype("int64")


def _searcher(k: int, scale: float):
    def run(_: tuple, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        nothing = Top(np.empty(0, "int64"), k, np.empty(0)).frame(np.empty(0, "int64"))
        parts = [nothing.astype({"score": "int64"})]
        row_sets = by_dimension(rows["vec"])
        for size, asking in by_dimension(queries["vec"]).items():
            if size not in row_sets:
                continue
            some, own = queries.iloc[asking], rows.iloc[row_sets[size]]
            q, x = quantised(some["vec"], scale), quantised(own["vec"], scale)
            if size * float(np.abs(q).max()) * float(np.abs(x).max()) >= EXACT:
                parts.append(_large(some, own, q, x, k))
                continue
            top = Top(some["row_id"].to_numpy(), k, some["floor"].to_numpy(float))
            BallTree(x).search(q, x, own["vec_id"].to_numpy(), own["row_id"].to_numpy(), top,
                               np.arange(len(q)))
            parts.append(top.frame(some["vec_id"].to_numpy()).astype({"score": "int64"}))
        return pd.concat(parts)

    return run


def top_k(embeddings: DataFrame, k: int = 20, step: int = QUERY_STEP, scale: float = 64.0,
          shard_rows: int = 1024, block_rows: int = 1024, growth: int = 4) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product of floor(scale * x) vectors.

    Queries are the rows whose id `step` divides, each against all rows but itself; vectors of
    another length are not compared. Rows are sorted by norm and cut in shards of equal size; queries are taken
    in blocks. The first wave searches the shard of the largest norms, each further one `growth` times as
    many shards. The kth scores reached so far go with the queries into the next wave, which meets only
    shards whose largest norm can still reach a kth score of the block and gives back only rows that
    reach it, so what is given back grows with the number of waves, the logarithm of the rows. Inside a shard a
    ball tree is searched leaf by leaf, largest bound first.
    Blocks and shards are of bounded size whatever the data, equal vectors included. Scores are exact
    whole numbers; beyond the range of long they are cut at its ends. Ties go to the smaller vec_id, repeated
    rows are rows of their own, other columns do not matter. No usable row: no result.
    """
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + F.pow(F.floor(x * scale).cast("double"),
                                                                        F.lit(2.0))))
    rows = stored(usable(embeddings, False).withColumn("norm", norm), "vectors")
    rows = ranked(rows, [], [F.col("norm").desc(), F.col("row_id")], "place")
    rows = stored(rows.withColumn("shard", F.floor(F.col("place") / shard_rows)).drop("place"), "shards")
    shards = rows.groupBy("shard").agg(F.max("norm").alias("max_norm"))
    queries = rows.filter(F.col("vec_id") % step == 0)
    blocks = max(1, math.ceil(queries.count() / block_rows))
    last = rows.agg(F.max("shard")).first()[0]
    queries = stored(queries.select("row_id", "vec_id", "vec", "norm", F.pmod(
        F.xxhash64("row_id"), F.lit(blocks)).alias("block")), "queries")

    def wave(asked: DataFrame, pairs: DataFrame) -> DataFrame:
        """Search of the shards paired with each block; asked has (.., block, floor)."""
        left = asked.join(pairs, "block").select("block", "shard", "row_id", "vec_id", "vec", "floor")
        right = rows.join(pairs.toDF("block", "shard"), "shard").select("block", "shard", "row_id", "vec_id", "vec")
        found = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInPandas(
            _searcher(k, scale), FOUND.replace("score double", "score long"))
        return stored(best(found, k).drop("rank"), "found")

    known, start, size = None, 0, 1
    while last is not None and start <= last:
        stop = min(last, start + size - 1)
        if known is None:
            asked = queries.withColumn("floor", F.lit(None).cast("double"))
        else:
            reached = floors(known, k).select(F.col("query_row").alias("row_id"),
                                              F.col("floor").cast("double"))
            asked = stored(queries.join(reached, "row_id", "left"), "queries")
        # The least norm a row needs to reach the kth score of some query of the block.
        reach = asked.groupBy("block").agg(F.min(F.when(F.col("floor").isNull(), 0.0).otherwise(
            F.col("floor") / F.greatest(F.col("norm"), F.lit(1e-300)))).alias("reach"))
        pairs = stored(
            reach.withColumn("shard", F.explode(F.sequence(F.lit(start).cast("long"), F.lit(stop))))
            .join(shards, "shard").filter(F.col("max_norm") * (1 + 1e-9) >= F.col("reach"))
            .select("block", "shard"), "pairs")
        if known is not None and pairs.limit(1).count() == 0:
            break  # later shards have smaller norms
        found = wave(asked, pairs)
        known = found if known is None else stored(
            best(known.unionByName(found), k).drop("rank"), "found")
        start, size = stop + 1, size * growth
    if known is None:
        known = embeddings.sparkSession.createDataFrame([], FOUND.replace("score double", "score long"))
    return best(known, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op1_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(documents(spark, folder, "vec_id", "embedding", table="embeddings"))


# Component by component with exact whole numbers; nulls and non-finite components drop the vector.
OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
