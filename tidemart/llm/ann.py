"""Approximate nearest neighbours by balanced posting lists and a graph over their centroids."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import documents, stored
from tidemart.llm.vectors import FOUND, QUERY_STEP, Top, best, floors, matrix, usable

# Bounds of what is fitted and sent to the tasks: rows of the sample and number of lists.
SAMPLE_ROWS, MOST_LISTS = 20_000, 4096
LIST_ROWS = 512  # rows a list should have before replicas
REPLICAS, REPLICA_RATIO = 4, 1.15
DEGREE = 16
PROBE_QUERIES, TARGET = 96, 0.96  # queries the ratio is set with, and the share of neighbours wanted


class Centroids:
    """Centres of the lists in a space where the nearest is the one of largest inner product.

    Rows get one more component, sqrt(M^2 - |x|^2) with M the largest norm, queries get 0 there. A graph links
    each centre with its nearest ones; a search walks from the entry over all links to
    centres within the asked ratio of the nearest one seen.
    """

    def __init__(self, sample: np.ndarray, lists: int, largest: float, seed: int = 5):
        self.largest = largest
        points = self.lifted(np.unique(sample, axis=0))
        self.centres = self._balanced(points, max(1, min(lists, len(points))))
        squares = (self.centres ** 2).sum(axis=1)
        between = squares[:, None] + squares[None, :] - 2 * self.centres @ self.centres.T
        near = np.argsort(between, axis=1, kind="stable")[:, 1:DEGREE + 1]
        links = [set(row.tolist()) for row in near]
        for node, row in enumerate(near.tolist()):
            for other in row:
                links[other].add(node)
        # A ring through all centres in random order keeps the graph in one piece.
        ring = np.random.default_rng(seed).permutation(len(links)).tolist()
        for a, b in zip(ring, ring[1:] + ring[:1], strict=True):
            if a != b:
                links[a].add(b)
                links[b].add(a)
        self.links = [np.array(sorted(x), dtype=int) for x in links]
        self.squares = squares
        self.entry = int(((self.centres - self.centres.mean(axis=0)) ** 2).sum(axis=1).argmin())

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.largest ** 2 - (rows ** 2).sum(axis=1), 0.0)
        return np.hstack([rows, np.sqrt(rest)[:, None]])

    @staticmethod
    def _balanced(points: np.ndarray, lists: int) -> np.ndarray:
        """Centres of equally filled parts: split by two means at the quantile that shares the lists."""
        pending, centres = [(points, lists)], []
        while pending:
            own, count = pending.pop()
            if count <= 1 or len(own) <= 1:
                centres.append(own.mean(axis=0))
                continue
            one = own[((own - own.mean(axis=0)) ** 2).sum(axis=1).argmax()]
            two = own[((own - one) ** 2).sum(axis=1).argmax()]
            for _ in range(4):
                side = ((own - one) ** 2).sum(axis=1) <= ((own - two) ** 2).sum(axis=1)
                if side.all() or not side.any():
                    break
                one, two = own[side].mean(axis=0), own[~side].mean(axis=0)
            order = np.argsort(own @ (two - one), kind="stable")
            left = count // 2
            cut = min(max(round(len(own) * left / count), 1), len(own) - 1)
            pending += [(own[order[:cut]], left), (own[order[cut:]], count - left)]
        return np.array(centres)

    def near(self, point: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """(lists, distances) within `ratio` times the nearest distance found, nearest first."""
        square = float(point @ point)
        seen = np.zeros(len(self.centres), bool)
        distance = np.full(len(self.centres), np.inf)

        def visit(nodes: np.ndarray) -> None:
            seen[nodes] = True
            own = self.squares[nodes] + square - 2 * self.centres[nodes] @ point
            distance[nodes] = np.sqrt(np.maximum(own, 0.0))

        visit(np.array([self.entry]))
        opened = np.zeros(len(self.centres), bool)
        while True:
            # Opened a little beyond the ratio, so that a list behind a farther one is found.
            todo = np.flatnonzero(~opened & (distance <= distance.min() * ratio * 1.1))
            if not len(todo):
                break
            opened[todo] = True
            reached = np.unique(np.concatenate([self.links[n] for n in todo]))
            reached = reached[~seen[reached]]
            if len(reached):
                visit(reached)
        within = np.flatnonzero(distance <= distance.min() * ratio)
        within = within[np.argsort(distance[within], kind="stable")]
        return within, distance[within]

    def homes(self, point: np.ndarray) -> list[int]:
        """Lists that keep a row: the nearest and, near a border, others that no kept one shadows."""
        lists, distance = self.near(point, REPLICA_RATIO)
        kept: list[int] = []
        for node, far in zip(lists.tolist(), distance.tolist(), strict=True):
            if len(kept) == REPLICAS:
                break
            if all(((self.centres[node] - self.centres[k]) ** 2).sum() > far * far for k in kept):
                kept.append(node)
        return kept


def fit(rows: DataFrame, dimension: int, largest: float, total: int, sample_rows: int = SAMPLE_ROWS,
        list_rows: int = LIST_ROWS, most_lists: int = MOST_LISTS) -> Centroids:
    """Centroids from at most `sample_rows` rows chosen by a hash of their number."""
    share = min(1.0, sample_rows / max(total, 1))
    part = rows.filter(F.pmod(F.xxhash64(F.lit(3), "row_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    sample = matrix(part.select("vec").limit(sample_rows).toPandas()["vec"])
    lists = min(most_lists, max(1, total // list_rows))
    return Centroids(sample.reshape(-1, dimension), lists, largest)


def _postings(rows: DataFrame, sent) -> DataFrame:
    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = sent.value
        for batch in batches:
            homes = [index.homes(p) for p in index.lifted(matrix(batch["vec"]))] if len(batch) else []
            yield batch.assign(list=homes)[["row_id", "vec_id", "vec", "list"]]

    homes = rows.mapInPandas(assign, "row_id long, vec_id long, vec array<double>, list array<int>")
    return homes.withColumn("list", F.explode("list"))


def _truth(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The exact neighbours of the few queries that set the ratio, over all rows."""
    asked = queries.toPandas()
    q, row_ids, ids = matrix(asked["vec"]), asked["row_id"].to_numpy(), asked["vec_id"].to_numpy()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top = Top(row_ids, k, np.full(len(row_ids), np.nan))
        for batch in batches:
            if len(batch):
                top.add(np.arange(len(q)), scores(q, matrix(batch["vec"])), batch["vec_id"].to_numpy(),
                        batch["row_id"].to_numpy())
        yield top.frame(ids)

    return best(rows.select("row_id", "vec_id", "vec").mapInPandas(scan, FOUND), k)


def scores(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner products, each summed in the same order wherever the row stands, so equal rows tie."""
    return np.einsum("qd,nd->qn", queries, points)


def set_ratio(index: Centroids, rows: DataFrame, queries: DataFrame, postings: DataFrame, k: int,
              target: float = TARGET, probes: int = PROBE_QUERIES) -> float:
    """The least ratio of list distances at which `target` of the exact neighbours of some queries are kept.

    Neighbours come from a scan of all rows for at most `probes` queries; each needs the ratio of its
    nearest list.
    """
    some = queries.orderBy(F.xxhash64(F.lit(11), "row_id")).limit(probes)
    some = stored(some.select("row_id", "vec_id", "vec"), "probes")
    asked = some.toPandas()
    if asked.empty:
        return 1.0
    found = _truth(rows, some, k).select("query_row", "row_id")
    homes = found.join(postings.select("row_id", "list"), "row_id").toPandas()
    if homes.empty:
        return 1.0
    points = matrix(asked["vec"])
    points = np.hstack([points, np.zeros((len(points), 1))])
    far = np.sqrt(np.maximum(index.squares[None, :] + (points ** 2).sum(axis=1)[:, None]
                             - 2 * points @ index.centres.T, 0.0))
    place = {r: i for i, r in enumerate(asked["row_id"])}
    at = homes["query_row"].map(place).to_numpy()
    homes["need"] = far[at, homes["list"].to_numpy()] / np.maximum(far[at].min(axis=1), 1e-300)
    need = np.sort(homes.groupby(["query_row", "row_id"])["need"].min().to_numpy())
    return float(max(1.0, need[math.ceil(target * len(need)) - 1])) * (1 + 1e-9)


def _searcher(k: int):
    def run(_: tuple, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        top = Top(queries["row_id"].to_numpy(), k, queries["floor"].to_numpy(float))
        if len(queries) and len(rows):
            top.add(np.arange(len(queries)), scores(matrix(queries["vec"]), matrix(rows["vec"])),
                    rows["vec_id"].to_numpy(), rows["row_id"].to_numpy())
        return top.frame(queries["vec_id"].to_numpy())

    return run


def nearest(embeddings: DataFrame, k: int = 20, step: int = QUERY_STEP, block_rows: int = 1024,
            query_rows: int = 1024, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score): about the k rows of largest inner product, nearest first.

    Queries are the rows whose id `step` divides, each against all rows but itself of the same vector length; a
    length has an index of its own, those of at most `LIST_ROWS` rows are searched exactly in one job. Centres are fitted on
    a bounded sample; every row is then kept in its nearest list and, near borders, in up to
    `REPLICAS`. Lists longer than `block_rows`, as many equal rows make them, are cut in blocks
    that are all searched. A query takes the lists within a ratio of its nearest one; the ratio is
    measured, see `set_ratio`. The nearest two lists are searched first, and their kth scores limit what
    the others give back. Scores are sums in double over the original vectors. Without usable vectors the result is
    empty. Ties go to the smaller vec_id, repeated rows are rows of their own, other columns do not matter.
    """
    rows = stored(usable(embeddings, True).withColumn("d", F.size("vec")), "vectors")
    sizes = stored(rows.groupBy("d").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)).alias("m")), "lengths")
    few = rows.join(sizes.filter(F.col("n") <= LIST_ROWS).select("d"), "d").withColumn("floor", F.lit(None).cast("double"))
    found = few.filter(F.col("vec_id") % step == 0).toDF(*few.columns).groupBy("d").cogroup(few.groupBy("d")).applyInPandas(
        _searcher(k), FOUND)
    for length in sizes.filter(F.col("n") > LIST_ROWS).orderBy("d").toLocalIterator():
        found = found.unionByName(_indexed(rows.filter(F.col("d") == length["d"]).drop("d"), length["d"], length["n"],
                                           math.sqrt(length["m"]), k, step, block_rows, query_rows, target))
    return best(found, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _indexed(rows: DataFrame, dimension: int, total: int, largest: float, k: int, step: int, block_rows: int,
             query_rows: int, target: float) -> DataFrame:
    """The k best found of each query among rows of one length, by posting lists."""
    index = fit(rows, dimension, largest, total)
    sent = rows.sparkSession.sparkContext.broadcast(index)
    postings = stored(_postings(rows, sent), "postings")
    queries = rows.filter(F.col("vec_id") % step == 0)
    ratio = set_ratio(index, rows, queries, postings, k, target)
    blocks = max(1, math.ceil(queries.count() / query_rows))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sent.value
        for batch in batches:
            points = matrix(batch["vec"])
            lists = [own.near(np.append(p, 0.0), ratio)[0].tolist() for p in points]
            yield batch.assign(lists=lists)

    asked = stored(queries.select("row_id", "vec_id", "vec", F.pmod(
        F.xxhash64("row_id"), F.lit(blocks)).alias("part")).mapInPandas(
        probe, "row_id long, vec_id long, vec array<double>, part long, lists array<int>"), "queries")
    cuts = postings.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("cuts"))

    def wave(some: DataFrame) -> DataFrame:
        left = some.select("list", "part", "row_id", "vec_id", "vec", "floor").join(cuts, "list").withColumn(
            "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1))).drop("cuts")
        left = stored(left, "asked")
        met = left.select("list", "block", "part").distinct().toDF("l", "b", "part")
        right = (postings.join(cuts, "list").withColumn("block", F.pmod(F.xxhash64("row_id"), F.col("cuts")))
                 .join(met, (F.col("list") == F.col("l")) & (F.col("block") == F.col("b")))
                 .select("list", "block", "part", "row_id", "vec_id", "vec"))
        keys = ["list", "block", "part"]
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_searcher(k), FOUND)
        # A replica found in two lists is one row.
        return stored(best(found.dropDuplicates(["query_row", "row_id"]), k).drop("rank"), "found")

    first = wave(asked.withColumn("floor", F.lit(None).cast("double"))
                 .withColumn("list", F.explode(F.slice("lists", 1, 2))))
    known = floors(first, k).withColumnRenamed("query_row", "row_id")
    rest = asked.join(known, "row_id", "left").withColumn(
        "list", F.explode(F.slice("lists", 3, MOST_LISTS)))
    found = first.unionByName(wave(rest)).dropDuplicates(["query_row", "row_id"])
    return best(found, k).drop("rank")


def op7_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(documents(spark, folder, "vec_id", "embedding", table="embeddings"))
