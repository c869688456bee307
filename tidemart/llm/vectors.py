"""What the two vector searches share: usable rows, top lists, and pairing of query and row blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

QUERY_STEP = 20
NOTHING = np.iinfo("int64").max


def usable(embeddings: DataFrame, nonzero: bool) -> DataFrame:
    """(row_id, vec_id, vec) of rows with an id and a vector of finite components.

    Null or empty vectors and vectors with a null or non-finite component take no part, with `nonzero`
    vectors of zeros as well. Rows of one id stay apart by row_id.
    """
    vec = F.col("embedding").cast("array<double>")
    rows = (embeddings.select(F.monotonically_increasing_id().alias("row_id"),
                              F.col("vec_id").cast("long"), vec.alias("vec"))
            .filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0))
            .filter(~F.coalesce(F.exists("vec", lambda x: x.isNull() | F.isnan(x)
                                         | (F.abs(x) == float("inf"))), F.lit(True))))
    return rows.filter(F.exists("vec", lambda x: x != 0)) if nonzero else rows


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v, dtype=float) for v in vectors]) if len(vectors) else np.empty((0, 0))


def by_dimension(vectors: pd.Series) -> dict[int, np.ndarray]:
    """Places of the vectors of each length."""
    lengths = np.array([len(v) for v in vectors], dtype=int)
    return {int(n): np.flatnonzero(lengths == n) for n in np.unique(lengths)}


class Top:
    """The k best (score, vec_id) of each query so far; ties to the smaller id.

    `floor` is a score known to be reached k times elsewhere; only scores of at least it are kept.
    """

    def __init__(self, query_rows: np.ndarray, k: int, floor: np.ndarray, kind=float):
        n = len(query_rows)
        self.k, self.query_rows = k, query_rows
        self.floor = np.where(np.isnan(floor), -np.inf, floor) if n else floor
        self.scores = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), NOTHING, "int64")
        self.rows = np.full((n, k), -1, "int64")

    def kth(self) -> np.ndarray:
        return np.maximum(self.scores[:, -1], self.floor)

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Offer rows to the queries at places `at`; scores has a line per query. Own rows are left out."""
        scores = np.where(self.query_rows[at][:, None] == rows[None, :], -np.inf, scores)
        fits = scores >= self.kth()[at][:, None]
        fits &= np.isfinite(scores)
        some = fits.any(axis=1)
        if not some.any():
            return
        at, scores, fits = at[some], scores[some], fits[some]
        columns = fits.any(axis=0)
        scores, fits = scores[:, columns], fits[:, columns]
        shape = scores.shape
        scores = np.concatenate([self.scores[at], np.where(fits, scores, -np.inf)], axis=1)
        names = np.concatenate([self.ids[at], np.broadcast_to(ids[columns], shape)], axis=1)
        places = np.concatenate([self.rows[at], np.broadcast_to(rows[columns], shape)], axis=1)
        order = np.lexsort((places, names, -scores), axis=1)[:, :self.k]
        self.scores[at] = np.take_along_axis(scores, order, 1)
        self.ids[at] = np.take_along_axis(names, order, 1)
        self.rows[at] = np.take_along_axis(places, order, 1)

    def frame(self, query_ids: np.ndarray) -> pd.DataFrame:
        q, j = np.nonzero(np.isfinite(self.scores))
        return pd.DataFrame({"query_row": self.query_rows[q], "query_id": query_ids[q],
                             "row_id": self.rows[q, j], "vec_id": self.ids[q, j],
                             "score": self.scores[q, j]})


FOUND = "query_row long, query_id long, row_id long, vec_id long, score double"


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query over all parts, with `rank` from 1."""
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def floors(found: DataFrame, k: int) -> DataFrame:
    """(query_row, floor): the kth score of queries that have k rows already."""
    return (found.groupBy("query_row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor"))
            .filter(F.col("n") >= k).select("query_row", "floor"))
