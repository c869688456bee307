"""Token counts: an exact histogram of encoded lengths answers every context limit."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemart.llm.common import documents
from tidemart.llm.tokens import Encoder, vocabulary_path


def encoded_length(vocabulary: str):
    """Scalar function text -> tokens (0 for null or empty), one encoder per Python worker."""

    def lengths(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(vocabulary)
        for batch in texts:
            yield pd.Series([len(encoder.encode(t)) // 4 for t in batch], dtype="int64")

    lengths.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(lengths, "long")


def length_histogram(docs: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(n_tokens, n_docs): how many documents have each encoded length.

    Null and empty texts have length 0, repeated rows count each, whole texts are encoded; other columns
    do not matter.
    """
    path = vocabulary or vocabulary_path()
    return (docs.select(encoded_length(path)(F.col(text)).alias("n_tokens"))
            .groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")))


def context_totals(histogram: DataFrame) -> DataFrame:
    """Totals for each limit that is a length of the corpus; limits between behave as stated below.

    Per length L: documents and tokens of that length, documents of at most L (`docs_within`) and
    their tokens (`tokens_within`), longer documents (`docs_beyond`), the tokens that remain when every
    document is cut at L (`tokens_truncated`), and `quantile`, the share of documents of at most L: the
    q-quantile is the least L with quantile >= q. For a limit c between two lengths take the row of
    the next smaller length: tokens_within + c * docs_beyond. The window runs over the histogram, whose rows
    are bounded by the longest text. An empty corpus gives no row.
    """
    up = Window.orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    beyond = Window.orderBy("n_tokens").rowsBetween(1, Window.unboundedFollowing)
    everything = Window.orderBy("n_tokens").rowsBetween(Window.unboundedPreceding,
                                                        Window.unboundedFollowing)
    tokens = F.col("n_docs") * F.col("n_tokens")
    rows = histogram.select(
        "n_tokens", "n_docs", tokens.alias("tokens"),
        F.sum("n_docs").over(up).alias("docs_within"),
        F.sum(tokens).over(up).alias("tokens_within"),
        F.coalesce(F.sum("n_docs").over(beyond), F.lit(0)).alias("docs_beyond"),
        F.sum("n_docs").over(everything).alias("docs_total"))
    return rows.select(
        "n_tokens", "n_docs", "tokens", "docs_within", "tokens_within", "docs_beyond",
        (F.col("tokens_within") + F.col("docs_beyond") * F.col("n_tokens")).alias("tokens_truncated"),
        (F.col("docs_within") / F.col("docs_total")).alias("quantile"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return context_totals(length_histogram(documents(spark, folder, "text")))
