"""A corpus pipeline over the documents table: each stage takes what its predecessor kept.

A stage is a function (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet and read again as
the next one's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm.common import stored
from tidemart.llm.language import reject_unknown
from tidemart.llm.mixing import mix
from tidemart.llm.ngram_join import one_of_each
from tidemart.llm.packing import pack_documents
from tidemart.llm.pii import redact


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or text, and those in letters the language model does not know, go."""
    return reject_unknown(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind."""
    return redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated until sources have their target weights."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids and their places in sequences."""
    return pack_documents(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mixture", mixture), ("packing", packing)]

# Language scores, set similarity by hashes and token ids have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
