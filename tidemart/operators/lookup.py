"""Dictionary lookups and set membership."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def decode(df: DataFrame, code: str, dictionary: DataFrame, parent: str, name: str) -> DataFrame:
    """Add the dictionary name of a code; codes of other parents and unknown ones give null.

    No broadcast is forced: the dictionary arrives as a table, and Spark decides by its size.
    """
    names = (dictionary.where(F.col("parent_code") == parent)
             .select(F.col("dic_code").alias("__code"), F.col("dic_name").alias(name)))
    return df.join(names, F.col(code) == F.col("__code"), "left").drop("__code")


def member_flags(words: DataFrame, column: str, members: DataFrame, member: str,
                 flag: str = "is_member") -> DataFrame:
    """Every word with a flag telling whether it is in the set; null and empty text are not."""
    known = members.select(F.col(member).alias("__word")).where(F.length("__word") > 0).distinct()
    return (words.join(known, F.col(column) == F.col("__word"), "left")
            .withColumn(flag, F.col("__word").isNotNull()).drop("__word"))


def only_members(words: DataFrame, column: str, members: DataFrame, member: str) -> DataFrame:
    """The rows whose word is in the set."""
    known = members.select(F.col(member).alias("__word")).where(F.length("__word") > 0)
    return words.join(known, F.col(column) == F.col("__word"), "left_semi")
