"""Comment moderation: grading, blacklist, totals."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.money import ratio, sum_if
from tidemart.operators.substrings import words_inside

GRADES = ("P0", "P1", "P2")
# Days on the blacklist per grade; P2 is only flagged.
BLACKLIST_DAYS = {"P0": 365, "P1": 60}

# Sample words, strongest grade first. A shop brings its own.
SAMPLE_WORDS = (
    ("scum", "P0"), ("moron", "P0"),
    ("trash", "P1"), ("idiot", "P1"), ("stupid", "P1"), ("loser", "P1"),
    ("worthless", "P2"), ("pathetic", "P2"), ("disgusting", "P2"), ("clown", "P2"),
)


def grade_by_text(comments: DataFrame, words, text: str = "review_text") -> DataFrame:
    """Add `grade`, the strongest grade with a word anywhere in the whole text, else null.

    `words` is a list of (word, grade); case does not matter, empty words are ignored. Evaluated
    row by row without a join or shuffle, on tables and on streams, one search per word, which is
    several times faster than a pattern of alternatives. Dictionaries kept as tables go through
    `grade_by_lookup`.
    """
    lower = comments.withColumn("__lower", F.lower(F.col(text)))
    grade = F.when(F.lit(False), F.lit(None).cast("string"))
    for level in GRADES:
        chosen = sorted({w.lower() for w, g in words if g == level and w})
        if chosen:
            grade = grade.when(reduce(or_, [F.col("__lower").contains(w) for w in chosen]), level)
    return lower.withColumn("grade", grade).drop("__lower")


def tokens(comments: DataFrame, text: str = "review_text") -> DataFrame:
    """The distinct words of each comment, one per row, in lower case, whole text.

    The outer form of `explode` keeps Spark from evaluating the split a second time as a filter
    on empty lists; the rows it adds go with the empty words.
    """
    words = F.array_distinct(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"))
    keep = [c for c in comments.columns if c != text]
    return (comments.select(*keep, F.explode_outer(words).alias("word"))
            .where(F.length("word") > 0))


def strongest() -> Column:
    """The strongest grade of a group, compared by number: texts would have to be sorted."""
    return F.concat(F.lit("P"), F.min(F.substring("grade", 2, 1).cast("int")).cast("string"))


def grade_by_lookup(comments: DataFrame, dictionary: DataFrame, key: str = "comment_id",
                    text: str = "review_text") -> DataFrame:
    """Strongest grade per comment for dictionaries of any size, matching whole words.

    `dictionary(word, grade)`. Comments without a match are not in the result.
    """
    known = dictionary.select(F.lower("word").alias("word"), "grade")
    return (tokens(comments, text).select(key, "word").join(known, "word")
            .groupBy(key).agg(strongest().alias("grade")))


def grade_inside(comments: DataFrame, dictionary: DataFrame, key: str = "comment_id",
                 text: str = "review_text") -> DataFrame:
    """Strongest grade per comment for dictionaries of any size, matching anywhere in the text.

    `dictionary(word, grade)`; a word with several grades has its strongest. Comments without a match are not in the result.
    """
    known = dictionary.select(F.lower("word").alias("word"), "grade").groupBy("word").agg(strongest().alias("grade"))
    return (words_inside(comments, known, key, text).join(known, "word")
            .groupBy(key).agg(strongest().alias("grade")))


def blacklist(graded: DataFrame, day: str) -> DataFrame:
    """Users with the day their ban ends, and whether it is in force on `day`.

    `graded` has user_id, ds (day of the comment) and grade. The longest ban counts; it is over
    on its last day.
    """
    length = F.when(F.col("grade") == "P0", BLACKLIST_DAYS["P0"]).when(
        F.col("grade") == "P1", BLACKLIST_DAYS["P1"])
    until = F.date_add(F.to_date("ds"), length)
    return (graded.where(length.isNotNull()).groupBy("user_id").agg(
        F.max(until).cast("string").alias("expires"), strongest().alias("worst_grade"),
        F.count("*").cast("bigint").alias("offences"))
        .withColumn("is_active", F.col("expires") > day))


def totals(graded: DataFrame) -> DataFrame:
    """Comments, sensitive comments, counts per grade and the sensitive share in percent."""
    sums = graded.agg(
        F.count("*").cast("bigint").alias("comment_count"),
        F.count("grade").cast("bigint").alias("sensitive_count"),
        *[F.coalesce(sum_if(F.col("grade") == g, F.lit(1)), F.lit(0)).cast("bigint")
          .alias(f"{g.lower()}_count") for g in GRADES])
    return sums.withColumn(
        "sensitive_rate", ratio(F.col("sensitive_count") * 100, F.col("comment_count")))
