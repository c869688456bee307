"""Words of a list of any size found anywhere inside texts, also in the middle of other words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.operators.placing import stored

OTHER = r"[^\p{L}\p{N}]+"


def _runs(text: Column, size: int) -> Column:
    """All runs of `size` characters of a text, at every position; one pass, the text is not searched per position."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))


def _search(texts: DataFrame, wanted: DataFrame, gram: int, piece: int) -> DataFrame:
    """(k, word) for texts (k, low) and distinct words of a stored table, both in lower case.

    Each word is known by its rarest run of `gram` characters, by itself if it is shorter; rarity is counted over all
    texts. Texts are cut into pieces that overlap by the longest word, a piece gives its distinct runs, and those that
    are the run of a word propose it. Only proposed pairs meet the piece, where the word is searched exactly.
    """
    size = F.least(F.length("word"), F.lit(gram))
    # One row: the longest word and the at most `gram` lengths of runs.
    longest, sizes = wanted.agg(F.max(F.length("word")), F.sort_array(F.collect_set(size))).first()
    if not sizes:
        return texts.select("k", F.col("low").alias("word")).where("false")
    step = max(piece, longest)
    cuts = F.regexp_extract_all("low", F.lit(f"(?s)(?=(.{{1,{step + longest - 1}}})).{{1,{step}}}"), F.lit(1))
    pieces = texts.select("k", F.posexplode(cuts).alias("part", "piece"))
    runs = F.array_distinct(F.concat(*[_runs(F.col("piece"), n) for n in sizes]))
    given = pieces.select("k", "part", F.explode(runs).alias("run"))
    own = F.when(F.length("word") < gram, F.array("word")).otherwise(F.array_distinct(_runs(F.col("word"), gram)))
    known = wanted.select("word", F.explode(own).alias("run"))
    counts = (given.join(known.select(F.col("run").alias("known")).distinct(), F.col("run") == F.col("known"), "left_semi")
              .groupBy("run").agg(F.count(F.lit(1)).alias("n")))
    # A word with a run that no text has is nowhere.
    rarest = (known.join(counts, "run", "left").groupBy("word")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "run")).alias("best"))
              .where("best.n > 0").select("word", F.col("best.run").alias("run")))
    proposed = given.join(stored(rarest, "word-runs"), "run").select("k", "part", "word").distinct()
    met = proposed.join(pieces, ["k", "part"]).where(F.col("piece").contains(F.col("word")))
    return met.select("k", "word").distinct()


def words_inside(texts: DataFrame, words: DataFrame, key: str, text: str, word: str = "word",
                 gram: int = 4, piece: int = 1024, token: int = 64) -> DataFrame:
    """(key, word) for every word that some text of the key contains; case does not matter.

    A word of letters and digits lies within one run of them, so it is searched in the distinct runs of all texts, once
    for each, and found ones meet the texts again by a join. Runs longer than `token` characters, as in
    languages without spaces, and words with other characters are searched in the texts themselves, by rare runs of characters
    (`_search`). So the work follows the vocabulary, the texts and the matches, not texts times words; no list
    of words or matches is collected, and a very long text is many pieces. Words and texts are compared in lower case.
    Null and empty words, null texts and rows without a key find nothing; repeated words and rows count once.
    """
    wanted = stored(words.select(F.lower(F.col(word)).alias("word")).where(F.length("word") > 0)
                    .distinct().withColumn("spaced", F.col("word").rlike(OTHER)), "words")
    lower = texts.select(F.col(key).alias("k"), F.lower(F.col(text)).alias("low")).where("k IS NOT NULL AND low IS NOT NULL")
    # The outer form keeps Spark from splitting a second time to filter on empty lists.
    tokens = lower.select("k", F.explode_outer(F.array_distinct(F.split("low", OTHER))).alias("low"))
    short, long = F.length("low").between(1, token), F.length("low") > token
    single = wanted.where(~F.col("spaced"))
    vocabulary = stored(tokens.where(short).select(F.col("low").alias("k"), "low").distinct(), "vocabulary")
    inside = stored(_search(vocabulary, single, gram, piece), "tokens-found").withColumnRenamed("k", "low")
    found = tokens.where(short).join(inside, "low").select("k", "word").unionByName(
        _search(stored(tokens.where(long), "long-tokens"), single, gram, piece)).unionByName(
        _search(lower, wanted.where("spaced"), gram, piece))
    return found.distinct().withColumnRenamed("k", key)
