"""Benchmark decontamination: which words of a document lie in passages of the benchmark's items.

Everything is DataFrame functions.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemart.llm.common import documents, stored

# What stands between words, in a text as it is written (A-Z belong to words and become lower case later). Texts are
# split at it: finding the words themselves takes Spark six times as long.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW, SHINGLE = 10, 3  # words of a window of an item, and of the shingles that windows are sets of


def lowered(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def words_of(text: Column) -> Column:
    """Words as they are written; null for a null text."""
    return F.array_remove(F.split(text, BETWEEN), "")


def _shingle(words: str, at: Column, size: int) -> Column:
    """Words joined by a blank, which no word holds; null beyond the end."""
    parts = [F.get(F.col(words), at + j) for j in range(size)]
    return F.concat(*[x for p in parts for x in (F.lit(" "), p)][1:])


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(words, items): the different windows of all items and the item_ids, as text, that have them."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             words_of(lowered(F.col("text"))).alias("all")).filter(F.size("all") > 0)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.size("all") - window + 1, F.lit(1))),
                      lambda i: F.slice("all", i, F.lit(window)))
    return items.select("item", F.explode(cut).alias("words")).groupBy("words").agg(
        F.collect_set("item").alias("items"))


def _matches(docs: DataFrame, vocabulary: DataFrame, sizes: list[int]) -> DataFrame:
    """(key, n_words, pos, size, shingle) wherever a different text has a shingle of the benchmark.

    Words are cut as they are written. Shingles meet in lower case of all letters, which Spark makes quickly, and
    those that meet are compared again with only A-Z in lower case.
    """
    texts = docs.select(F.unhex(F.md5("text")).alias("key"),
                        words_of(F.col("text")).alias("words"))
    n = F.size("words")
    places = texts.filter(n > 0).select("key", "words", F.explode(F.sequence(
        F.lit(0), n * len(sizes) - 1)).alias("i"))
    size = F.get(F.array(*[F.lit(s) for s in sizes]), F.col("i") % len(sizes))
    pos = F.floor(F.col("i") / len(sizes)).cast("int") if len(sizes) > 1 else F.col("i")
    places = places.select("key", "words", pos.alias("pos"), size.alias("own"))
    raw = F.coalesce(*[F.when(F.col("own") == s, _shingle("words", F.col("pos"), s)) for s in sizes])
    found = places.select("key", n.alias("n_words"), "pos", raw.alias("raw")).withColumn("folded", F.lower("raw"))
    return found.join(vocabulary, "folded").filter(lowered(F.col("raw")) == F.col("text")).select(
        "key", "n_words", "pos", "size", "shingle").distinct()


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """(occurrences, windows): (key, start, stop, window) for each place where a window occurs in a different text,
    key its MD5; (window, items).

    A prefix-filtered set join for full containment. A window is a set of shingles; ordered by rarity, the
    prefix that any text containing all of them must meet is the rarest one. So a window meets the
    texts at the places of that shingle alone, the bounds (it must begin and end within the text) follow from
    the shingle's offset, and the shingles around the place must be the window's, in order. Shingles are
    compared as text, so a match is exact. Copies of a text are matched once; how often a shingle
    occurs is counted over all different texts. What is stored of the texts are the places of benchmark
    shingles; the benchmark's shingles are sent to all tasks only below `autoBroadcastJoinThreshold`.
    """
    windows = stored(item_windows(benchmark, window), "windows").withColumn(
        "window", F.monotonically_increasing_id())
    windows = stored(windows.withColumn("size", F.least(F.size("words"), F.lit(shingle))), "windows")
    cut = F.transform(F.sequence(F.lit(0), F.size("words") - F.col("size")), lambda i: F.concat_ws(
        " ", F.slice("words", i + 1, F.col("size"))))
    parts = stored(windows.select("window", "size", F.size("words").alias("length"), F.posexplode(cut).alias(
        "offset", "text")), "parts")
    vocabulary = stored(parts.select("text", "size").distinct().withColumns(
        {"folded": F.lower("text"), "shingle": F.monotonically_increasing_id()}), "vocabulary")
    sizes = sorted(r["size"] for r in vocabulary.select("size").distinct().collect())  # shingle at most
    empty = docs.sparkSession.createDataFrame([], "key binary, n_words int, pos int, size int, shingle long")
    matches = stored(_matches(docs, vocabulary, sizes), "matches") if sizes else empty

    rarity = matches.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    prefix = (parts.join(vocabulary.drop("folded"), ["text", "size"]).join(rarity, "shingle", "left")
              .groupBy("window", "length").agg(
                  F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "shingle")).alias("rarest"),
                  F.sort_array(F.collect_list(F.struct("offset", "shingle"))).alias("all"))
              .filter("rarest.n > 0")
              .select("window", "length", F.col("rarest.offset").alias("offset"),
                      F.col("rarest.shingle").alias("shingle"), F.col("all.shingle").alias("wanted")))
    near = Window.partitionBy("key", "size").orderBy("pos").rangeBetween(1 - window, window - 1)
    around = matches.withColumn("around", F.collect_list(F.struct("pos", "shingle")).over(near))
    start = F.col("pos") - F.col("offset")
    placed = around.join(stored(prefix, "prefix"), "shingle").withColumn("start", start).filter(
        (F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
    last = F.col("start") + F.size("wanted") - 1
    same = F.transform(F.filter("around", lambda s: s["pos"].between(F.col("start"), last)), lambda s: s["shingle"])
    found = placed.filter(same == F.col("wanted")).select(
        "key", "start", (F.col("start") + F.col("length")).alias("stop"), "window")
    return stored(found, "occurrences"), windows.select("window", "items")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of `docs` (doc_id, text).

    Words are runs outside ASCII other than digits and letters, A-Z in lower case. A window is ten consecutive
    words of an item, or all words of a shorter one; a document word within an occurrence of a window is hit. A null text
    or one without words has no hit, an item without words no window; repeated documents have a row each,
    repeated item rows are one item, items without an id are one with an empty name. Empty tables give no row or no hit.
    """
    found, windows = occurrences(docs, benchmark)
    before = F.max("stop").over(Window.partitionBy("key").orderBy("start", "stop", "window").rowsBetween(
        Window.unboundedPreceding, -1))
    hit = found.withColumn("before", F.coalesce(before, F.lit(0))).groupBy("key").agg(F.sum(F.greatest(
        F.col("stop") - F.greatest("start", "before"), F.lit(0))).cast("long").alias("n_hit"))
    items = (found.select("key", "window").distinct().join(windows, "window")
             .select("key", F.explode("items").alias("item")).distinct()
             .groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("items")))
    of_text = stored(hit.join(items, "key").select(
        "key", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256")), "contamination")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5("text")).alias("key"),
                       F.coalesce(F.array_size(words_of(F.col("text"))), F.lit(0)).cast("long").alias("n_words"))
    return rows.join(of_text, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(documents(spark, folder, "doc_id", "text"),
                         documents(spark, folder, "item_id", "text", table="benchmark"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
v AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, len(g) AS n, array_to_string(g, ' ') AS g FROM (
  SELECT item_id, unnest(CASE WHEN len(w) < 10 THEN [w]
    ELSE list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) END) AS g FROM b WHERE len(w) > 0)),
p AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM v) WHERE len(w) >= n),
h AS (SELECT DISTINCT r, i, p.n, item FROM p JOIN v ON v.n = p.n AND v.g = array_to_string(p.w[p.i:p.i + p.n - 1], ' ')),
c AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM h) GROUP BY r),
s AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
      FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c ON c.r = d.r LEFT JOIN s ON s.r = d.r
"""
