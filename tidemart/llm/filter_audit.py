"""Filter interaction audit: what each of five filters removes in every order of them."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import documents, stored

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
WORD = r"[^\x20\x09-\x0D]+"
LEAST_WORDS, LEAST_DISTINCT_PCT, MOST_UPPER_PCT = 200, 50, 3
SYMBOLS = r"[#$%&*|]"
LABELS = ("all", "good", "toxic")
# Bit s of the word of a document that fails the filters m: whether it survives the subset s of filters.
SURVIVAL = np.array([sum(1 << s for s in range(SUBSETS) if not s & m) for m in range(SUBSETS)], np.uint32)

_COUNTS = pa.schema([("part", pa.string()), ("label", pa.int32()), ("subset", pa.int32()), ("n", pa.int64())])
_COUNT_COLUMNS = "part string, label int, subset int, n long"
_REPORT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
           "unique_fails long, good_lost long, toxic_lost long, shapley long")


def own_failures(words: Column, text: Column) -> Column:
    """Bits of the filters A to D that a text fails; each is a fact of the text alone."""
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    tests = (n < LEAST_WORDS,
             F.lit(100) * distinct < F.lit(LEAST_DISTINCT_PCT) * n,
             F.lit(100) * F.regexp_count(text, F.lit("[A-Z]")) > F.lit(MOST_UPPER_PCT) * F.length(text),
             text.rlike(SYMBOLS))
    bits = [F.when(test, 1 << i).otherwise(0) for i, test in enumerate(tests)]
    return sum(bits[1:], bits[0])


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, bits) of every row: the filters it fails.

    A null text is empty, a null lang the part ''. E is failed by a row whose text a row with a smaller doc_id
    has too; a null doc_id is neither smaller nor larger than another, rows that repeat a doc_id are no
    duplicates of each other. Texts are compared by their MD5; the least id of a text is an aggregate that
    combines before the shuffle, and it meets the stored rows in a join that can split a text of many copies.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
                       text.alias("text"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    rows = stored(rows.select("doc_id", "part", F.unhex(F.md5("text")).alias("key"),
                              own_failures(F.col("words"), F.col("text")).alias("own")), "failures")
    first = rows.groupBy("key").agg(F.min("doc_id").alias("least"))
    copy = F.when(F.col("doc_id") > F.col("least"), 1 << FILTERS.index("E")).otherwise(0)
    return rows.join(first, "key").select("doc_id", "part", (F.col("own") + copy).alias("bits"))


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the words have each of the 32 bits, by carry-save adders.

    Three words of one weight become a sum word of that weight and a carry word of twice the weight,
    all lanes at once, until at most two words per weight are left, whose bits are counted.
    """
    total = np.zeros(SUBSETS, np.int64)
    waiting, weight = [words.astype(np.uint32)], 0
    while waiting:
        now, carries = np.concatenate(waiting), []
        while len(now) >= 3:
            third = len(now) // 3
            a, b, c = now[:third], now[third:2 * third], now[2 * third:3 * third]
            half = a ^ b
            carries.append((a & b) | (half & c))
            now = np.concatenate([half ^ c, now[3 * third:]])
        for word in now:
            total += ((int(word) >> np.arange(SUBSETS)) & 1) << weight
        waiting, weight = carries, weight + 1
    return total


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subset survivors per part and label of each batch."""
    for batch in batches:
        parts = batch.column("part").dictionary_encode()
        codes = parts.indices.to_numpy()
        words = SURVIVAL[batch.column("bits").to_numpy()]
        flags = [np.ones(len(words), bool), *(batch.column(c).to_numpy(zero_copy_only=False) for c in LABELS[1:])]
        names, kinds, counts = [], [], []
        for code, part in enumerate(parts.dictionary.to_pylist()):
            for kind, flag in enumerate(flags):
                names.append(part)
                kinds.append(kind)
                counts.append(positional_popcount(words[(codes == code) & flag]))
        size = len(names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(names, object), SUBSETS), pa.string()),
             pa.array(np.repeat(np.array(kinds, np.int32), SUBSETS), pa.int32()),
             pa.array(np.tile(np.arange(SUBSETS, dtype=np.int32), size), pa.int32()),
             pa.array(np.concatenate([np.empty(0, np.int64), *counts]), pa.int64())], schema=_COUNTS)


def survivors(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, label, subset, n): documents of the part and label that survive a subset of the filters.

    Label 0 is every document, 1 those with a row quality = 1 in `labels`, 2 those with toxic = 1; repeated labels
    count once, documents without one only for label 0. Each task sends 96 counts per batch and part.
    """
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = failures(docs).join(marked, "doc_id", "left").select(
        "part", "bits", *[F.coalesce(c, F.lit(False)).alias(c) for c in LABELS[1:]])
    return rows.mapInArrow(_count, _COUNT_COLUMNS).groupBy("part", "label", "subset").agg(F.sum("n").alias("n"))


def _report(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    full = SUBSETS - 1
    for frame in frames:
        rows = []
        for part, cells in zip(frame["part"], frame["cells"], strict=True):
            counts = np.zeros((len(LABELS), SUBSETS), np.int64)
            for cell in cells:
                counts[cell["label"], cell["subset"]] = cell["n"]
            every, good, toxic = counts
            steps, share = [], dict.fromkeys(FILTERS, 0)
            for order in permutations(FILTERS):
                before = 0
                for step, name in enumerate(order, 1):
                    bit = 1 << FILTERS.index(name)
                    after = before | bit
                    removed = every[before] - every[after]
                    share[name] += removed
                    steps.append((part, "".join(order), step, every[after], removed,
                                  every[0] - every[bit] - removed, every[full ^ bit] - every[full],
                                  good[before] - good[after], toxic[before] - toxic[after]))
                    before = after
            rows += [(*s, share[s[1][s[2] - 1]]) for s in steps]
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in _REPORT.split(", ")])


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the subset survivors of the part alone.

    Documents (doc_id, text, lang) fail A below 200 words, B with fewer than half of the words different,
    C with more than 3 % of the code points in A-Z, D with one of #$%&*|, E as a copy of a smaller doc_id's
    text. A filter removes at its step what survives the filters before it and not also itself. Without
    documents there is no part and no row; columns other than those named do not matter.
    """
    cells = survivors(docs, labels).groupBy("part").agg(
        F.collect_list(F.struct("label", "subset", "n")).alias("cells"))
    return cells.mapInPandas(_report, _REPORT)


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit(documents(spark, folder, "doc_id", "text", "lang"),
                        documents(spark, folder, table="labels"))


OP13_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic
      FROM labels GROUP BY doc_id),
f AS (SELECT t.doc_id, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
        + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT
        + 8 * regexp_matches(text, '[#$%&*|]')::INT
        + 16 * coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)::INT AS bits
      FROM t LEFT JOIN l ON t.doc_id = l.doc_id),
m AS (SELECT part, bits, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM f GROUP BY part, bits),
o AS (SELECT '' AS filter_order
      UNION ALL SELECT filter_order || c FROM o, (SELECT unnest(['A','B','C','D','E']) AS c) WHERE NOT contains(filter_order, c)),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS f,
        list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(substr(filter_order, i, 1)) - 65))) AS before
      FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM o WHERE length(filter_order) = 5)),
b AS (SELECT filter_order, step, f, coalesce(before, 0)::INT AS before, (1 << (ascii(f) - 65))::INT AS bit FROM s),
r AS (SELECT part, filter_order, step, f,
        sum(n) FILTER (bits & (before | bit) = 0) AS kept,
        sum(n) FILTER (bits & before = 0 AND bits & bit <> 0) AS removed,
        sum(n) FILTER (bits & before <> 0 AND bits & bit <> 0) AS redundant,
        sum(n) FILTER (bits = bit) AS unique_fails,
        sum(good) FILTER (bits & before = 0 AND bits & bit <> 0) AS good_lost,
        sum(toxic) FILTER (bits & before = 0 AND bits & bit <> 0) AS toxic_lost
      FROM m, b GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept,
  coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
  coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley FROM r
"""
