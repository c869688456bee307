"""Language identification: known words first, shorter and shorter character n-grams for others."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemart.llm.common import documents, fresh

# Bounds of what is fitted: labelled rows and words, both per language. The model goes to the tasks,
# so its size is bounded by languages x MODEL_WORDS words and their n-grams.
TRAINING_ROWS, MODEL_WORDS = 2_000, 20_000
LONGEST_GRAM = 4
UNDETERMINED = "und"
_RUN = re.compile(r"[^\W\d_]+")
_BUCKETS = 4096
_KEPT_WORDS = 300_000


def letters(text: str) -> list[str]:
    """Runs of letters in lower case. Python's \\w also holds numerals such as a half or a Roman eight, which are none."""
    words = _RUN.findall(text.lower())
    return words if all(map(str.isalpha, words)) else [
        "".join(same) for w in words for alpha, same in groupby(w, str.isalpha) if alpha]


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 1 when divided by 3; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def training_rows(docs: DataFrame, per_language: int = TRAINING_ROWS) -> DataFrame:
    """(lang, text) of at most `per_language` labelled documents of each language, the same on every run.

    A histogram of hash buckets, which reads no text, gives the last bucket of each language that still fits;
    these bounds, one per language, go into the filter, so only the sample is shuffled, and the last
    bucket is cut by rank. Held-out documents, null texts and null languages are left out.
    """
    usable = (docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
              .withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(_BUCKETS))))
    upward = Window.partitionBy("lang").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bounds = (usable.groupBy("lang", "bucket").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(upward), F.lit(0)))
              .filter(F.col("before") < per_language)
              .groupBy("lang").agg(F.max(F.struct("bucket", "before")).alias("last")).collect())
    last = {r["lang"]: r["last"] for r in bounds}
    chosen, room = F.lit(False), F.lit(0)
    for lang, (bucket, before) in sorted(last.items()):
        own = F.col("lang") == lang
        chosen = chosen | (own & (F.col("bucket") <= bucket))
        room = F.when(own & (F.col("bucket") == bucket), per_language - before).otherwise(room)
    room = F.when(room > 0, room).otherwise(per_language)
    order = Window.partitionBy("lang", "bucket").orderBy(F.xxhash64("doc_id", "text"), "doc_id")
    return (usable.filter(chosen & F.col("text").isNotNull()).select("lang", "doc_id", "text", "bucket")
            .withColumn("place", F.row_number().over(order))
            .filter(F.col("place") <= room).select("lang", "text"))


def word_counts(rows: DataFrame, words: int = MODEL_WORDS) -> list[tuple[str, str, int]]:
    """The most frequent `words` words of each language with their counts, ties by word."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = Counter()
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                for word, n in Counter(letters(text)).items():
                    found[lang, word] += n
            yield pd.DataFrame([(*k, n) for k, n in found.items()], columns=["lang", "word", "n"])

    counts = (rows.mapInPandas(count, "lang string, word string, n long")
              .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "word")
    top = counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= words)
    return [(r["lang"], r["word"], r["n"]) for r in top.select("lang", "word", "n").collect()]


class WordBackoff:
    """Log scores of words and n-grams per language.

    A word of the model scores its smoothed relative frequency in each language. Another word takes
    its longest n-grams (with a mark at both ends) that the model knows and scores their mean; only if
    none of a length is known, the next shorter length is asked. A word of unknown letters says nothing.
    """

    def __init__(self, counts: list[tuple[str, str, int]], longest: int = LONGEST_GRAM):
        self.langs = sorted({lang for lang, _, _ in counts})
        self.longest = longest
        place = {lang: i for i, lang in enumerate(self.langs)}
        words: dict[str, list[int]] = defaultdict(lambda: [0] * len(self.langs))
        grams: dict[str, list[int]] = defaultdict(lambda: [0] * len(self.langs))
        for lang, word, n in sorted(counts):
            words[word][place[lang]] += n
            for gram in self._grams(word):
                grams[gram][place[lang]] += n
        self.words = self._logs(words)
        self.grams: dict[str, tuple[float, ...]] = {}
        for length in range(1, longest + 1):
            self.grams.update(self._logs({g: c for g, c in grams.items() if len(g) == length}))

    def _grams(self, word: str) -> list[str]:
        marked = f"<{word}>"
        return [*word, *(marked[i:i + n] for n in range(2, self.longest + 1)
                         for i in range(len(marked) - n + 1))]

    def _logs(self, counts: dict[str, list[int]]) -> dict[str, tuple[float, ...]]:
        if not counts:
            return {}
        table = np.array(list(counts.values()), dtype=float)
        logs = np.log((table + 0.5) / (table.sum(axis=0) + 0.5 * len(table)))
        centred = logs - logs.mean(axis=1, keepdims=True)
        return dict(zip(counts, map(tuple, centred.tolist()), strict=True))

    def word(self, word: str) -> tuple[float, ...]:
        known = self.words.get(word)
        if known is not None:
            return known
        marked, grams = f"<{word}>", self.grams
        for length in range(self.longest, 1, -1):
            found = [grams[g] for i in range(len(marked) - length + 1)
                     if (g := marked[i:i + length]) in grams]
            if found:
                return tuple([sum(x) / len(found) for x in zip(*found, strict=True)])
        found = [grams[g] for g in word if g in grams]
        if found:
            return tuple([sum(x) / len(found) for x in zip(*found, strict=True)])
        return (0.0,) * len(self.langs)


class Scorer:
    """Predictions for whole texts; word scores are kept in a bounded table."""

    def __init__(self, model: WordBackoff):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self._rows: dict[str, int] = {}
        self._table = np.zeros((1024, len(self.model.langs)))

    def _learn(self, words: list[str]) -> None:
        start = len(self._rows)
        while len(self._table) < start + len(words):
            self._table = np.concatenate([self._table, np.zeros_like(self._table)])
        self._table[start:start + len(words)] = [self.model.word(w) for w in words]
        self._rows.update(zip(words, range(start, start + len(words)), strict=True))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, its share of the posterior); `und` and 0 without letters or without a model."""
        return self.judge(text)[:2]

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """As `predict`, and whether the model knows any word or n-gram of the text: then it knows a letter."""
        langs = self.model.langs
        counts = Counter(letters(text)) if text and langs else None
        if not counts:
            return UNDETERMINED, 0.0, False
        if len(self._rows) + len(counts) > _KEPT_WORDS:
            self._forget()
        rows = self._rows
        new = [w for w in counts if w not in rows]
        if new:
            self._learn(new)
        places = np.fromiter(map(rows.__getitem__, counts), np.int64, len(counts))
        weights = np.fromiter(counts.values(), float, len(counts))
        sums = weights @ self._table[places]
        best = int(sums.argmax())  # ties go to the first language by name
        known = any(letter in self.model.grams for word in counts for letter in word)
        return langs[best], float(1.0 / np.exp(np.maximum(sums - sums[best], -700.0)).sum()), known


def fit(docs: DataFrame, per_language: int = TRAINING_ROWS, words: int = MODEL_WORDS) -> WordBackoff:
    return WordBackoff(word_counts(training_rows(docs, per_language), words))


def identify(docs: DataFrame, model: WordBackoff, text: str = "text") -> Column:
    """Struct (lang_pred, score, known) of a text column, scored in the tasks with the sent model.

    Only the text counts, all of it. Null texts and texts without a letter are `und` with score 0, as is
    everything when no labelled document was there to learn from; a tie goes to the first language by name.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(sent.value)
        for batch in texts:
            yield pd.DataFrame([scorer.judge(t) for t in batch], columns=["lang_pred", "score", "known"])

    run.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "lang_pred string, score double, known boolean")(F.col(text))


def reject_unknown(docs: DataFrame) -> DataFrame:
    """Documents with a language; null texts, those without a letter and those of which the model knows no word and
    no n-gram, so that all languages are as likely, go. Columns stay as they are."""
    name = fresh(docs, "__language")
    return (docs.withColumn(name, identify(docs, fit(docs)))
            .filter(F.col(name)["known"]).drop(name))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "text", "lang")
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       identify(docs, fit(docs)).alias("found"))
    return rows.select("doc_id", "held_out", "found.lang_pred", "found.score")
