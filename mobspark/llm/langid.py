"""Language identification by words first, then ever shorter character n-grams (operator 3).

A word that the training sample has is scored by its log frequency in each language. Another word falls back to its
character 4-grams (with marks for begin and end), then 3-grams, and so on, down to the first length of which at least
half its n-grams are known; its score is the mean log frequency of those. A text's score is the sum over its words.

Null texts and texts without a letter are ``und`` with score 0, as are all texts if nothing could be learned. Equal
scores go to the language that sorts first.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mobspark.llm import common

#: Bounds of the model: labelled rows of each language that it is fitted on, words of each language and n-grams of each
#: language and length that it keeps (the most frequent ones).
ROWS_PER_LANGUAGE = 4000
WORDS_PER_LANGUAGE = 30_000
GRAMS_PER_LANGUAGE = 10_000
LONGEST_GRAM = 4
UNKNOWN = "und"
#: Words that count in full for the posterior; a longer text is no surer than so many words.
FULL_WORDS = 30
REMEMBERED_WORDS = 200_000
SMOOTHING = 0.5

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def grams_of(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Log frequencies by word and by n-gram, a row of one number per language each."""

    def __init__(self, languages: list[str], words: list[tuple], grams: list[tuple]):
        """words: (lang, word, n); grams: (lang, gram, n)."""
        self.languages = languages
        self.words = self._table(words)
        self.grams = [self._table([g for g in grams if len(g[1]) == n]) for n in range(1, LONGEST_GRAM + 1)]

    def _table(self, rows: list[tuple]) -> tuple[dict[str, int], np.ndarray]:
        at: dict[str, int] = {}
        for _, key, _ in rows:
            at.setdefault(key, len(at))
        counts = np.zeros((len(at), len(self.languages)))
        column = {x: i for i, x in enumerate(self.languages)}
        for lang, key, n in rows:
            counts[at[key], column[lang]] += n
        total = counts.sum(axis=0) + SMOOTHING * max(len(at), 1)
        return at, np.log((counts + SMOOTHING) / total)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """A row of scores for each word; NaN if it has no letter."""
        out = np.zeros((len(words), len(self.languages)))
        at, scores = self.words
        found = np.fromiter((at.get(w, -1) for w in words), np.int64, len(words))
        out[found >= 0] = scores[found[found >= 0]]
        open_ = [i for i in np.flatnonzero(found < 0).tolist() if any(map(str.isalpha, words[i]))]
        lettered = found >= 0
        lettered[open_] = True
        out[~lettered] = np.nan
        for n in range(LONGEST_GRAM, 0, -1):
            # n-grams of all open words in one array, unknown ones -1
            at, scores = self.grams[n - 1]
            own = [grams_of(words[i], n) for i in open_]
            sizes = np.fromiter(map(len, own), np.int64, len(own))
            owner = np.repeat(np.arange(len(own)), sizes)
            index = np.fromiter((at.get(g, -1) for grams in own for g in grams), np.int64, int(sizes.sum()))
            known = index >= 0
            hits = np.bincount(owner[known], minlength=len(own))
            enough = (hits > 0) & (2 * hits >= sizes)
            for c in range(len(self.languages)):
                sums = np.bincount(owner[known], scores[index[known], c], len(own))
                out[np.array(open_, np.int64)[enough], c] = sums[enough] / hits[enough]
            open_ = [i for i, done in zip(open_, enough.tolist(), strict=True) if not done]
        return out


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.at: dict[str, int] = {}
        self.matrix = np.zeros((1024, len(self.model.languages)))

    def _learn(self, counts: list[Counter]) -> None:
        if len(self.at) > REMEMBERED_WORDS:
            self._forget()
        new = list(set().union(*counts).difference(self.at))
        size = len(self.at) + len(new)
        while len(self.matrix) < size:
            self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
        self.matrix[len(self.at):size] = self.model.word_scores(new)
        self.at.update(zip(new, range(len(self.at), size), strict=True))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if not self.model.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        out = []
        for a in range(0, len(texts), 256):
            counts = [Counter(words_of(t)) for t in texts[a:a + 256]]
            self._learn(counts)
            out += map(self._one, counts)
        return out

    def _one(self, counts: Counter) -> tuple[str, float]:
        index = np.fromiter(map(self.at.__getitem__, counts), np.int64, len(counts))
        weight = np.fromiter(counts.values(), np.float64, len(counts))
        rows = self.matrix[index]
        lettered = ~np.isnan(rows[:, 0])
        if not lettered.any():
            return UNKNOWN, 0.0
        weight = weight[lettered]
        mean = weight @ rows[lettered] / weight.sum()
        best = int(np.argmax(mean))
        odds = np.exp((mean - mean[best]) * min(weight.sum(), FULL_WORDS))
        return self.model.languages[best], float(1 / odds.sum())


def train(
    labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows_per_language: int = ROWS_PER_LANGUAGE,
    words_per_language: int = WORDS_PER_LANGUAGE, grams_per_language: int = GRAMS_PER_LANGUAGE,
) -> Model:
    """Fit on a bounded sample of ``labelled``; word and n-gram counts are made by Spark, the kept ones are collected."""
    common.ship_package(labelled.sparkSession)
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sample = common.bounded_sample(rows, lang, rows_per_language, key)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for l, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts.update((l, w) for w in words_of(t) if any(map(str.isalpha, w)))
            yield rows_of(counts)

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for l, w, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for size in range(1, LONGEST_GRAM + 1):
                    for g in grams_of(w, size):
                        counts[l, g] += n
            yield rows_of(counts)

    def rows_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64()),
        ], names=["lang", "item", "n"])

    kind = "lang string, item string, n long"
    words = sample.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(count_words, kind)
    words = common.written(words.groupBy("lang", "item").agg(F.sum("n").alias("n")), "langid-words")
    grams = words.mapInArrow(count_grams, kind).groupBy("lang", "item").agg(F.sum("n").alias("n"))

    def most_frequent(df: DataFrame, most: int, *by) -> list[tuple]:
        rank = F.row_number().over(Window.partitionBy("lang", *by).orderBy(F.desc("n"), "item"))
        return [tuple(r) for r in df.withColumn("r", rank).where(F.col("r") <= most).drop("r").orderBy("lang", "item").collect()]

    languages = sorted(r[0] for r in words.select("lang").distinct().collect())
    model = Model(languages, most_frequent(words, words_per_language), most_frequent(grams, grams_per_language, F.length("item")))
    common.drop_written(words)
    return model


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with lang_pred and score (existing columns of these names are replaced)."""
    spark = df.sparkSession
    common.ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # its size is bounded by the limits given to train()
    source = df.drop("lang_pred", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = scorer.predict(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)
    return source.mapInArrow(run, f"{kind}, lang_pred string, score double")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from those that are not held out."""
    documents = common.table(spark, sf_dir, "documents")
    model = train(documents.where(~common.held_out()))
    out = predict(documents.select("doc_id", "text", common.held_out().alias("held_out")), model)
    return out.select("doc_id", "held_out", "lang_pred", "score")
