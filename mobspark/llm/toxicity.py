"""Toxicity by multiple-instance learning (operator 8).

A document is a bag of sentences. A sentence has probability p_s, a logistic function of the words it has; the document's
is the noisy-or 1 - prod(1 - p_s). Only document labels are known: the weights maximise the likelihood of those, and
the sentences that offend come out as the ones with a high p_s.

Null and empty texts have no sentence and get score 0, as do all texts when there is no label to learn from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import exp, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mobspark.llm import common
from mobspark.llm.word_features import REMEMBERED_WORDS, WORD, WordHasher, choose, presence

#: Bounds of the model: labelled rows of each class that it is fitted on, and features that it keeps.
ROWS_PER_CLASS = 4000
FEATURES = 150
THRESHOLD = 0.3
#: A sentence ends at a mark or a line's end, and after so many words at the latest.
SENTENCE_WORDS = 40
SENTENCE = re.compile(r"[^.!?\n]+")
STEPS = 400
STEP = 0.2
DECAY = 1e-5
FIRST_BIAS = -4.0


def lowered(text: str | None) -> str:
    """Lower case, character by character where that would change the length, so that places stay true."""
    low = (text or "").lower()
    if len(low) == len(text or ""):
        return low
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text or "")


def windows(words: list) -> list[list]:
    return [words] if len(words) <= SENTENCE_WORDS else [words[a:a + SENTENCE_WORDS] for a in range(0, len(words), SENTENCE_WORDS)]


def sentences(text: str | None) -> Iterator[list[str]]:
    """The words, in lower case, of each sentence that has words."""
    for s in SENTENCE.findall(lowered(text)):
        if words := WORD.findall(s):
            yield from windows(words)


class Model:
    def __init__(self, weights: dict[int, float], bias: float):
        self.weights, self.bias = weights, bias


class Scorer:
    def __init__(self, model: Model):
        self.model, self.hasher = model, WordHasher()
        self.seen: set[str] = set()
        self.active: dict[str, list[int]] = {}
        self.plain = self._logistic(model.bias)

    @staticmethod
    def _logistic(z: float) -> float:
        return 1 / (1 + exp(-min(max(z, -60.0), 60.0)))

    def _meet(self, words: set[str]) -> None:
        if len(self.seen) > REMEMBERED_WORDS:
            self.seen, self.active = set(), {}
        for w in words:
            if own := [b for b in self.hasher(w) if b in self.model.weights]:
                self.active[w] = own
        self.seen |= words

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or of the document, and (begin, end, p_s) of its offending sentences."""
        low, weights, bias = lowered(text), self.model.weights, self.model.bias
        log_clean, plain, out, any_sentence = 0.0, 0, [], False
        for s in SENTENCE.finditer(low):
            for k, part in enumerate(windows(WORD.findall(s.group()))):
                distinct = set(part)
                if new := distinct - self.seen:
                    self._meet(new)
                any_sentence |= bool(distinct)
                hits = distinct & self.active.keys()
                if not hits:
                    plain += bool(distinct)
                    continue
                p = self._logistic(bias + sum(weights[b] for b in {b for w in hits for b in self.active[w]}))
                log_clean += log1p(-min(p, 1 - 1e-12))
                if p >= THRESHOLD:
                    found = windows(list(WORD.finditer(s.group())))[k]
                    out.append((s.start() + found[0].start(), s.start() + found[-1].end(), p))
        if not any_sentence:
            return 0.0, []
        return 1 - exp(log_clean + plain * log1p(-min(self.plain, 1 - 1e-12))), out


def fit(labels: np.ndarray, plain: np.ndarray, hits: list[list[list[int]]], kept: np.ndarray, counts: tuple[float, float]) -> Model:
    """Weights of the buckets ``kept``. Of each document: its label, the number of its sentences without any of those
    buckets, and for its other sentences the numbers (in kept) of the ones they have. counts: documents of either label
    before sampling, by which the sampled ones are weighted."""
    sizes = np.array([len(s) for own in hits for s in own], np.int64)
    doc = np.repeat(np.arange(len(hits)), [len(own) for own in hits])
    row = np.repeat(np.arange(len(sizes)), sizes)
    col = np.array([c for own in hits for s in own for c in s], np.int64)
    n, k = len(hits), len(kept)
    y = labels.astype(float)
    share = np.array(counts, float) / np.maximum(np.bincount(labels, minlength=2), 1)
    weight = share[labels] / share[labels].sum()
    w, m, v = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)
    w[k] = FIRST_BIAS
    for step in range(1, STEPS + 1):
        z = w[k] + np.bincount(row, w[col], len(doc))
        p = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        p_plain = 1 / (1 + np.exp(-w[k]))
        clean = np.exp(np.bincount(doc, -np.logaddexp(0, z), n) - plain * np.logaddexp(0, w[k]))
        # derivative of the log-likelihood by z of a sentence
        lift = weight * np.where(y == 1, clean / np.maximum(1 - clean, 1e-9), -1.0)
        g_z = lift[doc] * p
        g = np.r_[np.bincount(col, g_z[row], k), g_z.sum() + (lift * plain).sum() * p_plain] - DECAY * np.r_[w[:k], 0]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w += STEP * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model({int(b): float(x) for b, x in zip(kept, w[:k], strict=True) if x}, float(w[k]))


def train(
    documents: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id",
    rows_per_class: int = ROWS_PER_CLASS, features: int = FEATURES,
) -> Model:
    """Fit on a bounded sample of the documents that ``labels`` covers. Sentences become buckets, and buckets are counted,
    on the executors; the driver gets which of the chosen ones each sentence has."""
    common.ship_package(documents.sparkSession)
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    counts = dict(known.groupBy("label").count().collect())
    # written, so that its size can be checked and the texts of all documents needn't be shuffled for it
    chosen = common.written(common.bounded_sample(known, "label", rows_per_class, key), "toxicity-chosen")
    rows = documents.select(key, F.col(text).alias("text")).join(common.broadcast_if_small(chosen, 16), key).select("text", "label")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            found = [[sorted(hasher.buckets(words)) for words in sentences(t.as_py())] for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.list_(pa.int32()))), batch.column(1).cast(pa.int32())], names=["bag", "label"])

    sample = common.written(rows.mapInArrow(common.tidy(bags), "bag array<array<int>>, label int"), "toxicity-sample")
    common.drop_written(chosen)
    per_class, table = presence(sample.select("label", F.array_distinct(F.flatten("bag")).alias("b")), "label", "b", [0, 1])
    if not per_class.all():
        return Model({}, -60.0)
    kept = choose(per_class, table, features)
    column = {int(b): i for i, b in enumerate(kept)}

    def chosen_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain, hits = [], []
            for bag in batch.column(0):
                own = [[column[b] for b in s if b in column] for s in bag.as_py()]
                hits.append([s for s in own if s])
                plain.append(len(own) - len(hits[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(plain, pa.int32()), pa.array(hits, pa.list_(pa.list_(pa.int32())))], names=["label", "plain", "hits"])

    found = sample.mapInArrow(common.tidy(chosen_only), "label int, plain int, hits array<array<int>>").toArrow()
    common.drop_written(sample)
    return fit(
        found.column("label").to_numpy().astype(int), found.column("plain").to_numpy().astype(float), found.column("hits").to_pylist(), kept,
        (counts.get(0, 0), counts.get(1, 0)))


def score(df: DataFrame, model: Model, text: str = "text", names: tuple[str, str] = ("toxicity", "offending")) -> DataFrame:
    """``df`` with toxicity (0 to 1) and offending (begin, end, score of its offending sentences), under ``names``; columns
    of these names are replaced."""
    spark = df.sparkSession
    common.ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # FEATURES numbers
    source = df.drop(*names)
    spans = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.score(t.as_py()) for t in batch.column(text)]
            told = [[{"begin": a, "end": b, "score": float(p)} for a, b, p in x[1]] for x in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in found], pa.float64()), pa.array(told, spans)],
                names=[*batch.schema.names, *names])

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)
    return source.mapInArrow(common.tidy(run), f"{kind}, {names[0]} double, {names[1]} array<struct<begin: int, end: int, score: double>>")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labelled documents that are not held out."""
    documents = common.table(spark, sf_dir, "documents")
    model = train(documents, common.table(spark, sf_dir, "labels").where(~common.held_out()))
    out = score(documents.select("doc_id", "text", common.held_out().alias("held_out")), model)
    return out.select(
        "doc_id", "held_out", F.col("toxicity").alias("score"), (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"), "offending")


def reject_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is below the threshold, with their own columns."""
    model = train(documents, labels)
    names = ("_toxicity_of_text", "_offending_sentences")
    return score(documents, model, names=names).where(F.col(names[0]) < THRESHOLD).select(*documents.columns)
