"""Hashed word features for the text classifiers, and the choice of those that tell classes apart."""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 18
PREFIX = 5
REMEMBERED_WORDS = 200_000
WORD = re.compile(r"[^\W\d_]+")


class WordHasher:
    """Word to its buckets: the word itself, and its first letters if it is longer than those."""

    def __init__(self) -> None:
        self.memory: dict[str, tuple[int, ...]] = {}

    def __call__(self, word: str) -> tuple[int, ...]:
        found = self.memory.get(word)
        if found is None:
            if len(self.memory) > REMEMBERED_WORDS:
                self.memory = {}
            found = self.memory[word] = self.of(word)
        return found

    @staticmethod
    def of(word: str) -> tuple[int, ...]:
        found = (zlib.crc32(word.encode("utf-8", "replace")) % BUCKETS,)
        if len(word) > PREFIX:
            found += (zlib.crc32(b"^" + word[:PREFIX].encode("utf-8", "replace")) % BUCKETS,)
        return found

    def buckets(self, words: list[str]) -> set[int]:
        return {b for w in set(words) for b in self(w)}


def presence(rows: DataFrame, label: str, buckets: str, classes: list) -> tuple[np.ndarray, np.ndarray]:
    """Documents of each class, and of each class and bucket; counted by Spark, BUCKETS x classes numbers come back."""
    at = {c: i for i, c in enumerate(classes)}
    documents, table = np.zeros(len(classes)), np.zeros((len(classes), BUCKETS))
    for c, n in rows.groupBy(label).count().collect():
        documents[at[c]] = n
    counts = rows.select(F.col(label).alias("label"), F.explode(buckets).alias("bucket")).groupBy("label", "bucket").count().toArrow()
    for batch in counts.to_batches():
        row = [at[c] for c in batch.column(0).to_pylist()]
        table[row, np.asarray(batch.column(1))] = np.asarray(batch.column(2))
    return documents, table


def choose(documents: np.ndarray, table: np.ndarray, most: int, least_docs: int = 5) -> np.ndarray:
    """The buckets, at most ``most``, whose presence depends most on the class (chi-square over documents)."""
    n, total = documents.sum(), table.sum(axis=0)
    score = np.zeros(BUCKETS)
    for own, size in zip(table, documents, strict=True):
        expected = np.maximum(total * size / max(n, 1), 1e-9)
        missing = np.maximum((n - total) * size / max(n, 1), 1e-9)
        score += (own - expected) ** 2 * (1 / expected + 1 / missing)
    score[total < least_docs] = 0
    best = np.lexsort((np.arange(BUCKETS), -score))[:most]
    return np.sort(best[score[best] > 0])
