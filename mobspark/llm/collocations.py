"""Phrases whose words occur together, counted in direct-address tiles (operator 13).

Per language, words get ids by falling frequency, so that frequent pairs of neighbours gather at small ids. The plane of
(id, id) is cut into square tiles: a tile with many pairs is counted in one dense array by bincount, the pairs of sparse
tiles as sorted coordinates. Phrases that reach the least count are ranked again by frequency, get ids of their own, and the
next length is counted in the plane of (phrase id, word id); a phrase is only looked at if its first and its last words
without the other end are frequent, too. Workers merge their counts before Spark adds them up by key, so no language,
however hot, meets in one task.

Ids are a bounded dictionary, broadcast: ``MOST_WORDS`` words and ``MOST_PHRASES`` phrases of each length, the most frequent
ones. It bounds memory only. If there are more, phrases in which an end is unknown to the dictionary are counted under
their text, exactly, in the same aggregate.

Scores are computed in decimals of 38 digits and whole division, exact for counts up to 10**15.

Defined results: null texts count as empty, null languages as ``und``. Texts of any length are cut where they have
punctuation, otherwise pieces have no end. Ties in the score go by count and then by the phrase's bytes. Empty tables give no
rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mobspark.llm import common

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
#: A longer phrase with so many hundredths of a phrase's occurrences takes its place.
COVERED = 50
#: Ids that workers know.
MOST_WORDS = 1 << 19
MOST_PHRASES = 1 << 22
#: Side of a tile, and pairs from which a tile is counted densely.
SIDE = 1024
DENSE = SIDE * SIDE // 8
#: Words that a worker cuts before it looks them up, pairs that it gathers before it counts them, and counts that it holds
#: before it passes them on; rows that it passes on at once.
CUT_WORDS = 1 << 18
GATHERED = 1 << 19
HELD = 1 << 20
HELD_TEXTS = 200_000
PASSED = 1 << 16

UNKNOWN = "und"
# fixed values: capitals, piece ends and blanks of the cut; byte FF, which no text holds, marks the ends
_CUT = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\xff" * 10)
END = b"\xff"


def tokens(text: str | None) -> list[bytes]:
    """Words in order, with END between pieces."""
    return [w for w in (text or "").encode("utf-8", "replace").translate(_CUT).replace(END, b" \xff ").split(b" ") if w]


def _counted(schema: str, df: DataFrame, run: Callable) -> DataFrame:
    common.ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, phrase, n) of all words of (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, c in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(c), pa.string()), pa.array([w.decode() for w in c], pa.string()), pa.array(c.values(), pa.int64())],
                    names=["lang", "phrase", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text:
                    c = held.setdefault(lang, Counter())
                    c.update(tokens(text))
                    c.pop(END, None)
            if sum(map(len, held.values())) >= HELD_TEXTS:
                yield from flush()
        yield from flush()

    parts = _counted("lang string, phrase string, n long", texts, run)
    return parts.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


class Dictionary:
    """Ids of the words of one language, and of its frequent phrases of each length."""

    def __init__(self, words: list[bytes], complete: bool):
        self.size = len(words)
        self.joined = b" ".join(words)  # no word holds a blank
        self.complete = [complete]
        self.keys: list[np.ndarray] = []  # of each length from 2 on: prefix id * size + word id, ascending
        self.ids: list[np.ndarray] = []

    def add(self, keys_by_rank: np.ndarray, complete: bool) -> None:
        order = np.argsort(keys_by_rank, kind="stable")
        self.keys.append(keys_by_rank[order])
        self.ids.append(order.astype(np.int32))
        self.complete.append(complete)

    def words(self) -> list[bytes]:
        return self.joined.split(b" ") if self.size else []

    def number(self) -> dict[bytes, int]:
        return dict(zip(self.words(), range(self.size), strict=True))

    def spelled(self, keys: np.ndarray, length: int) -> list[str]:
        """Texts of phrases of ``length`` words, given as prefix id * size + word id."""
        words = np.array([w.decode() for w in self.words()], dtype=object)
        out = None
        for m in range(length, 1, -1):
            prefix, last = keys // self.size, words[keys % self.size]
            out = last if out is None else last + " " + out
            if m > 2:
                by_id = np.empty(len(self.ids[m - 3]), np.int64)
                by_id[self.ids[m - 3]] = self.keys[m - 3]
                keys = by_id[prefix]
        return (words[prefix] + " " + out).tolist()

    def phrases(self, length: int, prefix: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Ids of the phrases of ``length`` words that begin with ``prefix``; -1 where one isn't known."""
        keys, ids = self.keys[length - 2], self.ids[length - 2]
        out = np.full(len(prefix), -1, np.int64)
        if len(keys):
            ok = np.flatnonzero((prefix >= 0) & (last >= 0))
            wanted = prefix[ok] * self.size + last[ok]
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = keys[at] == wanted
            out[ok[hit]] = ids[at[hit]]
        return out


def count_pairs(first: np.ndarray, second: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs as first * width + second, and their counts: dense tiles by bincount, the rest sorted."""
    across = width // SIDE + 1
    where = (first // SIDE) * across + second // SIDE
    tiles, size = np.unique(where, return_counts=True)
    keys, counts = [], []
    rest = np.ones(len(first), bool)
    for t in tiles[size >= DENSE].tolist():
        own = where == t
        rest &= ~own
        cells = np.bincount((first[own] % SIDE) * SIDE + second[own] % SIDE, minlength=SIDE * SIDE)
        met = np.flatnonzero(cells)
        keys.append((t // across * SIDE + met // SIDE) * width + t % across * SIDE + met % SIDE)
        counts.append(cells[met])
    sparse, n = np.unique(first[rest] * width + second[rest], return_counts=True)
    return np.concatenate([*keys, sparse]), np.concatenate([*counts, n])


class _Counts:
    """Counts of one language in a worker: gathered pairs, and merged counts of those before."""

    def __init__(self, width: int):
        self.width = width
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.gathered = 0
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, first: np.ndarray, second: np.ndarray) -> None:
        self.pairs.append((first, second))
        self.gathered += len(first)
        if self.gathered >= GATHERED:
            self.count()

    def count(self) -> None:
        if not self.gathered:
            return
        keys, counts = count_pairs(*map(np.concatenate, zip(*self.pairs, strict=True)), self.width)
        keys, counts = np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        self.keys, self.counts = keys[starts], np.add.reduceat(counts, starts)
        self.pairs, self.gathered = [], 0

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        self.count()
        out = self.keys, self.counts
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        return out


def phrase_counts(texts: DataFrame, shared: Broadcast, length: int) -> DataFrame:
    """(lang, key, phrase, n) of phrases of ``length`` words whose shorter ends may be frequent: under prefix id * words +
    word id, or, where the dictionary doesn't hold an end, under their text. ``shared``: the dictionaries by language, and one for languages without, or None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, other = shared.value
        numbers: dict[str, Callable] = {}
        counts: dict[str, _Counts] = {}
        spelled: Counter = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, c in counts.items():
                keys, n = c.taken()
                for a in range(0, len(keys), PASSED):
                    yield _rows([lang] * len(keys[a : a + PASSED]), keys[a : a + PASSED], None, n[a : a + PASSED])
            if spelled:
                langs, phrases = zip(*spelled, strict=True)
                yield _rows(list(langs), None, [p.decode() for p in phrases], np.fromiter(spelled.values(), np.int64, len(spelled)))
                spelled.clear()

        def count(by_lang: dict[str, list[bytes]]) -> None:
            for lang, found in by_lang.items():
                d = known.get(lang, other)
                if lang not in numbers:
                    numbers[lang] = d.number().get
                    counts[lang] = _Counts(d.size)
                get = numbers[lang]
                word = np.fromiter((get(w, -1) for w in found), np.int64, len(found))
                n = len(word) - length + 1
                if n <= 0:
                    continue
                ids = word
                for m in range(2, length):
                    ids = d.phrases(m, ids[:-1], word[m - 1 :])
                # ids[i] is the phrase of length - 1 words from i on; the next one has to be frequent, too
                sure = np.flatnonzero((ids[:n] >= 0) & (ids[1 : n + 1] >= 0) & (word[length - 1 :] >= 0))
                counts[lang].add(ids[sure], word[sure + length - 1])
                if not all(d.complete):
                    _spell(spelled, lang, found, d, word, ids, length, sure)

        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            cut = 0
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text and (lang in known or other is not None):
                    found = tokens(text)
                    by_lang.setdefault(lang, []).extend(found)
                    by_lang[lang].append(END)
                    cut += len(found)
                if cut >= CUT_WORDS:
                    count(by_lang)
                    by_lang, cut = {}, 0
                    if len(spelled) >= HELD_TEXTS or sum(len(c.keys) + c.gathered for c in counts.values()) >= HELD:
                        yield from flush()
            count(by_lang)
        yield from flush()

    parts = _counted("lang string, key long, phrase string, n long", texts, run)
    return parts.groupBy("lang", "key", "phrase").agg(F.sum("n").alias("n"))


def _spell(spelled: Counter, lang: str, found: list[bytes], d: Dictionary, word: np.ndarray, ids: np.ndarray, length: int, sure: np.ndarray) -> None:
    """Phrases that an incomplete dictionary neither counts nor rules out: an end is missing, and not for sure infrequent."""
    n = len(word) - length + 1
    ended = np.fromiter((w == END for w in found), bool, len(found))
    open_ = np.ones(n, bool)
    open_[sure] = False
    for k in range(length):
        open_ &= ~ended[k : k + n]
        if d.complete[0]:
            open_ &= word[k : k + n] >= 0
    # a missing phrase of words that all have ids is infrequent, if its level is complete
    shorter = word
    for m in range(2, length):
        shorter = d.phrases(m, shorter[:-1], word[m - 1 :])
        if d.complete[m - 1]:
            whole = np.ones(len(shorter), bool)
            for k in range(m):
                whole &= word[k : k + len(shorter)] >= 0
            missing = whole & (shorter < 0)
            for k in range(length - m + 1):
                open_ &= ~missing[k : k + n]
    for i in np.flatnonzero(open_).tolist():
        spelled[lang, b" ".join(found[i : i + length])] += 1


def _rows(langs: list[str], keys: np.ndarray | None, phrases: list[str] | None, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.nulls(len(n), pa.int64()) if keys is None else pa.array(keys, pa.int64()),
         pa.nulls(len(n), pa.string()) if phrases is None else pa.array(phrases, pa.string()), pa.array(n, pa.int64())],
        names=["lang", "key", "phrase", "n"])


def spelled_out(counted: DataFrame, shared: Broadcast, length: int) -> DataFrame:
    """(lang, phrase, n, key): what ``phrase_counts`` gave, with all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, _ = shared.value
        # whole tables of texts are small by now; ids become texts for many rows at once
        for table in _gathered(batches):
            langs = table.column("lang").to_numpy(zero_copy_only=False)
            keys = table.column("key").fill_null(-1).to_numpy()
            phrases = table.column("phrase").to_numpy(zero_copy_only=False).copy()
            for lang in {*langs[keys >= 0].tolist()}:
                at = np.flatnonzero((langs == lang) & (keys >= 0))
                phrases[at] = known[lang].spelled(keys[at], length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(table.column("n").to_numpy(), pa.int64()),
                 pa.array(keys, pa.int64(), mask=keys < 0)], names=["lang", "phrase", "n", "key"])

    return counted.mapInArrow(run, "lang string, phrase string, n long, key long")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= PASSED:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _most_frequent(level: DataFrame, column: str, most: int) -> tuple[dict[str, pa.Array], bool]:
    """Values of ``column`` by language, by falling count: all, or the ``most`` most frequent ones."""
    rows = level.select("lang", column, "n")
    complete = level.count() <= most
    if not complete:
        rows = rows.orderBy(F.desc("n"), "lang", column).limit(most)
    table = rows.toArrow()  # a bounded dictionary
    table = table.sort_by([("lang", "ascending"), ("n", "descending"), (column, "ascending")])
    langs = table.column("lang").to_numpy()
    if not len(langs):
        return {}, complete
    starts = np.flatnonzero(np.r_[True, langs[1:] != langs[:-1]])
    values = table.column(column).combine_chunks()
    return {str(langs[a]): values.slice(a, b - a) for a, b in zip(starts, [*starts[1:], len(langs)], strict=True)}, complete


def frequent_phrases(texts: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, most_words: int = MOST_WORDS,
                     most_phrases: int = MOST_PHRASES) -> tuple[list[DataFrame], DataFrame]:
    """[(lang, phrase, n) of each length] of phrases that occur ``min_count`` times at least, and (lang, total) of words."""
    spark = texts.sparkSession
    words = common.written(word_counts(texts), "phrases-words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    level = common.written(words.where(F.col("n") >= min_count).withColumn("key", F.lit(None).cast("long")), "phrases-1")
    levels = [level]
    ids, complete = _most_frequent(level, "phrase", most_words)
    dictionaries = {lang: Dictionary([w.encode() for w in a.to_pylist()], complete) for lang, a in ids.items()}
    # languages that the bound leaves without any word still have phrases to count
    other = None if complete else Dictionary([], False)
    for length in range(2, max_words + 1):
        shared = spark.sparkContext.broadcast((dictionaries, other))
        counted = phrase_counts(texts, shared, length).where(F.col("n") >= min_count)
        level = common.written(spelled_out(counted, shared, length), f"phrases-{length}")
        shared.destroy()
        levels.append(level)
        if length < max_words:
            keyed = level.where("key IS NOT NULL")
            keys, complete = _most_frequent(keyed, "key", most_phrases)
            complete &= keyed.count() == level.count()
            for lang, d in dictionaries.items():
                d.add(keys[lang].to_numpy() if lang in keys else np.zeros(0, np.int64), complete)
            if other is not None:
                other.add(np.zeros(0, np.int64), complete)
    return [x.select("lang", "phrase", "n") for x in levels], totals


def mine(df: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
         covered: int = COVERED, most_words: int = MOST_WORDS, most_phrases: int = MOST_PHRASES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first ``top`` phrases."""
    texts = df.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).cast("string").alias("text"))
    levels, totals = frequent_phrases(texts, min_count, max_words, most_words, most_phrases)
    parts = levels[0]
    for level in levels[1:-1]:
        parts = parts.union(level)
    candidates = None
    for words, level in enumerate(levels[1:], 2):
        rows = level.select("lang", "phrase", F.col("n").alias("a"), F.lit(words).alias("words"))
        candidates = rows if candidates is None else candidates.union(rows)
    # the largest count of a longer candidate that holds a phrase
    inner = candidates.where("words > 2").withColumn("w", F.split("phrase", " ")).select(
        "lang", F.col("a").alias("outer"), F.explode(F.expr(
            "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), i -> array_join(slice(w, i, m), ' '))))"
        )).alias("phrase"))
    largest = inner.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    kept = candidates.join(largest, ["lang", "phrase"], "left").where(
        F.col("outer").isNull() | (100 * F.col("outer") < covered * F.col("a"))).drop("outer")
    cuts = kept.withColumn("w", F.split("phrase", " ")).select(
        "lang", "phrase", "a", F.explode(F.expr("sequence(1, words - 1)")).alias("k"), "w").select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("first"),
        F.expr("array_join(slice(w, k + 1, size(w) - k), ' ')").alias("rest"))
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    big = "decimal(15,0)"
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn(
        "score", F.expr(f"cast((cast(a as {big}) * cast(a as {big}) * 1000000) div (cast(l as {big}) * cast(r as {big})) as long)"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    ranked = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long"))
    return ranked.where(F.col("rank") <= top).join(totals.withColumnRenamed("total", "n"), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of every language of all documents."""
    return mine(common.table(spark, sf_dir, "documents"))
