"""Spelling variants one edit apart, by dense prefix-suffix tiling (operator 11).

Two words are one inserted, deleted or replaced code point apart exactly if their common prefix and common suffix add up to
the longer length minus one at least. Blocks of words stand as padded code-point matrices, and a tile compares every word
of one block with every word of another at once, column by column, from the left and from the right.

Which blocks meet follows from the same rule: with M the longer length, the prefix has ``M // 2`` code points or the suffix
``M - M // 2``. So a word joins, for M its own length and the next, the group of its first and the group of its last
code points of that number, and only words of a group are tiled: no join of all words with all. A group of more words than
a tile takes is dealt into blocks by hash, and each pair of its blocks is a tile of its own, so a hot prefix spreads over
many tasks. A pair counts in its prefix group if the prefix is long enough, else in its suffix group: once in all. Tiles
send no pairs but each word's number of near words and its best one.

Words come from whole texts; a noise rule of ``op11`` deletes a code point of some runs. Counts are combined in the workers
before they are shuffled, and cover all texts.

Defined results: null and empty texts have no words, null ids count as empty in the noise rule. Runs of any length are
words. Equal words are one. Ties of the largest count go to the word that comes first in code-point order. An empty table
gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mobspark.llm import common

#: Code points of a word, and its occurrences, at least.
MIN_LENGTH = 6
MIN_COUNT = 5
#: A form occurs so many times as often as its variant at least.
DOMINANCE = 5
#: Words of a block, and code points of a block of long words.
BLOCK = 1024
BLOCK_POINTS = 1 << 21
#: Cells of a tile that are compared together.
CELLS = 1 << 19
#: Words that a worker counts before it passes them on.
HELD_WORDS = 200_000

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: One in so many runs of a document loses a code point.
NOISE = 199


def noisy(doc_id: object, run: str) -> str:
    """The run, without one code point if its checksum with the document's id says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % NOISE:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def word_counts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                change: Callable[[object, str], str] | None = None) -> DataFrame:
    """(word, n): lower-cased words of ``text`` with their occurrences; ``change`` may alter a word of a document."""
    common.ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = Counter(RUN.findall(t.translate(LOWER))) if t else {}
                for word, n in found.items():
                    if change is not None:
                        word = change(i, word)
                    if len(word) >= min_length:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield flush()
        if held:
            yield flush()

    counted = df.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _longest(lengths: np.ndarray) -> int:
    return int(lengths.max(initial=1))


def matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points from the left, from the right (both with a column for each place), and lengths. Missing places hold
    0 in one; rows of two blocks never agree there, since ``tile`` limits agreement by the shorter length."""
    lengths = np.fromiter(map(len, words), np.int32, len(words))
    width = _longest(lengths)
    points = np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(len(words), width)
    if points.max(initial=0) < 256:
        points = points.astype(np.uint8)
    place = np.arange(width)
    turned = np.take_along_axis(points, np.maximum(lengths[:, None] - 1 - place[None, :], 0), axis=1)
    return np.ascontiguousarray(points.T), np.ascontiguousarray(turned.T), lengths


def _agreement(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common beginning of every row of one block with every row of the other, at most ``most``."""
    alive = a[0][:, None] == b[0][None, :]
    total = alive.astype(np.int32)
    for x, y in zip(a[1:], b[1:], strict=False):
        alive &= x[:, None] == y[None, :]
        if not alive.any():
            break
        total += alive
    return np.minimum(total, most)


def tile(left: tuple, right: tuple, m: int, by_prefix: bool) -> np.ndarray:
    """Whether each word of one block and each of the other are one edit apart, the longer one has ``m`` code points, and
    the pair counts in this kind of group."""
    (a, a_back, la), (b, b_back, lb) = left, right
    short, long = np.minimum(la[:, None], lb[None, :]), np.maximum(la[:, None], lb[None, :])
    prefix = _agreement(a, b, short)
    suffix = _agreement(a_back, b_back, short)
    equal = (la[:, None] == lb[None, :]) & (prefix == long)
    return (long == m) & (short >= m - 1) & (prefix + suffix >= m - 1) & ~equal & ((prefix >= m // 2) == by_prefix)


class _Best:
    """Near words counted, and the best of them, for the words of one block: by count, then code-point order."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n = words, n
        self.near = np.zeros(len(words), np.int64)
        self.best: list[tuple[int, str] | None] = [None] * len(words)

    def add(self, i: int, hits: np.ndarray, other: _Best) -> None:
        """``hits``: rows of ``other`` that are near word ``i``."""
        self.near[i] += len(hits)
        top = hits[other.n[hits] == other.n[hits].max()]
        found = (-int(other.n[top[0]]), min(other.words[j] for j in top))
        if self.best[i] is None or found < self.best[i]:
            self.best[i] = found


def _cut(block: tuple, a: int, b: int) -> tuple:
    return block[0][:, a:b], block[1][:, a:b], block[2][a:b]


def compare_blocks(left: _Best, right: _Best | None, m: int, by_prefix: bool) -> None:
    """Count near words between two blocks, or within one."""
    a = matrices(left.words)
    other = left if right is None else right
    b = a if right is None else matrices(right.words)
    step = max(1, CELLS // max(1, len(other.words)))
    for at in range(0, len(left.words), step):
        near = tile(_cut(a, at, at + step), b, m, by_prefix)
        for i in np.flatnonzero(near.any(axis=1)).tolist():
            left.add(at + i, np.flatnonzero(near[i]), other)
        if right is not None:
            for j in np.flatnonzero(near.any(axis=0)).tolist():
                right.add(j, at + np.flatnonzero(near[:, j]), left)


def _small_groups(words: list[str], n: np.ndarray, starts: np.ndarray, m: np.ndarray, by_prefix: np.ndarray, size: int) -> dict:
    """Groups of at most ``size`` words, many in one stack of tiles; (row, row) of near words of all of them."""
    left, back, lengths = matrices(words)
    groups = len(starts) - 1
    slot = starts[:-1, None] + np.arange(size)[None, :]
    real = slot < starts[1:, None]
    slot = np.where(real, slot, 0)
    lens = np.where(real, lengths[slot], -9)
    short, long = np.minimum(lens[:, :, None], lens[:, None, :]), np.maximum(lens[:, :, None], lens[:, None, :])

    def agreement(points: np.ndarray) -> np.ndarray:
        alive = np.ones((groups, size, size), bool)
        total = np.zeros((groups, size, size), np.int32)
        for column in points:
            x = column[slot]
            alive &= x[:, :, None] == x[:, None, :]
            if not alive.any():
                break
            total += alive
        return np.minimum(total, short)

    prefix = agreement(left)
    suffix = agreement(back)
    mm = m[:, None, None]
    near = (long == mm) & (short >= mm - 1) & (prefix + suffix >= mm - 1)
    near &= ~((short == long) & (prefix == long)) & ((prefix >= mm // 2) == by_prefix[:, None, None])
    g, i, j = np.nonzero(near)
    return {"a": slot[g, i], "b": slot[g, j]}


def _rows(words: list[str], near: np.ndarray, best_n: np.ndarray, best: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(words, pa.string()), pa.array(near, pa.int64()), pa.array(best_n, pa.int64()), pa.array(best, pa.string())],
        names=["word", "n_near", "best_n", "best"])


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by tile; small tiles are stacked, others compared one by one."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        rest.append(batch)
        table = pa.Table.from_batches(rest)
        if len(table) < 8192:
            continue
        starts = _starts(table)
        yield from _whole_tiles(table.slice(0, starts[-1]), starts)  # the last tile may go on
        rest = table.slice(starts[-1]).combine_chunks().to_batches()
    if rest:
        table = pa.Table.from_batches(rest)
        yield from _whole_tiles(table, np.r_[_starts(table), len(table)])


def _starts(table: pa.Table) -> np.ndarray:
    keys = [table.column(c).to_numpy() for c in ("gid", "i", "j")]
    changed = np.zeros(len(table), bool)
    changed[:1] = True
    for k in keys:
        changed[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(changed)


def _whole_tiles(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not len(table):
        return
    words = table.column("word").to_pylist()
    n, m = table.column("n").to_numpy(), table.column("m").to_numpy()
    by_prefix, side = table.column("by_prefix").to_numpy(), table.column("side").to_numpy()
    i, j = table.column("i").to_numpy(), table.column("j").to_numpy()
    sizes = np.diff(starts)
    for size in (2, 4, 8, 16, 32):
        fit = (sizes > size // 2) & (sizes <= size) & (i[starts[:-1]] == j[starts[:-1]])
        # long words are stacked apart, so that they don't widen the matrices of all
        for wide in (False, True):
            chosen = np.flatnonzero(fit & ((m[starts[:-1]] > 24) == wide))
            width = int(m[starts[:-1]][chosen].max(initial=1))
            step = max(1, CELLS // (size * max(size, width)))
            for at in range(0, len(chosen), step):
                yield from _stack(words, n, m, by_prefix, starts, chosen[at : at + step], size)
    for g in np.flatnonzero((sizes > 32) | ((sizes > 1) & (i[starts[:-1]] != j[starts[:-1]]))).tolist():
        a, b = int(starts[g]), int(starts[g + 1])
        if i[a] == j[a]:
            blocks = [_Best(words[a:b], n[a:b])]
        else:
            cut = a + int(np.searchsorted(side[a:b], 1))
            blocks = [_Best(words[a:cut], n[a:cut]), _Best(words[cut:b], n[cut:b])]
            if not all(x.words for x in blocks):
                continue
        compare_blocks(blocks[0], blocks[1] if len(blocks) > 1 else None, int(m[a]), bool(by_prefix[a]))
        for x in blocks:
            hit = np.flatnonzero(x.near)
            if len(hit):
                found = [x.best[k] for k in hit.tolist()]
                yield _rows([x.words[k] for k in hit.tolist()], x.near[hit], [-f[0] for f in found], [f[1] for f in found])


def _stack(words: list[str], n: np.ndarray, m: np.ndarray, by_prefix: np.ndarray, starts: np.ndarray, chosen: np.ndarray,
           size: int) -> Iterator[pa.RecordBatch]:
    lens = starts[chosen + 1] - starts[chosen]
    offsets = np.r_[0, np.cumsum(lens)]
    rows = np.repeat(starts[chosen] - offsets[:-1], lens) + np.arange(offsets[-1])
    own = [words[r] for r in rows.tolist()]
    near = _small_groups(own, n[rows], offsets, m[starts[chosen]], by_prefix[starts[chosen]], size)
    if not len(near["a"]):
        return
    # a word's hits by count, then code-point order; UTF-32 order is code-point order
    count = n[rows][near["b"]]
    order = np.lexsort((np.array(own, dtype=object)[near["b"]].astype(str), -count, near["a"]))
    a, b, count = near["a"][order], near["b"][order], count[order]
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    yield _rows([own[k] for k in a[first].tolist()], np.diff(np.r_[first, len(a)]), count[first], [own[k] for k in b[first].tolist()])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of every word of ``words`` (word, n; distinct) that has near words."""
    common.ship_package(words.sparkSession)
    length = F.char_length("word")
    m = F.explode(F.array(length, length + 1)).alias("m")
    half = (F.col("m") / 2).cast("int")
    kinds = F.explode(F.array(
        F.struct(F.lit(True).alias("by_prefix"), F.expr("left(word, int(m / 2))").alias("part")),
        F.struct(F.lit(False).alias("by_prefix"), F.expr("right(word, m - int(m / 2))").alias("part")))).alias("g")
    keyed = words.select("word", "n", m).withColumn("h", half).select("word", "n", "m", kinds).select(
        F.xxhash64("g.by_prefix", "m", "g.part").alias("gid"), "m", F.col("g.by_prefix").alias("by_prefix"), "word", "n")
    size = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_POINTS) / F.col("m")))).cast("int")
    hot = common.written(
        keyed.groupBy("gid").agg(F.count(F.lit(1)).alias("members"), F.first(size).alias("size")).where("members > size").select(
            "gid", F.ceil(F.col("members") / F.col("size")).cast("int").alias("blocks")), "spelling-hot")
    dealt = keyed.join(common.broadcast_if_small(hot, 16), "gid", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own: Column = F.pmod(F.xxhash64("word", F.lit(11)), F.col("blocks")).cast("int")
    met = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("met")
    tiles = dealt.select("gid", "m", "by_prefix", "word", "n", own.alias("own"), met).select(
        "gid", F.least("own", "met").alias("i"), F.greatest("own", "met").alias("j"), (F.col("own") > F.col("met")).cast("int").alias("side"),
        "m", "by_prefix", "word", "n")
    partitions = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = tiles.repartition(partitions, "gid", "i", "j").sortWithinPartitions("gid", "i", "j", "side").mapInArrow(
        _tiles, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def variants(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``words`` (word, n; distinct).

    Counts grow by ``dominance`` (2 at least) from form to form, which bounds the steps to a root by the logarithm of the
    largest; each join doubles the steps taken.
    """
    if dominance < 2:
        raise ValueError("forms have to be at least twice as frequent as their variants")
    words = common.written(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    most = words.agg(F.max("n")).first()[0] or 1
    near = near_words(words)
    fits = F.col("best_n") >= dominance * F.col("n")
    rows = common.written(
        words.join(near, "word", "left").select(
            "word", F.when(fits, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(fits, F.col("best_n")).alias("form_n")), "spelling-forms")
    steps = max(1, math.ceil(math.log(max(most, 2), dominance)))
    # only words with a form have a way to go; all others are roots themselves
    way = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(steps)))):
        way = common.written(way, "spelling-way")
        further = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        way = way.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    roots = rows.join(way, "word", "left")
    return roots.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    documents = common.table(spark, sf_dir, "documents")
    return variants(word_counts(documents, change=noisy))
