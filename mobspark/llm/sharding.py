"""Shards of near equal bytes by histogram sort (operator 12).

Rows are ordered by a key and cut into shards, ranges of the key, whose bytes are as equal as whole rows allow. The
splitters are found by counting, not by sampling: each round lays probes into the brackets that still hold a splitter and
counts exactly, in one aggregate over (key, size), the bytes and rows below every probe; a bracket then shrinks to the two
probes around its target. When all splitters meet the tolerance, rows are exchanged once. Each shard is made of several
pieces with splitters of their own, so that the exchange has pieces of a size that tasks can sort; a row's slot is its
place in its piece behind the rows that the histogram counted below the piece.

The key is a pair of longs, compared in this order: the id, and a hash of the text for rows that repeat an id. All
splitters live in that 128-bit space, so a hot id is cut within. Main path: DataFrame functions only.

Defined results: null ids come first, null and empty texts have size 1. Rows that repeat id and text are interchangeable
and stay together, unless they hold a splitter off its target by more than ``SPLIT_TIES`` of a shard; then the rows are
written once with a number of their own, by which they're cut. An empty table has no rows. Existing columns of the results'
names are replaced, all others pass through. Shards may be empty if there are fewer rows than shards. The input is read
twice and has to hold the same rows both times; write it first if it comes from random or changing sources.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mobspark.llm import common

SHARDS = 8
#: Bytes of text that one task sorts, as long as MOST_SPLITTERS allow so many pieces; larger pieces sort by spilling.
PIECE_BYTES = 8 << 20
#: Splitters of one call at most, and probes of one round: their look-up is part of the plan.
MOST_SPLITTERS = 255
#: Share of a piece by which splitters inside a shard may miss; those only balance tasks.
PIECE_TOLERANCE = 0.25
#: Share of a shard that repeated rows may shift a splitter before they are cut, too.
SPLIT_TIES = 0.001

LOW = -(1 << 63)


def _joined(k: int, t: int) -> int:
    """The pair as one number in the same order."""
    return ((k - LOW) << 64) + (t - LOW)


def _pair(key: int) -> tuple[int, int]:
    return (key >> 64) + LOW, (key & ((1 << 64) - 1)) + LOW


def _reaches(key: int) -> Column:
    """Whether a row's (k, t) is the key or above."""
    k, t = _pair(key)
    if t == LOW:
        return F.col("k") >= k
    return (F.col("k") > k) | ((F.col("k") == k) & (F.col("t") >= t))


def places(keys: list[int], begin: int = 0) -> Column:
    """How many of the ascending keys a row reaches, by halving."""
    if not keys:
        return F.lit(begin)
    half = len(keys) // 2
    return F.when(_reaches(keys[half]), places(keys[half + 1 :], begin + half + 1)).otherwise(places(keys[:half], begin))


class _Splitter:
    """A target in bytes, and the bracket around it: keys with the exact bytes and rows below them."""

    def __init__(self, target: float, miss: float, most: float, low: tuple[int, int, int], high: tuple[int, int, int]):
        self.target, self.miss, self.most, self.low, self.high = target, miss, most, low, high

    def nearest(self) -> tuple[int, int, int]:
        return min(self.low, self.high, key=lambda x: abs(x[1] - self.target))

    def off(self) -> float:
        return abs(self.nearest()[1] - self.target)

    def held_off_by_ties(self) -> bool:
        return self.off() > self.most and self.high[2] - self.low[2] > 1

    def open(self) -> bool:
        """Whether more than one row is in the bracket, no single key, and neither end is near enough."""
        return self.high[0] - self.low[0] > 1 and self.high[2] - self.low[2] > 1 and self.off() > self.miss

    def shrink(self, marks: list[tuple[int, int, int]]) -> None:
        inside = [m for m in marks if self.low[0] < m[0] < self.high[0]]
        at = bisect_right([m[1] for m in inside], self.target)
        if at:
            self.low = inside[at - 1]
        if at < len(inside):
            self.high = inside[at]


def _probes(splitters: list[_Splitter]) -> list[int]:
    """Evenly spaced keys inside the brackets that are still open."""
    brackets = sorted({(s.low[0], s.high[0]) for s in splitters if s.open()})
    brackets = brackets[:MOST_SPLITTERS]
    each = MOST_SPLITTERS // max(1, len(brackets))
    found: set[int] = set()
    for low, high in brackets:
        n = min(each, high - low - 1)
        found.update(low + (high - low) * (i + 1) // (n + 1) for i in range(n))
    return sorted(found - {b for pair in brackets for b in pair})


def _below(sized: DataFrame, probes: list[int]) -> list[tuple[int, int, int]]:
    """(probe, bytes below, rows below) by one exact count."""
    counts = sized.groupBy(places(probes).alias("place")).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    found = {r.place: (int(r.bytes), r.rows) for r in counts.collect()}  # one row for each place at most
    out, total, rows = [], 0, 0
    for i, probe in enumerate(probes):
        more = found.get(i, (0, 0))
        total, rows = total + more[0], rows + more[1]
        out.append((probe, total, rows))
    return out


def find_splitters(sized: DataFrame, shards: int, tolerance: float, piece_bytes: int = PIECE_BYTES) -> tuple[list[_Splitter], int]:
    """Splitters of all pieces of ``sized`` (k, t, size), ascending, and the number of pieces in a shard.

    Splitters of shards miss their target by ``tolerance`` of a shard at most, or are the nearest there is.
    """
    row = sized.agg(F.sum("size"), F.count(F.lit(1)), F.min("k"), F.max("k")).first()
    if not row[1]:
        return [], 1
    total = int(row[0])
    pieces = max(1, min(-(-total // (shards * piece_bytes)), (MOST_SPLITTERS + 1) // shards))
    low, high = (_joined(row[2], LOW), 0, 0), (_joined(row[3], -LOW - 1) + 1, total, row[1])
    n = shards * pieces
    splitters = [
        _Splitter(total * i / n, tolerance * total / shards if i % pieces == 0 else PIECE_TOLERANCE * total / n,
                  max(tolerance, SPLIT_TIES) * total / shards, low, high)
        for i in range(1, n)
    ]
    while probes := _probes(splitters):
        marks = _below(sized, probes)
        for s in splitters:
            s.shrink(marks)
    return splitters, pieces


def keyed(df: DataFrame, doc_id: str, text: str) -> list[Column]:
    """The pair that orders rows, and their size."""
    words = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LOW)).alias("k"), F.xxhash64(words).alias("t"),
        (F.octet_length(words) + 1).cast("long").alias("size"),
    ]


def shard(df: DataFrame, shards: int = SHARDS, tolerance: float = 0.0, doc_id: str = "doc_id", text: str = "text",
          piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``df`` with ``shard`` (from 0, in key order) and ``slot`` (the row's place in its shard, from 0)."""
    if not 1 <= shards <= MOST_SPLITTERS + 1:
        raise ValueError(f"from 1 to {MOST_SPLITTERS + 1} shards, not {shards}")
    source = df.drop(*[c for c in ("shard", "slot") if c not in (doc_id, text)])
    own = F.struct(*[F.col(f"`{c}`") for c in source.columns]).alias("own")
    rows = source.select(*keyed(source, doc_id, text), own)
    sized = common.written(rows.select("k", "t", "size"), "shard-sizes")
    splitters, pieces = find_splitters(sized, shards, tolerance, piece_bytes)
    if any(s.held_off_by_ties() for s in splitters[pieces - 1 :: pieces]):
        common.drop_written(sized)
        rows = common.written(rows.withColumn("t", F.monotonically_increasing_id()), "shard-rows")
        sized = rows.select("k", "t", "size")
        splitters, pieces = find_splitters(sized, shards, tolerance, piece_bytes)
    else:
        common.drop_written(sized)
    return _exchange(rows, [s.nearest() for s in splitters], pieces)


def _exchange(rows: DataFrame, marks: list[tuple[int, int, int]], pieces: int) -> DataFrame:
    """Every row into its piece, in one shuffle, and numbered there."""
    # the bytes below ascend with the targets; keys with equal bytes below cut alike
    marks = sorted(marks)
    begin = [0, *[m[2] for m in marks]]
    first = [b - begin[i - i % pieces] for i, b in enumerate(begin)]
    dealt = rows.withColumn("piece", places([m[0] for m in marks])).repartitionById(len(begin), "piece")
    at = F.row_number().over(Window.partitionBy("piece").orderBy("k", "t"))
    slot = F.element_at(F.array(*[F.lit(b).cast("long") for b in first]), F.col("piece") + 1) + at - 1
    return dealt.select("own.*", F.floor(F.col("piece") / pieces).cast("int").alias("shard"), slot.alias("slot"))


def op12_histogram_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of all documents with bytes as equal as whole documents allow; shards are ranges of doc_id."""
    sharded = shard(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return sharded.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
