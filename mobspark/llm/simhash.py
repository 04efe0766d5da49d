"""Near-duplicate documents by SimHash under the generalised pigeonhole principle (operator 6).

A fingerprint has 64 bits; two documents link when theirs differ in at most ``max_distance`` bits. The bits are grouped
into m partitions, correlated bits together, and partition i gets its own threshold t_i with sum(t_i) = max_distance -
m + 1: two linked fingerprints differ in at most t_i bits in some partition i (else the distances would sum to more).
A threshold of -1 leaves a partition out. Thresholds minimise, by dynamic programming, the estimated work: probes sent
plus pairs compared. A fingerprint goes to its own value of each partition and, of two values that differ in up to t_i
bits, the one with the lowest differing bit set is sent to the other's. Within a value all fingerprints are compared,
and a spanning forest of their links goes on: components are the same as with all links.

Documents of one fingerprint count once. Values shared by very many fingerprints are split into blocks, and every
pair of blocks is compared by a task of its own, so no group has to fit into one.

Null or empty texts and texts without words have the fingerprint zero and link like any other. A null doc_id keeps its
fingerprint and gets the component of its fingerprint, whose id is the smallest doc_id that is not null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mobspark.llm import common

BITS = 64
SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
#: Largest difference within a partition that probes are made for.
MAX_RADIUS = 2
#: Fingerprints of one value that are compared in one block.
BLOCK = 8192
#: Work of sending one probe, in pairs compared.
PROBE_COST = 40.0

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint: a bit is set if over half of the shingles' hashes have it."""
    import xxhash

    words = WORD.findall((text or "").encode("utf-8", "replace").translate(LOWER))
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    begins = ends - lengths + 1
    digest = xxhash.xxh64_intdigest
    spans = zip(begins[: len(words) - shingle_words + 1].tolist(), ends[shingle_words - 1:].tolist(), strict=True)
    hashes = np.fromiter([digest(joined[a:b], SEED) for a, b in spans], np.uint64, len(words) - shingle_words + 1)
    counts = np.zeros(BITS, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = hashes[a:a + (1 << 16)].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_ = np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")
    return int(set_[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS,
                 text_hash: bool = False) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long; and the text's ``text_hash`` if asked for."""
    common.ship_package(docs.sparkSession)
    also = [F.xxhash64("text").alias("text_hash")] if text_hash else []
    kind = "doc_id long, fp long" + ", text_hash long" * text_hash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), shingle_words) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values), *batch.columns[2:]], names=["doc_id", "fp", *batch.schema.names[2:]])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).select("*", *also).mapInArrow(common.tidy(run), kind)


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many of them have bits i and j set (64 x 64), over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            b = _bits(np.ascontiguousarray(batch.column(0).to_numpy())).astype(np.float32)
            total += b.T @ b
            n += len(b)
        if n:
            yield pa.RecordBatch.from_arrays([
                pa.array([BITS * BITS, *range(BITS * BITS)], pa.int32()), pa.array([n, *total.ravel().astype(np.int64).tolist()], pa.int64()),
            ], names=["cell", "n"])

    rows = fps.select("fp").mapInArrow(common.tidy(run), "cell int, n long").groupBy("cell").agg(F.sum("n")).collect()
    counts = dict(rows)
    return counts.get(BITS * BITS, 0), np.array([counts.get(i, 0) for i in range(BITS * BITS)], float).reshape(BITS, BITS)


def correlated_partitions(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of even size: a group starts with the most correlated free bit and takes, one by one, the
    free bit with the highest mean absolute correlation to it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    free, out = list(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        group = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < size:
            best = max(free, key=lambda b: (corr[b, group].mean(), -b))
            group.append(best)
            free.remove(best)
        out.append(sorted(group))
    return out


def distance_shares(p: np.ndarray, bits: list[int], most: int) -> np.ndarray:
    """Probability that two independent fingerprints differ in exactly 0..most of the bits, bits taken as independent."""
    out = np.zeros(most + 1)
    out[0] = 1
    for b in bits:
        q = 2 * p[b] * (1 - p[b])
        out = out * (1 - q) + np.r_[0, out[:-1]] * q
    return out


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds, one for each partition out of the keys of its ``costs``, that sum to ``total`` at the least cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (spent, chosen) in best.items():
            for t, c in cost.items():
                if used + t not in nxt or spent + c < nxt[used + t][0]:
                    nxt[used + t] = (spent + c, [*chosen, t])
        best = nxt
    if total not in best:
        raise ValueError("no allocation reaches the distance; raise MAX_RADIUS or the number of partitions")
    return best[total]


def threshold_costs(n: int, pairs_equal: float, shares: np.ndarray, size: int) -> dict[int, float]:
    """Estimated work of each threshold: probes, and pairs compared, scaled to the pairs that are equal in the data."""
    out = {-1: 0.0}
    scale = max(pairs_equal, 1.0) / max(shares[0], 1e-300)
    for t in range(len(shares)):
        probes = n * sum(comb(size, d) / (1 if d == 0 else 2) for d in range(t + 1))
        out[t] = PROBE_COST * probes + scale * shares[: t + 1].sum()
    return out


def plan(fps: DataFrame, max_distance: int = MAX_DISTANCE) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition, from statistics over all fingerprints."""
    n, both = bit_statistics(fps)
    p = np.diag(both) / max(n, 1)
    radius = min(MAX_RADIUS, max_distance)
    options = []
    for parts in range(1, max_distance + 2):
        groups = correlated_partitions(n, both, parts)
        shares = [distance_shares(p, g, radius) for g in groups]
        costs = [threshold_costs(n, s[0] * n * n / 2, s, len(g)) for s, g in zip(shares, groups, strict=True)]
        try:
            options.append((allocate(costs, max_distance - parts + 1)[0], parts))
        except ValueError:
            continue
    groups = correlated_partitions(n, both, min(options)[1])
    # equal pairs as they are in the data: bits of a group are correlated, which the product of their shares misses
    values = fps.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), _packed(F.col("fp"), g).alias("value")) for i, g in enumerate(groups)])).alias("v"))
    equal = {r[0]: float(r[1]) for r in values.groupBy("v.part", "v.value").count().groupBy("part").agg(
        F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2)).collect()}
    costs = [threshold_costs(n, equal.get(i, 0.0), distance_shares(p, g, radius), len(g)) for i, g in enumerate(groups)]
    return list(zip(groups, allocate(costs, max_distance - len(groups) + 1)[1], strict=True))


def _packed(fp, bits: list[int]):
    """The bits of a partition, left in place, the others zero."""
    mask = sum(1 << b for b in bits)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def _probe_masks(bits: list[int], threshold: int) -> list[tuple[int, int]]:
    """(mask to flip, its lowest bit) for all differences of 1..threshold bits."""
    from itertools import combinations

    return [(sum(1 << b for b in c), 1 << min(c)) for d in range(1, threshold + 1) for c in combinations(bits, d)]


def probes(fps: DataFrame, partitions: list[tuple[list[int], int]]) -> DataFrame:
    """(part, value, fp, own): every fingerprint at its own values, and at the values that it is to be compared with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.ascontiguousarray(batch.column(0).to_numpy()).view(np.uint64)
            for i, (bits, threshold) in enumerate(partitions):
                if threshold < 0:
                    continue
                mask = np.uint64(sum(1 << b for b in bits))
                yield made(i, fp & mask, fp, True)
                for flip, lowest in _probe_masks(bits, threshold):
                    of = fp[(fp & np.uint64(lowest)) != 0]
                    if len(of):
                        yield made(i, (of & mask) ^ np.uint64(flip), of, False)

    def made(i: int, value: np.ndarray, fp: np.ndarray, own: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(fp), i, np.int32)), pa.array(value.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(np.full(len(fp), own)),
        ], names=["part", "value", "fp", "own"])

    return fps.select("fp").mapInArrow(common.tidy(run), "part int, value long, fp long, own boolean")


def _links(fp: np.ndarray, start: np.ndarray, size: np.ndarray, owned: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (rows of fp) that link: rows of a group stand together, those with ``owned`` first; one of a pair is owned.

    Row r is compared with r + 1, r + 2, ... for all groups at once.
    """
    end = start + size
    rows = np.flatnonzero(owned)
    limit = np.repeat(end, size)[rows]
    shift = 1
    while len(rows):
        other = rows + shift
        ok = other < limit
        rows, limit, other = rows[ok], limit[ok], other[ok]
        hit = np.bitwise_count(fp[rows] ^ fp[other]) <= most
        if hit.any():
            yield rows[hit], other[hit]
        shift += 1


def spanning_forest(a: np.ndarray, b: np.ndarray, n: int, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those of the links a-b that join different trees of ``label`` (a root for each of n nodes), and the new roots."""
    took_a, took_b = [], []
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        high, low = np.maximum(x, y), np.minimum(x, y)
        order = np.lexsort((low, high))
        first = order[np.r_[True, high[order][1:] != high[order][:-1]]]
        took_a.append(a[first])
        took_b.append(b[first])
        label[high[first]] = low[first]  # every root hangs below a smaller one, so no ring forms
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *took_a]), np.concatenate([none, *took_b]), label


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect the same ones as all links do."""
    partitions = plan(fps, max_distance)
    sent = probes(fps, partitions)
    # values with many fingerprints are cut into blocks; a pair of blocks is compared once, by its own group
    counts = sent.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    hot = counts.select("part", "value", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    dealt = sent.join(hot, ["part", "value"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp", "own"), F.col("blocks")).cast("int")
    dealt = dealt.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "part", "value", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "fp", "own", "mine")
    keys = ["part", "value", "low", "high"]
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys, F.desc("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 200_000:  # groups are whole up to the last one's begin
                table = pa.Table.from_batches(held).combine_chunks()
                cut = group_begin(table)
                yield from forest(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                size = sum(b.num_rows for b in held)
        if held:
            yield from forest(pa.Table.from_batches(held).combine_chunks())

    def group_begin(table: pa.Table) -> int:
        same = np.ones(table.num_rows, bool)
        for k in keys:
            c = table.column(k).to_numpy()
            same &= c == c[-1]
        return int(np.argmax(same))

    def forest(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        columns = [table.column(k).to_numpy() for k in keys]
        change = np.zeros(table.num_rows, bool)
        change[0] = True
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        start = np.flatnonzero(change)
        size = np.diff(np.r_[start, table.num_rows])
        fp, own = table.column("fp").to_numpy().view(np.uint64), table.column("own").to_numpy()
        # rows of one block are compared with each other only in that block's own group, which has low = high
        crossing = columns[2] != columns[3]
        mine = table.column("mine").to_numpy()
        values, node = np.unique(fp, return_inverse=True)
        label, out_a, out_b = np.arange(len(values)), [], []
        for a, b in _links(fp, start, size, own, max_distance):
            ok = ~crossing[a] | (mine[a] != mine[b])
            x, y, label = spanning_forest(node[a[ok]], node[b[ok]], len(values), label)
            out_a.append(x)
            out_b.append(y)
        if out_a:
            x, y = np.concatenate(out_a), np.concatenate(out_b)
            yield pa.RecordBatch.from_arrays([pa.array(values[x].view(np.int64)), pa.array(values[y].view(np.int64))], names=["a", "b"])

    return dealt.mapInArrow(common.tidy(run), "a long, b long")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE,
) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    own = common.written(fingerprints(docs, doc_id, text, shingle_words), "simhash")
    fps = own.groupBy("fp").agg(F.min("doc_id").alias("first"))
    joined = common.connected_components(links(fps.select("fp"), max_distance))
    named = fps.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.select("fp", "component").join(least, "component").select("fp", "component_id")
    return own.join(named, "fp").select("doc_id", "fp", "component_id")


def op6_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each component: the one with the smallest doc_id; of rows that repeat it, the one with the smallest
    hash of its text.

    So rows of different texts that share an id, and belong to different components, all have a say in their own one.
    Rows that are equal in both count as one document, and of those the one stays whose columns come first as JSON. Rows
    without a doc_id cannot be named as members of a component and stay.
    """
    known = docs.where("doc_id IS NOT NULL")
    own = common.written(fingerprints(known, text_hash=True), "simhash")
    joined = common.connected_components(links(own.select("fp").distinct(), MAX_DISTANCE)).withColumnRenamed("node", "fp")
    named = own.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    first = named.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("first")).select(
        F.col("first.doc_id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash"))
    first = common.written(first.distinct(), "simhash-kept")
    # the row travels in one column, so that its names can't clash with those used here
    rows = known.select(F.col("doc_id").cast("long").alias("own_id"), F.xxhash64("text").alias("own_hash"), F.struct(*docs.columns).alias("row"))
    same = (F.col("own_id") == F.col("kept_id")) & (F.col("own_hash") == F.col("kept_hash"))
    kept = rows.join(common.broadcast_if_small(first, 32), same, "left_semi")
    if own.groupBy("doc_id", "text_hash").count().where("count > 1").head(1):
        place = F.row_number().over(Window.partitionBy("own_id", "own_hash").orderBy(F.to_json("row")))
        kept = kept.withColumn("place", place).where("place = 1")
    return kept.select("row.*").unionByName(docs.where("doc_id IS NULL"))
