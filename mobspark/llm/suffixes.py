"""Removal of repeated passages by blockwise suffix sorting with a difference cover (operator 2).

Every byte covered by a ``length``-byte string that also starts earlier (smaller doc_id, or the same document and an
earlier start) is marked, for texts as UTF-8 bytes; strings are judged on the input, and never cross documents.

1. Of documents with equal bytes only the first is searched; the others go whole, if they have ``length`` bytes.
2. A ``length``-byte window belongs to the bucket of its least hashed 32-byte string. Neighbouring windows that share it
   form a run, which is one row: bucket, a hash of the run's bytes, document, place. Of runs with equal bytes in a
   bucket all but the first are repeated whole. If a bucket then holds one run, nothing else of it repeats.
3. The other runs, which lie at the edges of repeated passages, are fetched as bytes and sorted bucket by bucket: the
   windows are suffixes of the run's bytes, ordered by their first ``COVER`` bytes; longer ties are resolved by the ranks
   of the difference-cover sample, which are precomputed by doubling within the sample. So a sort never compares more
   than COVER bytes and its memory is bounded by the block. Neighbours that agree in ``length`` bytes are equal.
4. Windows of buckets with very many runs are grouped by their bytes, by Spark, which combines copies within each task and
   can split a group in the join that marks all copies but the first; no task holds the copies of a window.

Shipping runs instead of suffixes keeps what is shuffled at about a fortieth of the corpus's windows.

Null texts are empty. Documents without a doc_id come before all others. Rows that repeat a doc_id with different texts
stand in order of the texts' hashes; rows that are equal in both are one document.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mobspark.llm import common

LENGTH = 100
GRAM = 32
COVER = 32
#: Longest ``length`` that the content hash of runs covers.
LONGEST = 3 * GRAM + GRAM // 2
#: Bytes of text that a worker hashes at once.
CHUNK = 1 << 20
#: Working memory of a block of runs that is sorted at once, and how much of it a byte of a run's slot takes: the byte, its
#: rank, the cover sample's words, orders and ranks, and the keys of the windows.
BLOCK = 96 << 20
WORK_PER_BYTE = 52
#: Runs of one bucket beyond which its windows are dealt out.
HOT_RUNS = 5000

_random = np.random.default_rng(20250101)
BYTE_CODES = _random.integers(0, 2**64, 256, dtype=np.uint64)
FACTORS = _random.integers(0, 2**64, 8, dtype=np.uint64) | np.uint64(1)
POSITION_BITS = np.uint64(24)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def doubled(h: np.ndarray, span: int, factor: np.uint64) -> np.ndarray:
    """Hashes of strings of twice the length ``span``."""
    return h[:-span] * factor + h[span:] if len(h) > span else h[:0]


def window_runs(data: np.ndarray, valid: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(begin, windows - 1, anchor - begin, bucket, content) of the runs of windows; valid: windows inside a document."""
    h, span = BYTE_CODES[data], 1
    while span < GRAM:
        h = doubled(h, span, FACTORS[span.bit_length() - 1])
        span *= 2
    grams, wide = mixed(h), doubled(h, GRAM, FACTORS[6])
    width = length - GRAM + 1
    mask = (np.uint64(1) << POSITION_BITS) - np.uint64(1)
    value = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        value = np.minimum(value[:-span], value[span:])
        span *= 2
    if span < width:
        value = np.minimum(value[:len(value) - (width - span)], value[width - span:])
    anchor = (value & mask).astype(np.int64)[:len(valid)]
    change = np.ones(len(valid), bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
    begin = np.flatnonzero(change)
    end = np.r_[begin[1:], len(valid)]
    good = valid[begin]
    begin, end = begin[good], end[good]
    at = anchor[begin]
    more, size = end - begin - 1, end - begin - 1 + length
    with np.errstate(over="ignore"):
        content = mixed(wide[begin]) * FACTORS[1] + mixed(wide[begin + (size - 2 * GRAM) // 2] ^ FACTORS[2])
        content = mixed(content * FACTORS[3] + mixed(wide[begin + size - 2 * GRAM]) + (size * 1024 + at - begin).astype(np.uint64) * FACTORS[4])
    return begin, more, at - begin, grams[at].view(np.int64), content.view(np.int64)


def document_runs(docs: Iterable[tuple[int, bytes]], length: int) -> Iterator[list[np.ndarray]]:
    """(bucket, content, doc_no, run, known) columns of all runs. Small documents are hashed together, large ones in parts.

    Of runs with equal bytes in one chunk all but the first are known to be repeated; they get a bucket at random, so that
    what is frequent meets in its bucket only once for each chunk.

    run packs the place: begin << 16 | (windows - 1) << 8 | (anchor - begin).
    """
    held: list[tuple[int, int, bytes]] = []  # doc_no, place of the part in its document, bytes
    size = 0

    def flush() -> list[np.ndarray]:
        data = np.frombuffer(b"".join(x[2] for x in held), np.uint8)
        sizes = np.array([len(x[2]) for x in held])
        first = np.cumsum(sizes) - sizes
        windows = len(data) - length + 1
        last = np.repeat(first + sizes - length, sizes)[:windows]
        begin, more, off, bucket, content = window_runs(data, np.arange(windows) <= last, length)
        part = np.searchsorted(first, begin, side="right") - 1
        place = begin - first[part] + np.array([x[1] for x in held])[part]
        doc, run = np.array([x[0] for x in held])[part], place << 16 | more << 8 | off
        order = np.lexsort((run, doc, content, bucket))
        known = np.zeros(len(run), bool)
        known[order[1:]] = (bucket[order[1:]] == bucket[order[:-1]]) & (content[order[1:]] == content[order[:-1]])
        scattered = mixed(doc.astype(np.uint64) * FACTORS[0] + run.astype(np.uint64)).view(np.int64)
        return [np.where(known, scattered, bucket), content, doc, run, known]

    for doc, raw in docs:
        for a in range(0, len(raw) - length + 1, CHUNK):
            part = raw[a:a + CHUNK + length - 1]
            held.append((doc, a, part))
            size += len(part)
            if size >= CHUNK:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def difference_cover(period: int) -> np.ndarray:
    """Residues of which some two differ by any given number modulo ``period``, found greedily."""
    cover, open_ = [0], set(range(1, period))
    while open_:
        best = max(range(period), key=lambda x: (len({d for c in cover for d in ((x - c) % period, (c - x) % period)} & open_), -x))
        open_ -= {d for c in cover for d in ((best - c) % period, (c - best) % period)}
        cover.append(best)
    return np.array(sorted(cover))


def common_steps(cover: np.ndarray, period: int) -> np.ndarray:
    """For residues i, j the least step that takes both into the cover."""
    inside = np.zeros(period, bool)
    inside[cover] = True
    out = np.full((period, period), -1, np.int64)
    for step in range(period - 1, -1, -1):
        i = np.arange(period)
        out[np.ix_(i, i)] = np.where(np.outer(inside[(i + step) % period], inside[(i + step) % period]), step, out)
    return out


def dense_ranks(keys: list[np.ndarray]) -> np.ndarray:
    """Ranks, from 0, of rows under the keys, the first key most significant; equal rows share one."""
    order = np.lexsort(keys[::-1])
    step = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        step[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(step)
    return out


def words_at(data: np.ndarray, at: np.ndarray, count: int) -> list[np.ndarray]:
    """``count`` big-endian 8-byte words from every place."""
    swept = np.lib.stride_tricks.sliding_window_view(data, 8)
    return [np.ascontiguousarray(swept[at + 8 * k]).view(">u8").ravel().astype(np.uint64) for k in range(count)]


def sample_ranks(data: np.ndarray, cover: np.ndarray, longest: int) -> np.ndarray:
    """Ranks of the strings of ``longest`` bytes at least at the places of the cover sample; -1 elsewhere.

    The sample holds a place COVER bytes on with every place, so ranks double within it. ``data`` is padded.
    """
    places = (np.arange(0, len(data) - longest - 2 * COVER, COVER)[:, None] + cover[None, :]).ravel()
    rank = np.full(len(data), -1, np.int64)
    rank[places] = dense_ranks(words_at(data, places, COVER // 8))
    span = COVER
    while span < longest:
        rank[places] = dense_ranks([rank[places], rank[np.minimum(places + span, len(data) - 1)]])
        span *= 2
    return rank


_COVER = difference_cover(COVER)
_STEPS = common_steps(_COVER, COVER)


def slot_bytes(longest: int) -> int:
    """Room for a run of ``longest`` bytes in a block."""
    return (longest + 4 * COVER) // COVER * COVER


def repeated_windows(bucket: np.ndarray, doc: np.ndarray, place: np.ndarray, more: np.ndarray, off: np.ndarray, raw: list[bytes],
                     length: int) -> Iterator[tuple[int, int, int]]:
    """(doc, begin, end) of the bytes of runs whose windows also start in an earlier run of the block."""
    longest = max(map(len, raw))
    # each run stands so that its anchor falls on a multiple of COVER: windows that can be equal have equal residues
    slot = slot_bytes(longest)
    home = np.arange(len(raw)) * slot + (2 * COVER + length) // COVER * COVER
    data = np.zeros(int(home[-1]) + slot + 2 * longest + 8 * COVER, np.uint8)
    start = home - off
    for s, r in zip(start.tolist(), raw, strict=True):
        data[s:s + len(r)] = np.frombuffer(r, np.uint8)
    run = np.repeat(np.arange(len(raw)), more + 1)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
    at = start[run] + nth
    rank = sample_ranks(data, _COVER, longest)
    back = off[run] - nth  # from the window's begin to its anchor
    residue = at % COVER
    tie = rank[at + _STEPS[residue, residue]]
    keys = [bucket[run].view(np.uint64), (back + length).astype(np.uint64), *words_at(data, at, COVER // 8), tie.astype(np.uint64)]
    order = np.lexsort(keys[::-1])
    # neighbours that agree in the bucket, in the anchor's place and in all bytes
    a, b = order[:-1], order[1:]
    same = (keys[0][a] == keys[0][b]) & (keys[1][a] == keys[1][b])
    for k in range(0, length - 7, 8):
        close = np.flatnonzero(same)
        same[close] &= words_at(data, at[a[close]] + k, 1)[0] == words_at(data, at[b[close]] + k, 1)[0]
    close = np.flatnonzero(same)
    same[close] &= words_at(data, at[a[close]] + length - 8, 1)[0] == words_at(data, at[b[close]] + length - 8, 1)[0]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(np.r_[True, ~same]) - 1
    where = place[run] + nth
    first = np.lexsort((where, doc[run], group))
    head = np.r_[True, group[first][1:] != group[first][:-1]]
    repeat = np.ones(len(run), bool)
    repeat[first[head]] = False
    edge = np.diff(np.r_[False, repeat, False].astype(np.int8))
    # stretches of repeated windows, cut where a run ends
    cut = np.flatnonzero(repeat & (np.r_[True, run[1:] != run[:-1]] | (edge[:-1] == 1)))
    ends = np.flatnonzero(repeat & (np.r_[run[1:] != run[:-1], True] | (edge[1:] == -1)))
    for x, y in zip(cut.tolist(), ends.tolist(), strict=True):
        yield int(doc[run[x]]), int(where[x]), int(where[y]) + length


RUN = "bucket long, content long, doc_no long, run long"
SPAN = "doc_no long, span_begin long, span_end long"


def _batch(kinds: str, columns: list) -> pa.RecordBatch:
    types = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    spec = [x.split() for x in kinds.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, (_, k) in zip(columns, spec, strict=True)], names=[n for n, _ in spec])


def numbered(docs: DataFrame) -> DataFrame:
    """(digest, first_id, doc_no) of the distinct texts: the first document of each, numbered in the order of documents."""
    first = docs.groupBy("digest").agg(F.min(F.struct("doc_id")).alias("f")).select("digest", F.col("f.doc_id").alias("first_id"))
    dealt = first.repartitionByRange(F.col("first_id").asc_nulls_first(), "digest")
    dealt = dealt.sortWithinPartitions(F.col("first_id").asc_nulls_first(), "digest")
    return common.written(dealt.withColumn("doc_no", F.monotonically_increasing_id()), "suffix-documents")


def runs(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ((n, t.encode("utf-8", "replace")) for n, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            for columns in document_runs(texts, length):
                yield _batch(f"{RUN}, known boolean", columns)

    return docs.select("doc_no", "text").mapInArrow(run, f"{RUN}, known boolean")


def sifted(found: DataFrame) -> DataFrame:
    """Runs that are repeated whole (whole), and the first runs of each content in buckets that hold several.

    Rows come sorted by bucket, content and place, and pass as a stream; the first run of a bucket is held back until a
    second content shows.
    """
    dealt = found.repartition("bucket").sortWithinPartitions("bucket", "content", "doc_no", "run")
    kinds = f"{RUN}, whole boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the last row
        lead, several = None, False  # the first row of its bucket; the bucket showed several contents
        for batch in batches:
            known = np.asarray(batch.column(4).cast(pa.int8())) == 1
            rows = np.stack([np.asarray(c) for c in batch.columns[:4]], axis=1)
            if known.any():
                yield _batch(kinds, [*rows[known].T, np.ones(int(known.sum()), bool)])
                rows = rows[~known]
            if not len(rows):
                continue
            goes_on = before is not None
            if goes_on:
                rows = np.concatenate([before[None], rows])
            new_bucket, new_content = np.ones(len(rows), bool), np.ones(len(rows), bool)
            new_bucket[1:] = rows[1:, 0] != rows[:-1, 0]
            new_content[1:] = new_bucket[1:] | (rows[1:, 1] != rows[:-1, 1])
            group, first = np.cumsum(new_bucket) - 1, np.flatnonzero(new_bucket)
            leads = rows[first]
            many = np.zeros(len(first), bool)
            if goes_on:
                leads[0], many[0] = lead, several
                new_content[0] = False
            many[group[new_content & ~new_bucket]] = True
            whole = ~new_content
            whole[0] &= not goes_on
            firsts = rows[new_content & many[group]]
            late = goes_on and many[0] and not several
            firsts = np.concatenate([lead[None], firsts]) if late else firsts
            out = np.concatenate([rows[whole], firsts])
            if len(out):
                yield _batch(kinds, [*out.T, np.arange(len(out)) < int(whole.sum())])
            last = int(group[-1])
            before, lead, several = rows[-1], leads[last], bool(many[last])

    return dealt.mapInArrow(run, kinds)


def edge_bytes(edges: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """The bytes of edge runs: bucket, doc_no, run, raw."""
    kinds = "bucket long, doc_no long, run long, raw binary"
    of_doc = common.written(
        edges.groupBy("doc_no").agg(F.collect_list("bucket").alias("buckets"), F.collect_list("run").alias("own")), "suffix-edges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, buckets, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode("utf-8", "replace")
                parts = [raw[r >> 16:(r >> 16) + (r >> 8 & 255) + length] for r in own]
                yield _batch(kinds, [buckets, [doc] * len(own), own, parts])

    joined = docs.select("doc_no", "text").join(common.broadcast_if_small(of_doc, 24), "doc_no")
    return joined.select("doc_no", "text", "buckets", "own").mapInArrow(run, kinds)


def edge_spans(edges: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """Repeated bytes within edge runs."""
    counts = edges.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_RUNS)
    hot = common.written(counts.select("bucket"), "suffix-hot")
    if not hot.head(1):
        return plain_spans(edges, docs, length)
    few = common.broadcast_if_small(hot, 16)
    plain = plain_spans(edges.join(few, "bucket", "left_anti"), docs, length)
    return plain.union(hot_spans(edges.join(few, "bucket", "left_semi"), docs, length))


def hot_spans(edges: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """Repeated windows of buckets with very many runs: all but the first of equal bytes and anchor."""
    rows = common.written(edge_bytes(edges, docs, length), "suffix-hot-runs")
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.expr("cast((run >> 8) & 255 as int)"))))
    windows = rows.select(
        "bucket", (F.expr("run & 255") - F.col("k")).alias("off"), F.expr(f"substring(raw, k + 1, {length})").alias("raw"),
        F.struct("doc_no", (F.expr("run >> 16") + F.col("k")).alias("place")).alias("at"))
    keys = ["bucket", "off", "raw"]
    first = windows.groupBy(*keys).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    first = common.written(first, "suffix-hot-first")
    again = windows.join(common.broadcast_if_small(first, 24), keys).where("at <> first")
    return again.select(
        F.col("at.doc_no").alias("doc_no"), F.col("at.place").alias("span_begin"), (F.col("at.place") + length).alias("span_end"))


def plain_spans(edges: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """Repeated bytes within runs of buckets of bounded size, by sorting."""
    begin, more, off = F.expr("run >> 16"), F.expr("(run >> 8) & 255"), F.expr("run & 255")
    rows = edge_bytes(edges, docs, length).select("bucket", "doc_no", begin.alias("place"), more.alias("more"), off.alias("off"), "raw")
    dealt = rows.repartition("bucket").sortWithinPartitions("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        # a run has at most 2 * length - GRAM bytes, a bucket at most HOT_RUNS runs
        most = max(1, BLOCK // (WORK_PER_BYTE * slot_bytes(2 * length - GRAM)))
        size = 0
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                held.append(batch.slice(a, 1000))
                size += len(held[-1])
                if size >= most:
                    table = pa.Table.from_batches(held).combine_chunks()
                    key = table.column("bucket").to_numpy()
                    cut = int(np.argmax(key == key[-1]))
                    if cut:
                        yield from spans(table.slice(0, cut))
                        held = table.slice(cut).to_batches()
                        size = sum(map(len, held))
        if held:
            yield from spans(pa.Table.from_batches(held).combine_chunks())

    def spans(table: pa.Table) -> Iterator[pa.RecordBatch]:
        key, doc, place, more, off = (table.column(k).to_numpy() for k in ("bucket", "doc_no", "place", "more", "off"))
        # single runs of a bucket have nothing to meet
        change = np.r_[True, key[1:] != key[:-1]]
        group = np.cumsum(change) - 1
        several = np.bincount(group)[group] > 1
        if not several.any():
            return
        raw = [table.column("raw")[int(i)].as_py() for i in np.flatnonzero(several)]
        found = list(repeated_windows(group[several], doc[several], place[several], more[several], off[several], raw, length))
        if found:
            yield _batch(SPAN, list(zip(*found, strict=True)))

    return dealt.mapInArrow(run, SPAN)


def merged(begins: list[int], ends: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in sorted(zip(begins, ends, strict=True)):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((b, e))
    return out


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """(doc_no, begins, ends): the merged repeated stretches of each document that has some; docs: doc_no, text."""
    found = common.written(sifted(runs(docs, length)), "suffix-runs")
    whole = found.where("whole").select(
        "doc_no", F.expr("run >> 16").alias("span_begin"), F.expr(f"(run >> 16) + ((run >> 8) & 255) + {length}").alias("span_end"))
    part = common.written(edge_spans(found.where("NOT whole"), docs, length), "suffix-spans")
    both = whole.union(part).groupBy("doc_no").agg(F.collect_list("span_begin").alias("b"), F.collect_list("span_end").alias("e"))
    kinds = "doc_no long, begins array<long>, ends array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [merged(b, e) for b, e in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([[x[0] for x in s] for s in spans], lists), pa.array([[x[1] for x in s] for s in spans], lists)],
                names=["doc_no", "begins", "ends"])

    return common.written(both.mapInArrow(run, kinds), "suffix-merged")


def remove_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept): the stretches [begin, end) that go and the bytes that stay, for each row."""
    # the content hash covers three stretches of 2 * GRAM bytes of a run, which has 2 * length - GRAM bytes at most
    if not 2 * GRAM <= length <= LONGEST:
        raise ValueError(f"length has to be from {2 * GRAM} to {LONGEST}")
    common.ship_package(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    distinct = numbered(rows.select("doc_id", "digest"))
    joined = rows.join(common.broadcast_if_small(distinct, 32), "digest")
    first = F.col("doc_id").eqNullSafe(F.col("first_id"))
    # rows that are equal in doc_id and text are searched once for each of them, with the same result
    searched = joined.where(first & (F.length(F.col("text").cast("binary")) >= length)).select("doc_no", "text")
    spans = repeated_spans(searched.dropDuplicates(["doc_no"]) if _repeats(rows) else searched, length)
    told = joined.select("doc_id", "text", first.alias("is_first"), "doc_no").join(common.broadcast_if_small(spans, 32), "doc_no", "left")
    kinds = "doc_id long, n_bytes long, n_removed long, spans array<struct<begin: long, end: long>>, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, is_first, begins, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode("utf-8", "replace")
                spans = list(zip(begins or [], ends or [], strict=True))
                if not is_first:
                    spans = [(0, len(raw))] if len(raw) >= length else []
                kept, at = [], 0
                for b, e in spans:
                    kept.append(raw[at:b])
                    at = e
                kept.append(raw[at:])
                out.append((doc, len(raw), sum(e - b for b, e in spans), [{"begin": b, "end": e} for b, e in spans], b"".join(kept)))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.binary()]
            names = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return told.select("doc_id", "text", "is_first", "begins", "ends").mapInArrow(run, kinds)


def _repeats(rows: DataFrame) -> bool:
    """Whether rows are equal in doc_id and text."""
    twice = rows.groupBy("doc_id", "digest").count().where("count > 1")
    return bool(twice.head(1))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without passages of 100 bytes or more that stand earlier."""
    out = remove_repeats(common.table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
