"""Token-id files with keyed access through a minimal perfect hash (operator 10).

A dataset is a folder of shards in ascending key order. Shard ``p-s`` (range partition p, s-th shard of it) has

* ``p-s.ids``: the raw ids of its documents one after the other, little-endian, two bytes each if the vocabulary
  allows, else four;
* ``p-s.mph``: a minimal perfect hash of the document keys: levels of bit maps, and by slot the key's fingerprint (32
  bits of another hash), the place of its first id and the number of its ids.

A look-up hashes the key down the levels (1.6 on average), compares the fingerprint, and reads one range of the
payload. Rows that repeat a doc_id have the keys (doc_id, 0), (doc_id, 1), ... in order of their texts; a null doc_id
sorts first. Null and empty texts consist of the end id alone.

Files are written under a name of the task attempt and renamed when complete, so a lost executor leaves no half shard;
the manifest lists only the shards of the attempts that succeeded.
"""

from __future__ import annotations

import io
import struct
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mobspark.llm import common
from mobspark.llm.bpe import WordEncoder, byte_characters, default_tokenizer, groups, vocabulary

#: Ids in a shard, after which the next document opens a new one. The manifest has a row for each shard: some 400,000 for
#: 100 TB of text.
SHARD_IDS = 64_000_000
#: Ids that a task reads back.
READ_IDS = 16_000_000
END_ID = 0
MAGIC = b"MPHIDX01"
GAMMA = 2.0

MANIFEST = "partition int, shard int, path string, width int, first_null boolean, first_id long, documents long, ids long"


class _Remembered(dict):
    """Ids by word; a word that isn't there yet is encoded when it is asked for."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = self.make(word)
        return ids


class LibraryEncoder(WordEncoder):
    """Words that are not remembered go to the BPE model of the tokenizers library, in the characters that stand for
    their bytes."""

    remembered = 600_000

    def __init__(self, path: str, special: tuple[tuple[str, int], ...] | None = None):
        """``special``: the added tokens and their ids, if they are known, so that the file is read by the library alone."""
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path).model
        self.shown = dict(enumerate(byte_characters()))
        self.blank = self.shown[0x20]
        super().__init__(vocabulary(path).special if special is None else dict(special))

    def encode_word(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():  # all but the blank stand for themselves
            shown = word.replace(" ", self.blank)
        else:
            shown = word.encode("utf-8", "replace").decode("latin-1").translate(self.shown)
        tokens = self.model.tokenize(shown)
        return array("i", [t.id for t in tokens]).tobytes()

    def encode_words(self, words: list[str]) -> Iterator[bytes]:
        return map(self.encode_word, words)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if not self.memory or len(self.memory) > self.remembered:
            self.memory = _Remembered(self.encode_word)
            self.memory.update(self.special)
        get = self.memory.__getitem__
        return [b"".join(map(get, self.words(t))) if t else b"" for t in texts]


@lru_cache(maxsize=2)
def library_encoder(path: str, special: tuple[tuple[str, int], ...] | None = None) -> LibraryEncoder:
    return LibraryEncoder(path, special)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser of x under a seed."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))).astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def key_hash(doc_id: np.ndarray, nth: np.ndarray, null: np.ndarray) -> np.ndarray:
    """A 64-bit bijection of doc_id, changed by the number of the repeat and by nullness."""
    out = _mix(doc_id.astype(np.int64).view(np.uint64), 0)
    again = nth > 0
    out[again] = _mix(out[again] ^ _mix(nth[again].astype(np.uint64), 1), 2)
    out[null] = _mix(nth[null].astype(np.uint64), 3)
    return out


class PerfectHash:
    """Levels of bit maps; a key's slot is the rank of its bit in the first level where it stands alone."""

    def __init__(self, levels: list[np.ndarray], sizes: list[int]):
        self.levels, self.sizes = levels, sizes
        ones = [np.bitwise_count(x).astype(np.int64) for x in levels]
        flat = np.concatenate([np.zeros(1, np.int64), *ones]) if ones else np.zeros(1, np.int64)
        total = np.cumsum(flat)
        ends = np.cumsum([0, *map(len, levels)])
        self.before = [total[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    @staticmethod
    def build(keys: np.ndarray) -> PerfectHash:
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two keys of a shard have the same 64-bit hash")
        levels, sizes, rest = [], [], keys
        while len(rest):
            size = max(64, int(GAMMA * len(rest)) + 63 & ~63)
            at = _mix(rest, 16 + len(levels)) % np.uint64(size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            rest = rest[~alone[at.astype(np.int64)]]
        return PerfectHash(levels, sizes)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot or -1 for keys that were not given to build()."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for k, (level, size, before) in enumerate(zip(self.levels, self.sizes, self.before, strict=True)):
            if not len(open_):
                break
            at = (_mix(keys[open_], 16 + k) % np.uint64(size)).astype(np.int64)
            words, bits = level[at >> 6], (at & 63).astype(np.uint64)
            hit = (words >> bits) & np.uint64(1) == 1
            lower = words[hit] & ((np.uint64(1) << bits[hit]) - np.uint64(1))
            out[open_[hit]] = before[at[hit] >> 6] + np.bitwise_count(lower)
            open_ = open_[~hit]
        return out


def index_bytes(keys: np.ndarray, offsets: np.ndarray, counts: np.ndarray) -> bytes:
    perfect = PerfectHash.build(keys)
    slot = perfect.slots(keys)
    prints, begin, count = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint64)
    prints[slot] = (_mix(keys, 7) >> np.uint64(32)).astype(np.uint32)
    begin[slot], count[slot] = offsets, counts
    out = io.BytesIO()
    out.write(MAGIC + struct.pack("<QQ", len(keys), len(perfect.levels)))
    out.write(struct.pack(f"<{len(perfect.sizes)}Q", *perfect.sizes))
    for x in (*perfect.levels, prints, begin, count):
        out.write(x.astype(x.dtype.newbyteorder("<")).tobytes())
    return out.getvalue()


class ShardIndex:
    """The index of one shard, as read from its file."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("no index file")
        n, depth = struct.unpack_from("<QQ", raw, 8)
        sizes = list(struct.unpack_from(f"<{depth}Q", raw, 24))
        at = 24 + 8 * depth

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, count, at)
            at += out.nbytes
            return out

        self.perfect = PerfectHash([take("<u8", s // 64) for s in sizes], sizes)
        self.prints, self.begin, self.count = take("<u4", n), take("<u8", n), take("<u8", n)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, place of the first id, number of ids) of each key."""
        slot = self.perfect.slots(keys)
        found = slot >= 0
        slot = np.where(found, slot, 0)
        if not len(self.prints):
            return found, slot, slot
        found &= self.prints[slot] == (_mix(keys, 7) >> np.uint64(32)).astype(np.uint32)
        return found, self.begin[slot].astype(np.int64), self.count[slot].astype(np.int64)


def _open(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class _ShardWriter:
    def __init__(self, folder: str, partition: int, shard: int, width: int, attempt: int):
        self.name, self.width = f"{partition:05d}-{shard:05d}", width
        self.files, self.root = _open(folder)
        self.partition, self.shard, self.folder = partition, shard, folder
        self.draft = f"{self.root}/.{self.name}.{attempt}"
        self.out = self.files.open_output_stream(f"{self.draft}.ids")
        self.keys: list[tuple[int, int, bool]] = []
        self.counts: list[int] = []
        self.ids = 0

    def add(self, key: tuple[int, int, bool], ids: np.ndarray) -> None:
        self.out.write(ids.astype("<u2" if self.width == 2 else "<u4").tobytes())
        self.keys.append(key)
        self.counts.append(len(ids))
        self.ids += len(ids)

    def close(self) -> tuple:
        self.out.close()
        doc, nth, null = (np.array(x) for x in zip(*self.keys, strict=True))
        counts = np.array(self.counts, np.uint64)
        with self.files.open_output_stream(f"{self.draft}.mph") as f:
            f.write(index_bytes(key_hash(doc, nth, null.astype(bool)), np.cumsum(counts) - counts, counts))
        for kind in ("ids", "mph"):
            self.files.move(f"{self.draft}.{kind}", f"{self.root}/{self.name}.{kind}")
        first = self.keys[0]
        return self.partition, self.shard, f"{self.folder}/{self.name}", self.width, first[2], first[0], len(counts), self.ids


def write_shards(
    df: DataFrame, folder: str, key: str = "doc_id", text: str = "text", tokenizer: str | None = None,
    end_id: int = END_ID, shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """Encode ``text`` and write it in ascending order of ``key`` (long); the manifest, one row for each shard.

    Rows are dealt by ranges of the key, a range is written as a stream and split into shards between keys.
    """
    spark = df.sparkSession
    common.ship_package(spark)
    path = tokenizer or default_tokenizer()
    width = 2 if vocabulary(path).size <= 1 << 16 and end_id < 1 << 16 else 4
    special = tuple(vocabulary(path).special.items())
    files, root = _open(folder)
    files.create_dir(root, recursive=True)
    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        encoder, writer, made = library_encoder(path, special), None, []
        last, nth = None, 0
        end = np.array([end_id], np.int32)
        # texts of a slice only at a time, so that a batch of long documents stays small
        for part in (batch.slice(a, 512) for batch in batches for a in range(0, len(batch), 512)):
            docs, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
            for a, b in groups(texts):
                for doc, raw in zip(docs[a:b], encoder.encode(texts[a:b]), strict=True):
                    again = last is not None and last[0] == doc
                    nth = nth + 1 if again else 0
                    if writer is None or (writer.ids >= shard_ids and not again):
                        if writer:
                            made.append(writer.close())
                        writer = _ShardWriter(folder, context.partitionId(), len(made), width, context.taskAttemptId())
                    writer.add((doc or 0, nth, doc is None), np.concatenate([np.frombuffer(raw, np.int32), end]))
                    last = (doc,)
        if writer:
            made.append(writer.close())
        if made:
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
            names = [x.split()[0] for x in MANIFEST.split(", ")]
            columns = [pa.array(x, k) for x, k in zip(zip(*made, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    manifest = rows.mapInArrow(run, MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


@lru_cache(maxsize=1)
def _shard(path: str) -> ShardIndex:
    files, root = _open(path)
    with files.open_input_stream(f"{root}.mph") as f:
        return ShardIndex(f.read())


def read_by_key(manifest: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Look up every row of ``keys``: doc_id, nth, start (ids of all documents before it), n_tokens, ids (binary, 32 bits
    each, little-endian). Keys that the files don't have get no row; a key that repeats reads its repeats.

    A key's shard follows from the first keys of all shards (16 bytes a shard in each task; a shard holds millions of
    ids, so the list stays small at any size). The rest is one index look-up and one range read for each key.
    """
    spark = keys.sparkSession
    common.ship_package(spark)
    shards = manifest.orderBy("partition", "shard").collect()
    order = sorted(range(len(shards)), key=lambda i: (shards[i]["partition"], shards[i]["shard"]))
    shards = [shards[i] for i in order]
    paths, widths = [s["path"] for s in shards], [s["width"] for s in shards]
    lowest = np.iinfo(np.int64).min
    firsts = np.array([lowest if s["first_null"] else s["first_id"] for s in shards], np.int64)
    before = np.concatenate([[0], np.cumsum([s["ids"] for s in shards])]).astype(np.int64)
    # a shard that begins with null may also hold the smallest keys; nulls all stand in the first shard
    numbered = keys.select(F.col(key).cast("long").alias("doc_id")).groupBy("doc_id").count()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0)
            null = np.asarray(docs.is_null())
            value = np.asarray(docs.fill_null(0).cast(pa.int64()))
            at = np.maximum(np.searchsorted(firsts, value, side="right") - 1, 0)
            at[null] = 0
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), docs, batch.column(1)], names=["at", "doc_id", "count"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.asarray(batch.column(0))
            docs, counts = batch.column(1), np.asarray(batch.column(2))
            null = np.repeat(np.asarray(docs.is_null()), counts)
            value = np.repeat(np.asarray(docs.fill_null(0)), counts)
            nth = np.arange(len(value)) - np.repeat(np.cumsum(counts) - counts, counts)
            at = np.repeat(at, counts)
            hashes = key_hash(value, nth, null)
            for shard in np.unique(at):
                rows = np.flatnonzero(at == shard)
                found, begin, count = _shard(paths[shard]).find(hashes[rows])
                rows, begin, count = rows[found], begin[found], count[found]
                order = np.argsort(begin, kind="stable")
                files, root = _open(paths[shard])
                with files.open_input_file(f"{root}.ids") as f:
                    for part in np.array_split(order, max(1, int(count.sum()) // 1_000_000)):
                        yield _payloads(f, widths[shard], value, nth, null, rows[part], begin[part], count[part], before[shard])

    def _payloads(f, width, value, nth, null, rows, begin, count, base) -> pa.RecordBatch:
        kind = "<u2" if width == 2 else "<u4"
        raw = [np.frombuffer(f.read_at(int(n) * width, int(b) * width), kind).astype("<u4").tobytes() for b, n in zip(begin, count, strict=True)]
        return pa.RecordBatch.from_arrays([
            pa.array(value[rows], pa.int64(), mask=null[rows]), pa.array(nth[rows], pa.int64()), pa.array(begin + base, pa.int64()),
            pa.array(count, pa.int64()), pa.array(raw, pa.binary()),
        ], names=["doc_id", "nth", "start", "n_tokens", "ids"])

    if not shards:
        return spark.createDataFrame([], "doc_id long, nth long, start long, n_tokens long, ids binary")
    routed = numbered.mapInArrow(route, "at int, doc_id long, count long")
    # keys are few bytes, the payloads that they stand for are not
    tasks = max(1, -(-int(before[-1]) // READ_IDS))
    dealt = routed.repartitionByRange(tasks, F.col("at"), F.col("doc_id")).sortWithinPartitions("at", "doc_id")
    return dealt.mapInArrow(read, "doc_id long, nth long, start long, n_tokens long, ids binary")


def crc32(df: DataFrame) -> DataFrame:
    """Unsigned crc32 of the ids read, added as ids_crc32."""
    return df.withColumn("ids_crc32", F.crc32("ids"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents' ids, read every document back by its key, and digest what was read."""
    documents = common.table(spark, sf_dir, "documents")
    folder = common.new_folder(spark, "token-files")
    manifest = write_shards(documents.select("doc_id", "text"), folder)
    return crc32(read_by_key(manifest, documents)).select("doc_id", "start", "n_tokens", "ids_crc32")
