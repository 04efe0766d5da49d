"""Byte-level BPE encoding and decoding by batched merge rounds (operator 9).

A text is cut into words by the tokenizer's pattern; their tokens do not depend on their surroundings. The symbols of
all words that a worker has not met yet stand in one flat array. A round looks up every adjacent pair by binary search over the sorted pair keys, finds the lowest rank of each
word and merges all its occurrences; rounds go on until no word has a known pair. Learned vocabularies are read from a
tokenizer file and never trained.

Null and empty texts have no tokens. An existing column of the result's name is replaced; other columns pass through.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobspark.llm import common

TOKENIZER = "byte_bpe_50k.json"
#: Words that a worker remembers; beyond it the memory starts afresh, which costs time only.
REMEMBERED_WORDS = 250_000
#: Characters of text that are handled together in a worker.
GROUP_CHARS = 500_000

# fixed values: the word pattern of the byte-level pre-tokenizer, and Unicode's white space
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNK = re.compile(f" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+")
# the word pattern in Python's classes, letters first as most words are that; right where plain() holds
PLAIN_WORD = re.compile(r" ?[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)| ?\d+| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+")

NEVER = np.iinfo(np.int32).max


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it prints, else 256 and up."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Pair ranks, ids and bytes of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.model = spec["model"]
        ids: dict[str, int] = self.model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that strip or need whole words are not supported")
        if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("only plain byte-level BPE files are supported")
        self.size = 1 + max([*ids.values(), *self.special.values()])
        shown = byte_characters()
        self.first = np.array([ids[c] for c in shown], dtype=np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in self.model["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([ids[a + b] for a, b in merges], dtype=np.int64)[order]
        back = {c: bytes([b]) for b, c in enumerate(shown)}
        self.bytes_of: list[bytes] = [b""] * self.size
        for token, i in [*ids.items(), *self.special.items()]:
            self.bytes_of[i] = b"".join(back.get(c) or c.encode() for c in token)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def pair_places(v: Vocabulary, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each pair (NEVER if unknown) and its place in the sorted keys."""
    wanted = left * v.size + right
    at = np.minimum(np.searchsorted(v.keys, wanted), len(v.keys) - 1)
    return np.where(v.keys[at] == wanted, v.ranks[at], NEVER), at


def merge_words(v: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words in one array, and where each word's ids begin (one more entry at the end)."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    symbols = v.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
    word = np.repeat(np.arange(len(words)), lengths)
    done_symbols, done_words = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    rank = np.full(len(symbols), NEVER, np.int32)
    place = np.zeros(len(symbols), np.int64)
    fresh = np.flatnonzero(word[:-1] == word[1:]) if len(word) else np.zeros(0, np.int64)
    while len(symbols):
        rank[fresh], place[fresh] = pair_places(v, symbols[fresh], symbols[fresh + 1])
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(word)]))
        live = best < NEVER
        if not live.all():
            done_symbols.append(symbols[~live])
            done_words.append(word[~live])
            symbols, word, rank, place, best = symbols[live], word[live], rank[live], place[live], best[live]
        at = np.flatnonzero(rank == best)
        if not len(at):
            break
        # in a run of overlapping occurrences every second one merges, from the left
        run = np.r_[True, np.diff(at) != 1]
        step = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]
        at = at[step % 2 == 0]
        symbols[at] = v.made[place[at]]
        kept = np.ones(len(symbols), bool)
        kept[at + 1] = False
        # the pair after a merged symbol, and the pair before it, are new
        touched = np.zeros(len(symbols), bool)
        touched[at] = True
        symbols, word, rank, place, touched = symbols[kept], word[kept], rank[kept], place[kept], touched[kept]
        touched[:-1] |= touched[1:]
        inner = np.r_[word[:-1] == word[1:], False]
        rank[touched & ~inner] = NEVER
        fresh = np.flatnonzero(touched & inner)
    symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
    order = np.argsort(word, kind="stable")
    return symbols[order].astype(np.int32), np.searchsorted(word[order], np.arange(len(words) + 1))


def words_of(text: str) -> list[str]:
    """The text's words by the tokenizer's pattern."""
    if plain(text):
        return PLAIN_WORD.findall(text)
    # the pattern's own white space isn't that of the tokenizer either, so it sees chunks only
    return [w for chunk in CHUNK.findall(text) for w in _words().findall(chunk)]


def plain(text: str) -> bool:
    """Whether Python's classes of letters, digits and white space are those of the tokenizer for this text."""
    return not _odd().search(text)


@lru_cache(maxsize=1)
def _odd() -> re.Pattern:
    """The separators 1C to 1F, white space to Python alone, and numbers that aren't decimal digits, to Python no digits;
    beyond the basic plane, any character."""
    numbers = [c for c in map(chr, range(1 << 16)) if c.isnumeric() and not (c.isdecimal() or c.isalpha())]
    return re.compile("[\x1c-\x1f" + "".join(numbers) + "\U00010000-\U0010ffff]")


@lru_cache(maxsize=1)
def _words():
    import regex

    return regex.compile(WORD_PATTERN)


class WordEncoder:
    """Texts to ids; ``encode_words`` is asked for words that are not remembered."""

    remembered = REMEMBERED_WORDS

    def __init__(self, special: dict[str, int]):
        self.memory: dict[object, bytes] = {}
        self.special = {("special", s): np.int32(i).tobytes() for s, i in special.items()}
        longest_first = sorted(special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if special else None

    def encode_words(self, words: list[str]) -> Iterable[bytes]:
        raise NotImplementedError

    def words(self, text: str) -> list:
        if self.cut and self.cut.search(text):
            out: list = []
            for k, part in enumerate(self.cut.split(text)):
                out += [("special", part)] if k % 2 else words_of(part)
            return out
        return words_of(text)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        cut = [self.words(t) if t else [] for t in texts]
        seen = set().union(*cut)
        if len(self.memory) > self.remembered:
            self.memory = {}
        if not self.memory:
            self.memory.update(self.special)
        missing = list(seen.difference(self.memory))
        if missing:
            self.memory.update(zip(missing, self.encode_words(missing), strict=True))
        get = self.memory.__getitem__
        return [b"".join(map(get, c)) for c in cut]


class MergeEncoder(WordEncoder):
    def __init__(self, path: str):
        self.vocabulary = vocabulary(path)
        super().__init__(self.vocabulary.special)

    def encode_words(self, words: list[str]) -> Iterable[bytes]:
        ids, starts = merge_words(self.vocabulary, [w.encode("utf-8", "replace") for w in words])
        raw, begin = ids.tobytes(), (4 * starts).tolist()
        return [raw[a:b] for a, b in pairwise(begin)]


@lru_cache(maxsize=2)
def merge_encoder(path: str) -> MergeEncoder:
    return MergeEncoder(path)


def groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about GROUP_CHARS characters each."""
    begin = total = 0
    for i, t in enumerate(texts):
        total += len(t or "")
        if total >= GROUP_CHARS:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _with_column(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, kind)])


def _appended(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])


def _list_array(parts: list[bytes]) -> pa.Array:
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def encode(df: DataFrame, text: str = "text", ids: str = "ids", tokenizer: str | None = None) -> DataFrame:
    """``df`` with the token ids (array of int) of its column ``text``."""
    common.ship_package(df.sparkSession)
    path = tokenizer or default_tokenizer()
    source = df if ids == text else df.drop(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = merge_encoder(path)
        for batch in batches:
            texts = batch.column(text).to_pylist()
            for a, b in groups(texts):
                yield _appended(batch.slice(a, b - a), ids, _list_array(encoder.encode(texts[a:b])))

    return source.mapInArrow(common.tidy(run), _with_column(source.schema, ids, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, ids: str = "ids", text: str = "decoded", tokenizer: str | None = None) -> DataFrame:
    """``df`` with the text of its ids; bytes that are no UTF-8 become U+FFFD, unknown ids nothing, null ids ''."""
    common.ship_package(df.sparkSession)
    path = tokenizer or default_tokenizer()
    source = df.drop(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array([*vocabulary(path).bytes_of, b""], dtype=object)
        for batch in batches:
            column = batch.column(ids)
            # texts of a slice only at a time, so that a batch of long documents stays small
            for a in range(0, len(column), 512):
                part = column.slice(a, 512)
                flat = np.asarray(part.flatten().fill_null(-1)).astype(np.int64)
                unknown = (flat < 0) | (flat >= len(table))
                tokens = table[np.where(unknown, len(table) - 1, flat)].tolist()
                ends = np.cumsum(np.asarray(part.value_lengths().fill_null(0)), dtype=np.int64).tolist()
                texts = [b"".join(tokens[p:q]).decode("utf-8", "replace") for p, q in pairwise([0, *ends])]
                yield _appended(batch.slice(a, len(part)), text, pa.array(texts, pa.string()))

    return source.mapInArrow(common.tidy(run), _with_column(source.schema, text, T.StringType()))


def op9_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded texts of all documents."""
    documents = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode(documents).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
    )
    return decode(encoded).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
