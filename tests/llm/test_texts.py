"""Tokens, token files, language and toxicity."""

import hashlib
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mobspark.llm import bpe, common, langid, token_files, toxicity

ODD = [
    None, "", "a", "  ", "\n\n x", "a \n<|endoftext|>b <|endoftext|> c", "it's I'LL we'll 've ' s", "日本語 ｱｲｳ", "\x1c\x1d x\x1fy", "\x85 a 　 b",
    "aaaaaaaaaaaaa bbbbbbb", "½ ² Ⅷ ٣٤ x²", "éa‍🏳️‍🌈", "  a  \t b\r\n", "!!!!!! ''s", "﻿abc", "word " * 30_000,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_tokenizer())


def random_texts(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(" \n\t'stabcé日²ⅷ٣!?-  \x1c\x85A<|>") for _ in range(rnd.randrange(40))) for _ in range(n)]


def test_both_encoders_give_the_library_s_ids(library):
    texts = ODD + random_texts(800)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for encoder in (bpe.merge_encoder(bpe.default_tokenizer()), token_files.library_encoder(bpe.default_tokenizer())):
        assert [np.frombuffer(x, np.int32).tolist() for x in encoder.encode(texts)] == want
        encoder.memory = {}
        assert [np.frombuffer(x, np.int32).tolist() for x in encoder.encode(texts)] == want


def test_encode_and_decode_frames(spark, library):
    texts = [*ODD, "twice", "twice"]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, ids string, decoded string")
    back = bpe.decode(bpe.encode(df)).orderBy("doc_id").collect()
    for r, t in zip(back, texts, strict=True):
        assert r.ids == library.encode(t or "", add_special_tokens=False).ids and r.decoded == (t or "")
    ids = spark.createDataFrame([([256, 999_999, 10],), (None,), ([160],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(ids).collect()] == [library.decode([256, 10]), "", library.decode([160])]
    assert bpe.decode(bpe.encode(df.limit(0))).count() == 0


def test_perfect_hash():
    rng = np.random.default_rng(3)
    for n in (1, 2, 63, 5000):
        keys = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        perfect = token_files.PerfectHash.build(keys)
        assert sorted(perfect.slots(keys).tolist()) == list(range(len(keys)))
        counts = rng.integers(0, 9, len(keys)).astype(np.uint64)
        index = token_files.ShardIndex(token_files.index_bytes(keys, np.cumsum(counts) - counts, counts))
        found, begin, count = index.find(keys)
        assert found.all() and (begin == np.cumsum(counts) - counts).all() and (count == counts).all()
        others = rng.integers(0, 2**64, 1000, dtype=np.uint64)
        assert index.find(others)[0].mean() < 0.01


def test_token_files_round_trip(spark, library):
    texts = [t for t in ODD if t is None or len(t) < 1000] + random_texts(40)
    ids = list(range(len(texts)))
    ids[3] = None
    ids[5] = ids[6]
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(4)
    folder = common.new_folder(spark, "test-token-files")
    manifest = token_files.write_shards(df, folder, shard_ids=50)
    assert manifest.count() > 3
    rows = token_files.crc32(token_files.read_by_key(manifest, df)).collect()
    want, start = [], 0
    for doc, text in sorted(zip(ids, [t or "" for t in texts], strict=True), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode())):
        own = [*library.encode(text, add_special_tokens=False).ids, 0]
        want.append((doc, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows]
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert token_files.read_by_key(manifest, spark.createDataFrame([(10_000,), (-5,)], "doc_id long")).count() == 0
    empty = token_files.write_shards(df.limit(0), common.new_folder(spark, "test-token-files"))
    assert token_files.read_by_key(empty, df).count() == 0


def test_language_by_words_and_shorter_grams(spark):
    rnd = random.Random(2)
    words = {"xx": ["lora", "bani", "tolo", "rani"], "yy": ["schtu", "krent", "pflau", "grisch"]}
    rows = [(i, " ".join(rnd.choice(words[g]) for _ in range(20)), g) for i, g in enumerate(["xx", "yy"] * 40)]
    model = langid.train(spark.createDataFrame([*rows, (None, None, "xx"), (99, "", None)], "doc_id long, text string, lang string"))
    texts = ["lora bani", "lorabani tolorani", "KRENT!", "schtugrisch", None, "", "123 ²½", "lora krent", "q" * 50_000]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    got = {r.doc_id: r for r in langid.predict(df, model).collect()}
    assert [got[i].lang_pred for i in range(7)] == ["xx", "xx", "yy", "yy", "und", "und", "und"]
    assert all(0 <= r.score <= 1 for r in got.values()) and got[4].score == 0 and got[0].score > 0.9
    nothing = langid.train(df.limit(0).select("doc_id", "text", F.lit("x").alias("lang")))
    assert {r.lang_pred for r in langid.predict(df, nothing).collect()} == {"und"}


def test_language_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = langid.op3_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, n = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 150 and right > 0.95


def test_toxic_sentences_are_found_from_document_labels(spark):
    rnd = random.Random(4)
    plain = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]

    def text(bad):
        s = [" ".join(rnd.choice(plain) for _ in range(6)) for _ in range(8)]
        if bad:
            s[rnd.randrange(8)] += " vilest"
        return ". ".join(s)

    rows = [(i, text(i % 4 == 0)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(0, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    new = [text(True), text(False), None, "", "İ vilest. Alpha beta", text(False) * 300]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(new)], "doc_id long, text string, toxicity int")
    got = [r for r in toxicity.score(df, model).orderBy("doc_id").collect()]
    assert got[0].toxicity > 0.9 and got[1].toxicity < 0.3 and got[2].toxicity == got[3].toxicity == 0 and got[4].toxicity > 0.9 and got[5].toxicity < 0.3
    for i in (0, 4):
        assert [("vilest" in new[i][o.begin:o.end]) for o in got[i].offending] == [True]
    kept = toxicity.reject_toxic(df, labels)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= {2, 3}
    assert toxicity.score(df, toxicity.train(docs, labels.limit(0))).agg(F.max("toxicity")).first()[0] == 0


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = toxicity.op8_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    counts = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert counts.get((0, 1), 0) <= 3 and counts.get((1, 0), 0) <= 3 and counts[1, 1] >= 5


def test_bpe_query_digests(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in bpe.op9_bpe_encoding(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert rows[r.doc_id].n_tokens == len(ids)
        assert rows[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_a_task_hands_back_what_it_freed():
    def in_use() -> float:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 2**20

    kept = []

    def run(batches):
        rows = [np.ones(12_000) for _ in range(3_000)]  # 290 MB in pieces that the C library doesn't map one by one
        kept.append(np.ones(12_000))  # lies above them
        del rows
        yield from batches

    before = in_use()
    assert list(common.tidy(run)(iter([]))) == []
    assert len(kept) == 1 and in_use() < before + 100
