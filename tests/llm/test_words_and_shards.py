"""Sharding, spelling variants and collocations against brute force, and odd inputs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from mobspark.llm import collocations, sharding, spelling

# sharding ---------------------------------------------------------------------------------------------------------------


def nearest_cuts(sizes, shards):
    below, total = np.r_[0, np.cumsum(sizes)], sum(sizes)
    return [int(below[np.argmin(abs(below * shards - total * j))]) for j in range(1, shards)]


@pytest.mark.parametrize("ids", [range(700), [10**17 * i - 3 * 10**18 for i in range(60)], [i**6 for i in range(300)]])
@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_are_cut_nearest_to_their_targets(spark, ids, shards):
    rnd = random.Random(5)
    rows = [(i, "é" * int(rnd.paretovariate(0.7) % 5000)) for i in ids]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = sharding.shard(df, shards, piece_bytes=500).collect()
    ordered = sorted(rows)
    cuts = nearest_cuts([len(t.encode()) + 1 for _, t in ordered], shards)
    want, below, slots = [], 0, Counter()
    for i, t in ordered:
        s = sum(c <= below for c in cuts)
        want.append((i, t, s, slots[s]))
        slots[s] += 1
        below += len(t.encode()) + 1
    assert sorted(map(tuple, out)) == want


def test_tolerance_is_kept(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.expr("repeat('x', int(id % 50))").alias("text"))
    out = sharding.shard(df, 5, tolerance=0.02).groupBy("shard").agg(F.sum(F.length("text") + 1).alias("b"), F.count("slot").alias("n"), F.max("slot")).collect()
    sizes = np.array([r.b for r in out])
    assert abs(np.cumsum([b for _, b in sorted((r.shard, r.b) for r in out)])[:-1] / sizes.sum() * 5 - np.arange(1, 5)).max() <= 0.02
    assert all(r.n == r[3] + 1 for r in out)


def test_repeated_rows_are_cut_too(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 4 > 0, F.lit(7)).when(F.col("id") % 8 == 0, F.col("id")).alias("doc_id"), F.lit("the same").alias("text"),
        F.lit("kept").alias("k"), F.lit("own").alias("piece"), F.lit(-1).alias("shard"))
    out = sharding.shard(df).toPandas()
    assert list(out.columns) == ["doc_id", "text", "k", "piece", "shard", "slot"] and len(out) == 4000
    assert (out.groupby("shard").size() == 500).all() and (out.groupby("shard").slot.nunique() == 500).all()
    assert (out.k == "kept").all() and (out.piece == "own").all() and out.doc_id.isna().sum() == 500
    assert (out[out.doc_id.isna()].shard == 0).all()


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(3, None), (1, ""), (2, "x" * 300_000)], "doc_id long, text string")
    assert [r.slot for r in sharding.shard(df).collect()] == [0, 0, 0] or sharding.shard(df).count() == 3
    assert sharding.shard(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        sharding.shard(df, 0)


def test_one_exchange_and_no_python(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    plan = sharding.shard(df)._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[-1]
    assert final.count("Exchange") == 1 and "Python" not in plan and "Arrow" not in plan


# spelling ---------------------------------------------------------------------------------------------------------------


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words, dominance=5):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}

    def form(w):
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        return best if best is not None and words[best] >= dominance * words[w] else None

    out = []
    for w in words:
        root = w
        while (up := form(root)) is not None:
            root = up
        out.append((w, form(w), root, words[w], len(near[w]), words[form(w)] if form(w) else None))
    return sorted(out)


def vocabulary(n, letters, seed=2):
    rnd, out = random.Random(seed), {}
    while len(out) < n:
        w = "".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 9)))
        out[w] = rnd.choice([1, 1, 5, 5, 25, 26, 125, 700, 4000])
        for _ in range(2):
            k = rnd.randrange(len(w) + 1)
            out.setdefault(w[:k] + rnd.choice(letters) + w[k + rnd.randrange(2) :], rnd.choice([1, 2, 5, 30]))
    return out


@pytest.mark.parametrize("block", [3, 40, 1024])
def test_variants_like_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    words = vocabulary(500, "abcé日𝔘")
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert sorted(map(tuple, spelling.variants(df).collect())) == brute_variants(words)


def test_tiles_of_two_blocks():
    words = list(vocabulary(400, "abcd", seed=9))
    for m in range(2, 9):
        met = Counter()
        for by_prefix in (True, False):
            a, b = spelling.matrices(words[:150]), spelling.matrices(words[150:])
            met.update(zip(*(x.tolist() for x in np.nonzero(spelling.tile(a, b, m, by_prefix))), strict=True))
        want = {(i, j) for i, x in enumerate(words[:150]) for j, y in enumerate(words[150:]) if one_edit(x, y) and max(len(x), len(y)) == m}
        assert set(met) == want and set(met.values()) <= {1}


def test_long_words_and_chains(spark):
    long = "ab" * 30_000
    words = {long: 9, long + "c": 50, long[:-1] + "x": 8, "aaaaaa": 1, "aaaaab": 5, "aaaabb": 25, "aaabbb": 125, "aabbbb": 625, "abbbbb": 3125}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert sorted(map(tuple, spelling.variants(df).collect())) == brute_variants(words)


def test_words_of_texts(spark):
    texts = [None, "", "Straße STRASSE strasse naïve-naïve ÉTÉétéx", "x1yyyyyyy yyyyyyy", "a" * 100_000, "déjà vu " * 2000, "déjà vu " * 2000]
    df = spark.createDataFrame([(None if i == 3 else i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, n long")
    want = Counter()
    for i, t in enumerate(texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = spelling.noisy(None if i == 3 else i, re.sub("[A-Z]", lambda m: m[0].lower(), run))
            want[w] += len(w) >= 4
    got = {r.word: r.n for r in spelling.word_counts(df, min_length=4, min_count=1, change=spelling.noisy).collect()}
    assert got == {w: n for w, n in want.items() if n}
    assert any(spelling.noisy(i, "wording") != "wording" for i in range(2000)) and len(spelling.noisy(None, "x")) <= 1
    assert spelling.variants(spelling.word_counts(df.limit(0))).collect() == []


# collocations -----------------------------------------------------------------------------------------------------------


def brute_phrases(rows, min_count, top, max_words=3):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                f[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        covered = {
            p[i : i + m] for p, a in found.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= 50 * c[p[i : i + m]]}
        scored = []
        for p in found.keys() - covered:
            score, k = min((10**6 * c[p] ** 2 // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -c[p], " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, x, y) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, x, y, n[lang], -s))
    return sorted(out)


def phrase_rows(n, seed=3):
    rnd = random.Random(seed)
    words = [*"abcdef", "É", "日本", "x\x1cy", "\x85", "New", "York"]
    weights = [2 ** -(i / 2) for i in range(len(words))]
    rows = [(rnd.choice(["en", None, "", "fr"]), "".join(w + rnd.choice([" ", "  ", "\t", ". ", "!", " ", " ", "\n"])
             for w in rnd.choices(words, weights, k=rnd.randrange(60)))) for _ in range(n)]
    return [*rows, (None, None), ("en", ""), ("en", "a b c " * 5000), ("de", "a b c " * 3)]


@pytest.mark.parametrize("bounds", [(1 << 19, 1 << 22), (10, 1 << 22), (1 << 19, 25), (12, 9), (1, 1)])
def test_phrases_like_brute_force_whatever_the_dictionary_holds(spark, bounds):
    rows = phrase_rows(150)
    df = spark.createDataFrame([(lang, text, 1, "x") for lang, text in rows], "lang string, text string, n long, phrase string").repartition(3)
    for max_words in (2, 3, 4):
        got = collocations.mine(df, min_count=4, max_words=max_words, top=40, most_words=bounds[0], most_phrases=bounds[1])
        assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 4, 40, max_words)


def test_dense_and_sparse_tiles(monkeypatch):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(collocations, "SIDE", 16)
    monkeypatch.setattr(collocations, "DENSE", 40)
    a, b = (rng.zipf(1.3, 30_000) % 500 for _ in range(2))
    keys, counts = collocations.count_pairs(a, b, 500)
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == Counter((a * 500 + b).tolist()) and len(set(keys.tolist())) == len(keys)


def test_scores_beyond_64_bits_are_exact(spark):
    a, b, c = 3_000_000_007, 3_000_000_011, 2_999_999_999
    got = spark.range(1).select(F.expr(
        f"cast((cast({c} as decimal(15,0)) * cast({c} as decimal(15,0)) * 1000000) div (cast({a} as decimal(15,0)) * cast({b} as decimal(15,0))) as long)"))
    assert got.first()[0] == 10**6 * c * c // (a * b)


def test_no_phrases(spark):
    df = spark.createDataFrame([("en", "one two three"), (None, None)], "lang string, text string")
    assert collocations.mine(df).collect() == [] and collocations.mine(df.limit(0)).collect() == []
