"""The learned operators and the pipeline, recomputed without the code under test."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from mobspark.llm import ann, bpe, common, langid, toxicity

SF = "/root/testdata/sf0.001"


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def letters(text):
    return [w for w in re.findall(r"[^\W\d_]+", (text or "").lower()) if any(c.isalpha() for c in w)]


def test_language_scores_by_hand(spark):
    docs = documents(spark)
    counts = {n: defaultdict(Counter) for n in range(5)}  # 0: words
    for d in docs:
        if d.lang is not None and d.text is not None and not held_out(d.doc_id):
            for w in letters(d.text):
                counts[0][d.lang][w] += 1
                for n in range(1, 5):
                    marked = "<" + w + ">"
                    counts[n][d.lang].update(marked[i : i + n] for i in range(len(marked) - n + 1))
    langs = sorted(counts[0])
    tables = {}
    for n in range(5):
        most = 30_000 if n == 0 else 10_000
        kept = {lang: dict(sorted(counts[n][lang].items(), key=lambda x: (-x[1], x[0]))[:most]) for lang in langs}
        known = set().union(*kept.values())
        total = {lang: sum(kept[lang].values()) + 0.5 * max(len(known), 1) for lang in langs}
        tables[n] = {x: [math.log((kept[lang].get(x, 0) + 0.5) / total[lang]) for lang in langs] for x in known}

    def word_score(w):
        if w in tables[0]:
            return tables[0][w]
        for n in (4, 3, 2, 1):
            grams = [("<" + w + ">")[i : i + n] for i in range(len(w) + 3 - n)]
            found = [tables[n][g] for g in grams if g in tables[n]]
            if found and 2 * len(found) >= len(grams):
                return [sum(x) / len(found) for x in zip(*found, strict=True)]
        return [0.0] * len(langs)

    fell_back = 0
    for r in langid.op3_language_id(spark, SF).collect():
        text = next(d.text for d in docs if d.doc_id == r.doc_id)
        words = letters(text)
        assert r.held_out == held_out(r.doc_id)
        if not words:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        fell_back += sum(w not in tables[0] for w in words)
        mean = np.mean([word_score(w) for w in words], axis=0)
        best = int(np.argmax(mean))
        score = 1 / sum(math.exp((m - mean[best]) * min(len(words), 30)) for m in mean)
        assert r.lang_pred == langs[best] and r.score == pytest.approx(score, rel=1e-9)
    assert fell_back > 100


def buckets(word):
    yield zlib.crc32(word.encode()) % (1 << 18)
    if len(word) > 5:
        yield zlib.crc32(b"^" + word[:5].encode()) % (1 << 18)


def noisy_or(text, weights, bias):
    clean, any_sentence = 1.0, False
    for part in re.findall(r"[^.!?\n]+", text.lower()):
        words = re.findall(r"[^\W\d_]+", part)
        for a in range(0, len(words), 40):
            any_sentence = True
            own = {b for w in words[a : a + 40] for b in buckets(w)}
            clean *= 1 - 1 / (1 + math.exp(-(bias + sum(weights.get(b, 0.0) for b in own))))
    return 1 - clean if any_sentence else 0.0


def test_noisy_or_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet").where(~common.held_out()))
    assert 0 < len(model.weights) <= toxicity.FEATURES
    got = {r.doc_id: r for r in toxicity.op8_toxicity(spark, SF).collect()}
    for d in docs.collect():
        want = noisy_or(d.text or "", model.weights, model.bias)
        r = got[d.doc_id]
        assert r.score == pytest.approx(want, abs=1e-9) and r.predicted == (want >= 0.3) and r.held_out == held_out(d.doc_id)


def test_fit_is_a_maximum_of_the_likelihood():
    rng = np.random.default_rng(2)
    k, n = 6, 400
    truth = np.array([4.0, -1.0, 0.0, 3.0, 0.5, -2.0])
    hits = [[sorted({*rng.choice(k, rng.integers(1, 4)).tolist()}) for _ in range(rng.integers(0, 4))] for _ in range(n)]
    plain = rng.integers(0, 5, n).astype(float)
    labels = []
    for own, p in zip(hits, plain, strict=True):
        clean = np.prod([1 - 1 / (1 + math.exp(4 - truth[s].sum())) for s in own]) * (1 - 1 / (1 + math.exp(4))) ** p
        labels.append(int(rng.random() < 1 - clean))
    labels = np.array(labels)
    model = toxicity.fit(labels, plain, hits, np.arange(k) + 100, (float((labels == 0).sum()), float((labels == 1).sum())))

    def loss(w, bias):
        out = 0.0
        for y, own, p in zip(labels, hits, plain, strict=True):
            log_clean = -sum(math.log1p(math.exp(bias + w[s].sum())) for s in own) - p * math.log1p(math.exp(bias))
            out += math.log(max(-math.expm1(log_clean), 1e-300)) if y else log_clean
        return -out / n + toxicity.DECAY / 2 * (w**2).sum()

    w = np.array([model.weights[100 + i] for i in range(k)])
    here = loss(w, model.bias)
    for i in range(k + 1):
        for step in (-0.3, 0.3):
            moved, bias = w.copy(), model.bias
            if i < k:
                moved[i] += step
            else:
                bias += step
            assert loss(moved, bias) > here - 1e-4, (i, step)


def fingerprint(text):
    raw = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_pipeline_by_hand(spark):
    import corpus_pipeline

    from tokenizers import Tokenizer

    stages, docs, made = dict(corpus_pipeline.STAGES), spark.read.parquet(f"{SF}/documents.parquet"), {}
    rows = {"": docs}
    before = ""
    for name, stage in corpus_pipeline.STAGES:
        rows[name] = common.written(stage(spark, rows[before], SF), f"test-{name}")
        made[name] = {r.doc_id: r for r in rows[name].collect()}
        assert len(made[name]) == rows[name].count()
        before = name
    assert list(stages) == ["toxicity", "line_dedup", "simhash_near_dedup", "mixing", "bpe_encoding"]

    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    clean = {d.doc_id for d in docs.collect() if noisy_or(d.text or "", model.weights, model.bias) < 0.3}
    assert made["toxicity"].keys() == clean

    # lines that stay are lines of the text, in order; no line of 20 characters or more stands twice, nor a short one
    seen = set()
    for i, r in sorted(made["line_dedup"].items()):
        old = iter((made["toxicity"][i].text or "").split("\n"))
        lines = [] if r.text is None else r.text.split("\n")
        assert all(line in old for line in lines)
        for line in lines:
            if line.strip():
                assert line not in seen
                seen.add(line)
        assert r.text is None or r.text == made["toxicity"][i].text or r.n_chars == len(r.text)
    for i, r in made["toxicity"].items():
        gone = set((r.text or "").split("\n")) - set((getattr(made["line_dedup"].get(i), "text", "") or "").split("\n"))
        for line in gone:
            near = [x for x in seen if x == line or abs(len(x) - len(line)) <= 31 and len(line) >= 20]
            assert not line.strip() or near

    # one document of each group of fingerprints linked at 4 bits
    ids = sorted(made["line_dedup"])
    prints = [fingerprint(made["line_dedup"][i].text) for i in ids]
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert set(made["simhash_near_dedup"]) == {ids[find(a)] for a in range(len(ids))}
    for i, r in made["simhash_near_dedup"].items():
        assert r == made["line_dedup"][i]
    assert made["mixing"].keys() <= made["simhash_near_dedup"].keys()

    library = Tokenizer.from_file(bpe.default_tokenizer())
    assert made["bpe_encoding"].keys() == made["mixing"].keys()
    for i, r in made["bpe_encoding"].items():
        want = library.encode(made["mixing"][i].text or "", add_special_tokens=False).ids
        assert r.ids == want and r.n_tokens == len(want)


def test_products_that_overflow_and_ties_take_the_smaller_id(spark):
    big = [1e200] * 4
    rows = [(0, [1.0, 0.5, 0.25, 0.125]), (20, big), (7, [-1e200] * 4)]
    rows += [(i, [0.1 * ((i + j) % 3 + 1) for j in range(4)]) for i in (1, 2, 3, 4, 5, 6, 8, 9, 10, 11, 12)]
    got = defaultdict(list)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for r in ann.search(df, k=4, share=1.0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert math.isfinite(r.score)
    for q in (0, 20):
        own = dict(rows)[q]
        found = sorted(
            (-s, i) for i, v in rows if i != q and math.isfinite(s := float(np.einsum("ij,ij->i", np.array([own]), np.array([v]))[0])))
        assert got[q] == [(i, -s) for s, i in found[:4]]


def test_pairs_of_centroids_come_by_distance():
    rng = np.random.default_rng(5)
    books, q = ann.Codebooks(rng.normal(size=(7, 3)), rng.normal(size=(9, 5))), rng.normal(size=8)
    walk = list(books.walk(q, by_distance=True))
    gaps = [((books.first[i] - q[:3]) ** 2).sum() + ((books.second[j] - q[3:]) ** 2).sum() for i, j in walk]
    assert len(set(walk)) == 63 and all(a <= b + 1e-12 for a, b in zip(gaps, gaps[1:], strict=False))
