"""Mixing, the two searches, and the pipeline as a whole."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mobspark.llm import ann, common, mixing, registered, topk, vectors


def test_rates_reach_the_targets(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        p = rng.dirichlet([0.3, 0.3, 0.3])
        rows.append((i, int(rng.integers(1, 500)), p.tolist()))
    df = spark.createDataFrame([*rows, (400, 0, [0.2, 0.3, 0.5])], "doc_id long, n_tokens long, posterior array<double>")
    weights = np.array([0.6, 0.3, 0.1])
    out, miss = mixing.fit_rates(df, weights)
    got = out.toPandas()
    tokens, p = got.n_tokens.to_numpy(), np.stack(got.posterior)
    expected = (p * (tokens * got.rate.to_numpy())[:, None]).sum(axis=0)
    assert np.allclose(expected, weights * tokens.sum(), rtol=1e-3) and max(miss) < 1e-3
    assert (got.rate >= 0).all() and got[got.doc_id == 400].rate.item() == 1
    capped, _ = mixing.fit_rates(df, weights, max_rate=1.0)
    assert capped.agg(F.max("rate"), F.min("rate")).first()[0] <= 1
    # the plain loop over all rows in one place gives the same rates
    rate, there = np.full(len(got), 1.0), (p * tokens[:, None]).sum(axis=0)
    for _ in range(200):
        rate = np.maximum(rate - p @ (((p * (tokens * rate)[:, None]).sum(axis=0) - weights * tokens.sum()) / there), 0)
    assert np.abs(np.where(tokens > 0, rate, 1) - got.rate.to_numpy()).max() < 0.02


def test_mixing_learns_domains_and_takes_odd_rows(spark):
    rnd = random.Random(3)
    words = {"high": ["fine", "good", "calm"], "low": ["SPAM!!", "BUY!!", "NOW!!"]}
    rows = [(i, " ".join(rnd.choice(words[d]) for _ in range(30))) for i, d in enumerate(["high", "low"] * 60)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows] + [(None, None, "x", 1), (500, "", "x", 1), (0, rows[0][1], "x", 1)],
                                 "doc_id long, text string, rate string, taken_id int")
    labels = spark.createDataFrame([(i, i % 2 == 0 and 1 or 0, 0) for i in range(100)] + [(None, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    domains = mixing.label_domains(labels)
    model = mixing.train(docs, domains)
    made = mixing.posteriors(docs, model).collect()
    assert model.domains == ["high", "low"] and {len(r.posterior) for r in made} == {2}
    right = [(r.posterior[0] > 0.5) == (r.doc_id % 2 == 0) for r in made if r.doc_id is not None and r.doc_id < 500]
    assert np.mean(right) > 0.98
    kept = mixing.mixed(docs, labels, {"high": 0.8, "low": 0.2})
    assert kept.columns == docs.columns and {None, 500} <= {r.doc_id for r in kept.collect()}
    assert mixing.mixed(docs, labels.limit(0), {"high": 1.0}).count() == docs.count()
    assert mixing.mixed(docs.limit(0), labels, {"high": 1.0}).count() == 0


def brute(ids, rows, k, zero_too):
    out = {}
    for i, q in zip(ids, rows, strict=True):
        if i % 20 == 0:
            scored = sorted(((-float(q @ v), j) for j, v in zip(ids, rows, strict=True) if j != i))
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def table(spark, n, seed=1):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, 8))
    v[n // 3: n // 2] = v[0]
    v[-2] = v[1]
    rows = [(i, [float(x) for x in np.float32(r)], 1) for i, r in enumerate(v)]
    odd = [(1000, None, 1), (1020, [None] * 8, 1), (1040, [float("nan")] * 8, 1), (1060, [float("inf")] + [0.0] * 7, 1), (1080, [0.0] * 8, 1), (None, [1.0] * 8, 1)]
    return spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score int").repartition(4), rows


@pytest.mark.parametrize(("slices", "gather", "blocks"), [(2, 128, 8192), (3, 1, 50), (1, 4, 8192)])
def test_topk_against_brute_force(spark, monkeypatch, slices, gather, blocks):
    monkeypatch.setattr(vectors, "VECTOR_BLOCK", blocks)
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 4)
    df, rows = table(spark, 160)
    rows = [*rows, (1080, [0.0] * 8, 1)]
    ids, v = [r[0] for r in rows], np.floor(np.array([r[1] for r in rows]) * 64)
    found = topk.search(df, k=5, slices=slices, gather=gather).orderBy("query_id", "rank").collect()
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == brute(ids, v, 5, True)


def test_topk_passes_on_no_more_with_more_blocks(spark, monkeypatch):
    sizes = {}

    def written(df, kind, plain=common.written):
        out = plain(df, kind)
        if kind == "topk-gathered":
            sizes[kind] = out.groupBy("qkey", "slice").agg(F.sum(F.size("ids")).alias("n")).agg(F.max("n")).first()[0]
        elif kind == "topk-met":
            sizes[kind] = out.where("n_slices = 2").groupBy("qkey").count().agg(F.max("count")).first()[0]
        return out

    monkeypatch.setattr(topk.common, "written", written)
    monkeypatch.setattr(vectors, "VECTOR_BLOCK", 30)
    df, rows = table(spark, 300)
    found = topk.search(df, k=2, gather=30).count()
    blocks = -(-(len(rows) + 1) // 30)
    assert found == 2 * (len([r for r in rows if r[0] % 20 == 0]) + 1)  # and the zero vector
    assert sizes["topk-gathered"] <= 2 * 30 + blocks and sizes["topk-met"] <= 3 * blocks


def test_entries_of_a_block_meet_as_in_sql():
    rng = np.random.default_rng(8)
    k, slices = 3, 2
    tau = {q: int(rng.integers(20, 60)) for q in range(5)}
    share = {(q, s): tau[q] // 2 + (s and tau[q] % 2) for q in range(5) for s in range(2)}
    sent = [(q, s, sorted(rng.choice(40, size=int(rng.integers(0, 30)), replace=False).tolist())) for q in range(5) for s in range(2)]
    sent = [(q, s, ids, (share[q, s] + rng.integers(0, 9, size=len(ids))).tolist(), share[q, s], 0, tau[q]) for q, s, ids in sent]
    names = ["qkey", "slice", "ids", "scores", "least", "vb", "tau"]
    kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.int64()]
    table = pa.table([pa.array(c, kind) for c, kind in zip(zip(*sent, strict=True), kinds, strict=True)], names=names)
    met = {}
    for q, _, ids, scores, told, _, _ in sent:
        for i, x in zip(ids, scores, strict=True):
            old = met.get((q, i), (0, 0, 0))
            met[q, i] = (old[0] + x, old[1] + told, old[2] + 1)
    want = set()
    for q in range(5):
        done = sorted((-x, i) for (p, i), (x, _, n) in met.items() if p == q and n == slices)[:k + 1]
        want |= {(q, i, *met[q, i]) for _, i in done}
        want |= {(q, i, x, told, n) for (p, i), (x, told, n) in met.items()
                 if p == q and n < slices and x + tau[q] - told - (slices - n) >= tau[q]}
    got = topk.meet(table, k, slices).to_pylist()
    assert {tuple(r.values()) for r in got} == want and len(got) == len(want)
    assert topk.meet(table.slice(0, 0), k, slices).num_rows == 0


def test_multi_index_search(spark, monkeypatch):
    monkeypatch.setattr(vectors, "VECTOR_BLOCK", 60)
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 4)
    df, rows = table(spark, 300)
    ids, v = [r[0] for r in rows], np.array([r[1] for r in rows], float)
    want = brute(ids, v, 5, False)
    for share, recall in ((1.0, 1.0), (0.6, 0.9)):
        got = {}
        for r in ann.search(df, k=5, share=share, least=10).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        hits = np.mean([len({j for j, _ in got[q]} & {j for j, _ in own}) / len(own) for q, own in want.items()])
        assert set(got) == set(want) and hits >= recall
        if share == 1.0:
            assert all([j for j, _ in got[q]] == [j for j, _ in own] for q, own in want.items())
            assert all(abs(a - b) < 1e-12 for q in want for (_, a), (_, b) in zip(got[q], want[q], strict=True))


def test_pairs_of_centroids_come_in_order():
    rng = np.random.default_rng(2)
    books = ann.Codebooks(rng.normal(size=(5, 4)), rng.normal(size=(6, 4)))
    q = rng.normal(size=8)
    walk = list(books.walk(q))
    sums = [books.first[i] @ q[:4] + books.second[j] @ q[4:] for i, j in walk]
    assert len(set(walk)) == 30 and all(a >= b - 1e-12 for a, b in zip(sums, sums[1:], strict=False))


def test_searches_of_few_rows_and_repeats(spark):
    kind = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (20, [1.0, 0.0])], kind)
    for search in (ann.search, topk.search):
        got = sorted((r.query_id, r["rank"], r.vec_id) for r in search(few).collect())
        assert got == [(0, 1, 20), (0, 2, 1), (20, 1, 0), (20, 2, 1)]
        assert search(few.limit(0)).count() == 0


def test_every_operator_has_a_query_and_takes_no_rows(spark, tmp_path):
    assert [sum(k.startswith(f"op{n}_") for k in registered.queries()) for n in range(1, 11)] == [1] * 10
    for name, kind in (("documents", "doc_id long, text string, lang string, source string, n_chars long"),
                       ("labels", "doc_id long, quality int, toxic int"), ("embeddings", "vec_id long, embedding array<float>, label int")):
        spark.createDataFrame([], kind).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name, query in registered.queries().items():
        assert query(spark, str(tmp_path)).count() == 0, name


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    count, kept = docs.count(), docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        from mobspark.llm import common

        kept = common.written(stage(spark, kept, sf), f"test-{name}")
        assert kept.columns == docs.columns and 0 < kept.count() <= count
        count = kept.count()
    out = corpus_pipeline.run(spark, sf)
    assert out.count() == count and {r.doc_id for r in out.collect()} == {r.doc_id for r in kept.collect()}
