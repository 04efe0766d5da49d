"""Mixing to target weights by soft membership (operator 4).

A classifier learned from a labelled table gives every document a posterior over domains. Document rates r >= 0 (how
often a document is taken, on average) are fitted so that the expected tokens of every domain, sum of tokens x posterior
x rate, match the targets: least squares on relative errors, by projected gradient. A step needs one sum for each domain
over all documents, made by Spark; the driver holds a few numbers. The gradient is taken in a metric weighted by
tokens, for which the step 1 is safe, as posteriors sum to one.

Tokens are words between white space. Texts that are null or empty have no tokens and rate 1 (nothing depends on them).
Domains without a labelled document are not learned: their target weight is spread over the others. Without any label
all documents are of the one domain ``all``. A fixed hash of doc_id (null: of the text) decides how a rate that is no
whole number is rounded, so rows that repeat a doc_id are taken alike.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mobspark.llm import common
from mobspark.llm.word_features import REMEMBERED_WORDS, WORD, WordHasher, choose, presence

#: Bounds of the classifier: labelled rows of each domain that it is fitted on, and word features that it keeps.
ROWS_PER_DOMAIN = 3000
FEATURES = 300
STEPS, STEP, DECAY = 150, 0.1, 1e-4
#: The fit ends when every domain is this close to its target, or when a step lessens the squared error by this share only
#: (as when targets are out of reach).
CLOSE, GAIN = 1e-4, 0.01
#: Steps whose sums are kept in the rate's expression; then the rates are written down.
HISTORY = 24
TARGETS = {"high": 0.85, "low": 0.10, "toxic": 0.05}

#: Kinds of bytes: upper case, lower case, digits, space, line feed, punctuation, "!", "|", beyond ASCII.
KINDS = np.array([[b in kind for b in range(256)] for kind in (
    string.ascii_uppercase.encode(), string.ascii_lowercase.encode(), string.digits.encode(), b" ", b"\n", string.punctuation.encode(),
    b"!", b"|", range(128, 256))], np.float64)


def shape(text: str, words: list[str], distinct: int) -> list[float]:
    """Shares of kinds of characters, repetition, and length, none of which depends on the language's words."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n = max(len(raw), 1)
    h = np.bincount(raw, minlength=256)
    return [
        *(KINDS @ h / n).tolist(), log1p(len(raw)), distinct / max(len(words), 1), sum(map(len, words)) / max(len(words), 1),
    ]


class Model:
    """Softmax regression over the presence of chosen word buckets and the standardised shape."""

    def __init__(self, domains: list[str], buckets: dict[int, int], middle: np.ndarray, spread: np.ndarray, weights: np.ndarray):
        self.domains, self.buckets, self.middle, self.spread, self.weights = domains, buckets, middle, spread, weights

    def posterior(self, hits: list[list[int]], shapes: np.ndarray) -> np.ndarray:
        k = len(self.buckets)
        z = ((shapes - self.middle) / self.spread) @ self.weights[k:-1] + self.weights[-1]
        for i, own in enumerate(hits):
            if own:
                z[i] += self.weights[own].sum(axis=0)
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        return p / p.sum(axis=1, keepdims=True)


class WordHits:
    """The columns of a set of words; only words that have any are remembered with them."""

    def __init__(self, model: Model | None):
        self.buckets, self.hasher = model.buckets if model else {}, WordHasher()
        self.seen: set[str] = set()
        self.active: dict[str, list[int]] = {}

    def __call__(self, distinct: set[str]) -> list[int]:
        if len(self.seen) > REMEMBERED_WORDS:
            self.seen, self.active = set(), {}
        if new := distinct - self.seen:
            for w in new:
                if own := [self.buckets[b] for b in self.hasher.of(w) if b in self.buckets]:
                    self.active[w] = own
            self.seen |= new
        return list({c for w in self.active.keys() & distinct for c in self.active[w]})


def fit(docs: np.ndarray, columns: np.ndarray, shapes: np.ndarray, labels: np.ndarray, domains: list[str], counts: np.ndarray,
        kept: np.ndarray) -> Model:
    """docs, columns: one entry for each of the buckets ``kept`` that a document has; counts: documents of each domain
    before sampling."""
    column = {int(b): i for i, b in enumerate(kept)}
    middle, spread = shapes.mean(axis=0), np.maximum(shapes.std(axis=0), 1e-6)
    x = np.zeros((len(labels), len(kept) + shapes.shape[1] + 1), np.float32)
    x[docs, columns] = 1
    x[:, len(kept):-1] = (shapes - middle) / spread
    x[:, -1] = 1
    y = np.eye(len(domains))[labels]
    share = counts / np.maximum(np.bincount(labels, minlength=len(domains)), 1)
    weight = share[labels] / share[labels].sum()
    w = np.zeros((x.shape[1], len(domains)))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        z = x @ w
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        g = x.T @ ((p - y) * weight[:, None]) + DECAY * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= STEP * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(domains, column, middle, spread, w)


def train(documents: DataFrame, labels: DataFrame, rows_per_domain: int = ROWS_PER_DOMAIN, features: int = FEATURES) -> Model | None:
    """Fit on a bounded sample of the documents that ``labels`` (doc_id, domain) covers; None without any."""
    common.ship_package(documents.sparkSession)
    known = labels.where("doc_id IS NOT NULL AND domain IS NOT NULL").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    known = known.join(documents.select("doc_id").distinct(), "doc_id", "left_semi")
    counts = dict(known.groupBy("domain").count().collect())
    if not counts:
        return None
    domains = sorted(counts)
    # written, so that its size can be checked and the texts of all documents needn't be shuffled for it
    chosen = common.written(common.bounded_sample(known, "domain", rows_per_domain), "mixing-chosen")
    rows = documents.select("doc_id", "text").join(common.broadcast_if_small(chosen, 16), "doc_id").select("text", "domain")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            words = [WORD.findall(t.lower()) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column(1), pa.array([sorted(hasher.buckets(w)) for w in words], pa.list_(pa.int32())),
                pa.array([shape(t, w, len(set(w))) for t, w in zip(texts, words, strict=True)], pa.list_(pa.float64())),
            ], names=["domain", "buckets", "shape"])

    sample = common.written(rows.mapInArrow(common.tidy(run), "domain string, buckets array<int>, shape array<double>"), "mixing-sample")
    common.drop_written(chosen)
    per_class, table = presence(sample, "domain", "buckets", domains)
    if not per_class.sum():
        return None
    kept = choose(per_class, table, features)
    wanted = F.array(*[F.lit(int(b)) for b in kept]) if len(kept) else F.array().cast("array<int>")
    found = sample.select("domain", F.array_intersect("buckets", wanted).alias("buckets"), "shape").toArrow()
    common.drop_written(sample)
    at = {d: i for i, d in enumerate(domains)}
    lists = found.column("buckets").combine_chunks()
    sizes = np.asarray(lists.value_lengths())
    return fit(
        np.repeat(np.arange(len(sizes)), sizes), np.searchsorted(kept, np.asarray(lists.flatten())), np.array(found.column("shape").to_pylist()),
        np.array([at[d] for d in found.column("domain").to_pylist()]), domains, np.array([counts[d] for d in domains], float), kept)


def posteriors(df: DataFrame, model: Model | None) -> DataFrame:
    """``df`` with n_tokens and posterior (one number for each of the model's domains); the text is left out."""
    spark = df.sparkSession
    common.ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # FEATURES x domains numbers
    source = df.drop("n_tokens", "posterior")
    passed = [f for f in source.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hits_of = shared.value, WordHits(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            tokens = [len(t.split()) for t in texts]
            if model is None:
                p = np.ones((len(texts), 1))
            else:
                hits, shapes = [], np.zeros((len(texts), len(model.middle)))
                for i, t in enumerate(texts):
                    words = WORD.findall(t.lower())
                    distinct = set(words)
                    hits.append(hits_of(distinct))
                    shapes[i] = shape(t, words, len(distinct))
                p = model.posterior(hits, shapes)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in passed], pa.array(tokens, pa.int64()), pa.array(list(p), pa.list_(pa.float64()))],
                names=[*[f.name for f in passed], "n_tokens", "posterior"])

    kind = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in passed)
    return source.mapInArrow(common.tidy(run), f"{kind}n_tokens long, posterior array<double>")


def domain_targets(targets: dict[str, float], model: Model | None) -> tuple[list[str], np.ndarray]:
    """Weights of the learned domains; weights of others are spread over them."""
    domains = model.domains if model else ["all"]
    weights = np.array([targets.get(d, 0.0) for d in domains])
    return domains, weights / weights.sum() if weights.sum() > 0 else np.full(len(domains), 1 / len(domains))


def _dot(g: Column, k: int) -> Column:
    total = g[0] * F.col("posterior")[0]
    for i in range(1, k):
        total = total + g[i] * F.col("posterior")[i]
    return total


def fit_rates(df: DataFrame, weights: np.ndarray, total_tokens: float | None = None, max_rate: float | None = None) -> tuple[DataFrame, list[float]]:
    """``df`` (n_tokens, posterior) with the column rate, and the relative error of each domain's expected tokens.

    total_tokens: tokens to reach, by default as many as there are; with ``max_rate`` by default the most that no
    domain is too small for. Rates lie between 0 and max_rate.
    """
    k = len(weights)
    here = df.agg(*[F.sum(F.col("n_tokens") * F.col("posterior")[i]).alias(f"s{i}") for i in range(k)]).first()
    there = np.array([here[i] or 0.0 for i in range(k)])
    if there.sum() == 0:
        return df.withColumn("rate", F.lit(1.0)), [0.0] * k
    if total_tokens is None:
        wanted = weights > 0
        total_tokens = there.sum() if max_rate is None else min((there[wanted] * max_rate / weights[wanted]).min(), there.sum() * max_rate)
    target, scale = weights * total_tokens, np.maximum(there, 1e-9)
    current, start, history = df, F.lit(float(total_tokens / there.sum())), []

    def rate() -> Column:
        def step(r: Column, g: Column) -> Column:
            moved = F.greatest(r - _dot(g, k), F.lit(0.0))
            return moved if max_rate is None else F.least(moved, F.lit(float(max_rate)))

        if not history:
            return start
        return F.aggregate(F.array(*[F.array(*[F.lit(float(x)) for x in g]) for g in history]), start, step)

    last = None
    while True:
        sums = current.select("n_tokens", "posterior", rate().alias("r")).agg(
            *[F.sum(F.col("n_tokens") * F.col("posterior")[i] * F.col("r")) for i in range(k)]).first()
        miss = np.array([x or 0.0 for x in sums]) - target
        error = float((miss**2 / scale).sum())
        if np.all(np.abs(miss) <= CLOSE * np.maximum(target, CLOSE * total_tokens)) or (last is not None and last - error <= GAIN * last):
            break
        last = error
        history.append(miss / scale)
        if len(history) == HISTORY:
            current = common.written(current.withColumn("rate_so_far", rate()), "mixing-rates")
            start, history = F.col("rate_so_far"), []
    out = current.withColumn("rate", F.when(F.col("n_tokens") > 0, rate()).otherwise(1.0))
    return out.drop("rate_so_far"), (np.abs(miss) / np.maximum(target, 1.0)).tolist()


def copies(rate: str = "rate", doc_id: str = "doc_id") -> Column:
    """How often a document is taken: its rate, rounded up with the probability of the rest."""
    unit = F.pmod(F.xxhash64(F.col(doc_id), F.lit(4)), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(F.col(rate) + unit).cast("long")


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain): toxic, else high or low by the quality label."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
    return labels.select("doc_id", domain.alias("domain"))


def op4_target_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate and copies of every document for the target weights."""
    documents = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(documents, label_domains(common.table(spark, sf_dir, "labels")))
    domains, weights = domain_targets(TARGETS, model)
    rows = common.written(posteriors(documents, model), "mixing")
    out, _ = fit_rates(rows, weights)
    likeliest = F.array(*[F.lit(d) for d in domains])[F.array_position("posterior", F.array_max("posterior")).cast("int") - 1]
    return out.select("doc_id", "n_tokens", "posterior", likeliest.alias("domain"), "rate", copies().alias("copies"))


def mixed(documents: DataFrame, labels: DataFrame, targets: dict[str, float]) -> DataFrame:
    """The documents that a mix to ``targets`` takes, each at most once, as many as the scarcest domain allows."""
    model = train(documents, label_domains(labels))
    _, weights = domain_targets(targets, model)
    # the whole row travels through the fit only as its key; equal keys get equal rates
    rows = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    made = common.written(posteriors(rows, model), "mixing")
    out, _ = fit_rates(made, weights, max_rate=1.0)
    taken = common.written(out.where(copies() >= 1).select("doc_id", "text_hash").distinct(), "mixing-taken")
    right = taken.select(F.col("doc_id").alias("taken_id"), F.col("text_hash").alias("taken_hash"))
    packed = documents.select(F.struct(*documents.columns).alias("row"))
    same = F.col("row")["doc_id"].eqNullSafe(F.col("taken_id")) & (F.xxhash64(F.col("row")["text"]) == F.col("taken_hash"))
    return packed.join(common.broadcast_if_small(right, 32, taken), same, "left_semi").select("row.*")
