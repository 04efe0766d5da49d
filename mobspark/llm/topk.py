"""Exact top-k search by a three-phase uniform threshold (operator 7).

Components are whole numbers, floor(64 x), and a vector's score for a query is the sum of what its slices of components
give, so each slice is a node with a local list of scores. For every query

1. every slice gathers its ``GATHER`` best local scores, and its least one. The vectors in those lists get their exact
   scores, and the k-th best of them, tau, is a safe cutoff: the result has no score below it;
2. the slices get their share of the cutoff: a vector that reaches none of the shares (each the slice's least score plus
   an even part of what remains, so that they add up to tau) stays below tau in all. Every slice sends the entries that
   reach its share. The k-th best score of vectors that all slices sent, if higher, becomes the new cutoff;
3. vectors that some slice didn't send have an upper bound, with the share in place of what is missing. Those that may
   still reach the cutoff are scored exactly.

A task handles one slice of a block of vectors for a block of queries, so lists are made where the vectors are and only
entries travel. In phase 1 the blocks share the gathered places between them, so the lists of a query don't grow with the
number of blocks. In phase 2 the entries of a block from all slices meet as lists in one task, which passes on the few that can
still be in a result. Copies of a vector stand for it by their smallest ids only, which is all that a result can hold, and
equal queries are searched once. All scores are whole numbers and exact.

Null and non-finite vectors take no part (zero vectors do). Rows that repeat a vec_id count once, with
the smallest of their vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mobspark.llm import common, vectors

K = 20
SCALE = 64
SLICES = 2
#: Local scores that a slice gathers in phase 1; more give a better cutoff, and any number a right result.
GATHER = 128

#: Queries whose entries of a block of vectors meet in one task.
MEETING_BLOCK = 512

ENTRY = "qkey long, slice int, ids array<long>, scores array<long>, least long"
SENT = f"{ENTRY}, vb int, tau long"
MET = "qkey long, vec_id long, known long, told long, n_slices long"


def whole(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v) with components floor(scale x) as longs."""
    return rows.select("vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("v"))


def sliced(df: DataFrame, components: int, slices: int) -> DataFrame:
    """A row for each slice of ``v``."""
    bounds = [components * i // slices for i in range(slices + 1)]
    parts = [F.struct(F.lit(i).alias("slice"), F.slice("v", bounds[i] + 1, bounds[i + 1] - bounds[i]).alias("part")) for i in range(slices)]
    return df.withColumn("s", F.explode(F.array(*parts))).select(*[c for c in df.columns if c != "v"], "s.slice", "s.part")


def _list_rows(query: np.ndarray, keys: np.ndarray, ids: np.ndarray, scores: np.ndarray, slices: np.ndarray, least: np.ndarray) -> pa.Table:
    """One row for each of ``keys``: its entries, given by ``query`` (ascending), ids and scores."""
    offsets = np.searchsorted(query, np.arange(len(keys) + 1)).astype(np.int32)
    return pa.table({
        "qkey": keys, "slice": slices.astype(np.int32), "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int64())),
        "scores": pa.ListArray.from_arrays(pa.array(offsets), pa.array(scores, pa.int64())), "least": least,
    })


def meet(sent: pa.Table, k: int, slices: int) -> pa.Table:
    """The entries of a block of vectors by query and vector, summed over the slices: of vectors that all slices sent the
    k + 1 best of each query, of the others those whose upper bound reaches the query's cutoff ``tau``."""
    lists = sent.column("ids").combine_chunks()
    each = np.asarray(lists.value_lengths())
    ids, scores = np.asarray(lists.flatten()), np.asarray(sent.column("scores").combine_chunks().flatten())
    qkey, told, tau = (np.repeat(sent.column(c).to_numpy(), each) for c in ("qkey", "least", "tau"))
    order = np.lexsort((ids, qkey))
    ids, scores, qkey, told, tau = ids[order], scores[order], qkey[order], told[order], tau[order]
    first = np.flatnonzero(np.r_[True, (qkey[1:] != qkey[:-1]) | (ids[1:] != ids[:-1])][:len(ids)])
    if len(first):
        known, told, n = np.add.reduceat(scores, first), np.add.reduceat(told, first), np.diff(np.r_[first, len(ids)])
    else:
        known, told, n = scores, told, ids
    qkey, ids, tau = qkey[first], ids[first], tau[first]
    done = np.flatnonzero(n == slices)
    done = done[np.lexsort((ids[done], -known[done], qkey[done]))]
    nth = np.arange(len(done)) - np.searchsorted(qkey[done], qkey[done])
    at = np.r_[done[nth <= k], np.flatnonzero((n < slices) & (upper_bound(known, told, n, tau, slices) >= tau))]
    return pa.table({"qkey": qkey[at], "vec_id": ids[at], "known": known[at], "told": told[at], "n_slices": n[at]})


def upper_bound(known, told, n_slices, tau, slices: int):
    """The highest score of a vector that ``n_slices`` slices sent (arrays or columns): what is missing stays below the shares
    of those slices, which are tau less the shares of the others."""
    return known + tau - told - (slices - n_slices)


def _products(own: pa.Table, asked: pa.Table, column: str) -> np.ndarray:
    """Local scores; exact in doubles as long as they stay below 2**53."""
    components = len(own.column(column)[0])
    rows = vectors.matrix(own.column(column), components)
    q = vectors.matrix(asked.column(column), components)
    if np.abs(q).max(initial=0) * np.abs(rows).max(initial=0) * components >= 2**53:
        return q.astype(np.int64) @ rows.astype(np.int64).T
    return q @ rows.T


def search(df: DataFrame, k: int = K, scale: int = SCALE, slices: int = SLICES, gather: int = GATHER, vec_id: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest scores of every query."""
    spark = df.sparkSession
    common.ship_package(spark)
    all_rows = whole(vectors.unique(vectors.clean(df, vec_id, vector, zero_too=True)), scale)
    components = vectors.width(all_rows)
    if not components:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    slices = min(slices, components)
    gather = max(gather, k + 1)
    queries = vectors.query_rows(all_rows)
    rows = common.written(vectors.findable(all_rows, k), "topk-vectors")
    asked = common.written(vectors.distinct_queries(queries), "topk-queries")
    n = rows.count()
    blocks = vectors.block_count(n, vectors.VECTOR_BLOCK)
    query_blocks = vectors.block_count(n // vectors.QUERY_STEP, vectors.QUERY_BLOCK)
    placed = rows.withColumn("vb", vectors.block_of("vec_id", blocks))
    left = sliced(placed, components, slices).withColumn("qb", vectors.every_block(query_blocks))
    of_block = asked.withColumn("qb", vectors.block_of("qkey", query_blocks))
    right = sliced(of_block, components, slices).withColumn("vb", vectors.every_block(blocks))
    keys = ["slice", "vb", "qb"]
    local = min(gather, -(-2 * gather // blocks))  # twice its share of what is gathered, since blocks differ
    empty = pa.table({
        "qkey": pa.array([], pa.int64()), "slice": pa.array([], pa.int32()), "ids": pa.array([], pa.list_(pa.int64())),
        "scores": pa.array([], pa.list_(pa.int64())), "least": pa.array([], pa.int64()),
    })
    no_entry = empty.append_column("vb", pa.array([], pa.int32())).append_column("tau", pa.array([], pa.int64()))

    # phase 1
    def local_best(own: pa.Table, asked: pa.Table) -> pa.Table:
        if not own.num_rows or not asked.num_rows:
            return empty
        s, ids = _products(own, asked, "part"), own.column("vec_id").to_numpy()
        r, c = vectors.best_of(ids, s, local)
        return _list_rows(r, asked.column("qkey").to_numpy(), ids[c], s[r, c].astype(np.int64), asked.column("slice").to_numpy(),
                          s.min(axis=1).astype(np.int64))

    gathered = common.written(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(local_best, ENTRY), "topk-gathered")
    least = gathered.groupBy("qkey").pivot("slice", list(range(slices))).agg(F.min("least"))
    least = least.select("qkey", *[F.col(str(i)).alias(f"least{i}") for i in range(slices)])
    rank = F.row_number().over(Window.partitionBy("qkey", "slice").orderBy(F.desc("x.scores"), "x.ids"))
    listed = gathered.select("qkey", "slice", F.explode(F.arrays_zip("scores", "ids")).alias("x")).withColumn("r", rank)
    listed = listed.where(F.col("r") <= gather).select("qkey", F.col("x.ids").alias("vec_id")).distinct()
    exact = _scored(listed, rows, asked, blocks, query_blocks)
    place = F.row_number().over(Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id"))
    last = exact.withColumn("r", place).where(F.col("r") <= k + 1).groupBy("qkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("score").alias("low"))
    floor = sum((F.col(f"least{i}") for i in range(slices)), F.lit(0))
    # with fewer vectors than asked for, all are sufficient
    tau = F.when(F.col("n") > k, F.col("low")).otherwise(floor)
    cut = least.join(last, "qkey").withColumn("tau", tau).withColumn("room", F.col("tau") - floor)
    # shares are whole numbers that add up to tau
    shares = [F.col(f"least{i}") + F.expr(f"(room * {i + 1}) div {slices} - (room * {i}) div {slices}") for i in range(slices)]
    cut = common.written(cut.select("qkey", "tau", F.array(*shares).alias("shares")), "topk-cutoffs")

    # phase 2
    def sufficient(own: pa.Table, asked: pa.Table) -> pa.Table:
        if not own.num_rows or not asked.num_rows:
            return no_entry
        s, ids = _products(own, asked, "part"), own.column("vec_id").to_numpy()
        share = asked.column("share").to_numpy()
        r, c = np.nonzero(s >= share[:, None])
        found = _list_rows(r, asked.column("qkey").to_numpy(), ids[c], s[r, c].astype(np.int64), asked.column("slice").to_numpy(), share)
        block = np.full(len(share), own.column("vb")[0].as_py(), np.int32)
        return found.append_column("vb", pa.array(block)).append_column("tau", asked.column("tau"))

    told = right.join(cut, "qkey").withColumn("share", F.col("shares")[F.col("slice")]).drop("shares")
    sent = left.groupBy(*keys).cogroup(told.groupBy(*keys)).applyInArrow(sufficient, SENT).where(F.size("ids") > 0)
    meeting = vectors.block_of("qkey", vectors.block_count(n // vectors.QUERY_STEP, MEETING_BLOCK))
    met = sent.groupBy("vb", meeting.alias("mb")).applyInArrow(lambda entries: meet(entries, k, slices), MET)
    met = common.written(met, "topk-met")
    done = met.where(F.col("n_slices") == slices).select("qkey", "vec_id", F.col("known").alias("score"))
    better = done.withColumn("r", place).where(F.col("r") == k + 1).select("qkey", F.col("score").alias("higher"))

    # phase 3
    cutoff = cut.join(better, "qkey", "left").select("qkey", "tau", F.greatest("tau", "higher").alias("cutoff"))
    open_ = met.where(F.col("n_slices") < slices).join(cutoff, "qkey")
    bound = upper_bound(F.col("known"), F.col("told"), F.col("n_slices"), F.col("tau"), slices)
    rest = _scored(open_.where(bound >= F.col("cutoff")).select("qkey", "vec_id"), rows, asked, blocks, query_blocks)
    return vectors.ranked(done.unionByName(rest), queries, k)


def _scored(pairs: DataFrame, rows: DataFrame, asked: DataFrame, blocks: int, query_blocks: int) -> DataFrame:
    """Exact scores of (qkey, vec_id) pairs, block by block: a task has the vectors of a block, and the queries with the
    lists of the ids that they want of it."""
    keys = ["vb", "qb"]
    components = "v"
    vb, qb = vectors.block_of("vec_id", blocks), vectors.block_of("qkey", query_blocks)
    wanted = pairs.select("qkey", vb.alias("vb"), "vec_id").groupBy("qkey", "vb").agg(F.collect_list("vec_id").alias("ids"))
    wanted = wanted.join(asked, "qkey").withColumn("qb", qb)
    left = rows.withColumn("vb", vb).withColumn("qb", vectors.every_block(query_blocks))
    kind = pa.table({"qkey": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})

    def score(own: pa.Table, asked: pa.Table) -> pa.Table:
        if not own.num_rows or not asked.num_rows:
            return kind
        size = len(own.column(components)[0])
        m, q = vectors.matrix(own.column(components), size, np.int64), vectors.matrix(asked.column(components), size, np.int64)
        ids = own.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        lists = asked.column("ids").combine_chunks()
        at = np.repeat(np.arange(len(q)), np.asarray(lists.value_lengths()))
        to = np.asarray(lists.flatten())
        row = order[np.searchsorted(ids, to, sorter=order)]
        scores = np.concatenate([np.zeros(0, np.int64), *[
            np.einsum("ij,ij->i", q[at[a:a + 65536]], m[row[a:a + 65536]]) for a in range(0, len(at), 65536)]])
        return pa.table({"qkey": asked.column("qkey").to_numpy()[at], "vec_id": to, "score": scores})

    return left.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInArrow(score, "qkey long, vec_id long, score long")


def op7_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest scores of every twentieth vector."""
    return search(common.table(spark, sf_dir, "embeddings"))
