"""Approximate nearest neighbours by an inverted multi-index (operator 5).

Vectors are split into two halves, and each half has its own k-means centroids, fitted on a bounded sample. A vector's
cell is the pair of its halves' centroids; every vector is indexed, under its cell. A query walks the pairs in the order
of their summed distance, with a heap over the two sorted lists, until the cells it met hold the wanted share of all
vectors, and the vectors of those cells are ranked by their exact inner products.

Distances are squared Euclidean ones, so their sum is the distance of the query to the joined centroids. For vectors of unit
length, as embeddings are, the nearest by distance have the largest inner products. For vectors of very different lengths
the walk can go by the summed inner products instead (``by_distance=False``).

Cells are dealt out by the first centroid and cut into blocks; a task ranks one block of vectors for one block of
queries and passes on the best of each query. Copies of a vector stand for it by their smallest ids only, which is all
that a result can hold, and equal queries are searched once.

Null, zero and non-finite vectors take no part, nor do pairs whose inner product overflows. Vectors of one component or of
several widths raise ValueError. Rows that repeat a vec_id count once, with the
smallest of their vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mobspark.llm import common, vectors

K = 20
#: Vectors that the centroids are fitted on, centroids of each half, rounds of k-means.
SAMPLE = 20_000
CENTROIDS = 64
ROUNDS = 12
#: Share of all vectors whose cells a query visits, and vectors that it visits at least.
SHARE = 0.5
LEAST = 2000


def kmeans(rows: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """Centroids of rows; first ones drawn apart from each other (k-means++)."""
    rng = np.random.default_rng(seed)
    k = min(k, len(np.unique(rows, axis=0)))
    centers = rows[rng.integers(len(rows))][None]
    gap = ((rows - centers[0]) ** 2).sum(axis=1)
    while len(centers) < k:
        pick = rows[np.searchsorted(np.cumsum(gap), rng.random() * gap.sum())]
        centers = np.concatenate([centers, pick[None]])
        gap = np.minimum(gap, ((rows - pick) ** 2).sum(axis=1))
    for _ in range(rounds):
        own = nearest(rows, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, rows)
        n = np.bincount(own, minlength=len(centers))
        centers = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centers)
    return centers


def nearest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers**2).sum(axis=1) - 2 * rows @ centers.T, axis=1)


class Codebooks:
    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second

    @property
    def split(self) -> int:
        return self.first.shape[1]

    def cells(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return nearest(rows[:, :self.split], self.first), nearest(rows[:, self.split:], self.second)

    def walk(self, query: np.ndarray, by_distance: bool = False) -> Iterator[tuple[int, int]]:
        """Pairs of centroids in the order of summed distance, or of summed inner products, largest first."""
        a, b = -(self.first @ query[:self.split]), -(self.second @ query[self.split:])
        if by_distance:  # but for the query's own square, which all pairs share
            a, b = 2 * a + (self.first**2).sum(axis=1), 2 * b + (self.second**2).sum(axis=1)
        i_of, j_of = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        heap, seen = [(a[i_of[0]] + b[j_of[0]], 0, 0)], {(0, 0)}
        while heap:
            _, i, j = heapq.heappop(heap)
            yield int(i_of[i]), int(j_of[j])
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(i_of) and y < len(j_of) and (x, y) not in seen:
                    seen.add((x, y))
                    heapq.heappush(heap, (a[i_of[x]] + b[j_of[y]], x, y))


def train(rows: DataFrame, components: int, n: int, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Codebooks:
    """Fit on about ``sample`` vectors at most, chosen by a hash of the id."""
    unit = F.pmod(F.xxhash64("vec_id", F.lit(55)), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.where(unit < sample / max(n, 1)) if n > sample else rows
    m = vectors.matrix(chosen.select("v").toArrow().column(0), components)
    half = components // 2
    return Codebooks(kmeans(m[:, :half], centroids), kmeans(m[:, half:], centroids))


def indexed(rows: DataFrame, books: Codebooks, components: int) -> DataFrame:
    """(vec_id, v, c1, c2)."""
    shared = rows.sparkSession.sparkContext.broadcast(books)  # 2 x CENTROIDS half vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c1, c2 = shared.value.cells(vectors.matrix(batch.column(1), components))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(c1.astype(np.int32)), pa.array(c2.astype(np.int32))], names=["vec_id", "v", "c1", "c2"])

    return rows.select("vec_id", "v").mapInArrow(run, "vec_id long, v array<double>, c1 int, c2 int")


def routes(queries: DataFrame, books: Codebooks, counts: dict[tuple[int, int], int], components: int, share: float, least: int,
           by_distance: bool) -> DataFrame:
    """(qkey, v, c1, c2s): the cells that a query visits, by their first centroid."""
    shared = queries.sparkSession.sparkContext.broadcast((books, counts))  # counts: CENTROIDS squared numbers
    wanted = max(least, share * sum(counts.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, counts = shared.value
        for batch in batches:
            keys, rows = batch.column(0).to_pylist(), vectors.matrix(batch.column(1), components)
            at, firsts, seconds = [], [], []
            for q, row in enumerate(rows):
                met, cells = 0, {}
                for c1, c2 in books.walk(row, by_distance):
                    if n := counts.get((c1, c2), 0):
                        cells.setdefault(c1, []).append(c2)
                        met += n
                    if met >= wanted:
                        break
                at += [q] * len(cells)
                firsts += cells
                seconds += cells.values()
            yield pa.RecordBatch.from_arrays([
                pa.array([keys[q] for q in at], pa.int64()), batch.column(1).take(pa.array(at, pa.int64())), pa.array(firsts, pa.int32()),
                pa.array(seconds, pa.list_(pa.int32())),
            ], names=["qkey", "v", "c1", "c2s"])

    # a walk is much work for a row of few bytes: keep the configured parallelism
    partitions = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return queries.select("qkey", "v").repartition(partitions, "qkey").mapInArrow(run, "qkey long, v array<double>, c1 int, c2s array<int>")


def search(df: DataFrame, k: int = K, share: float = SHARE, least: int = LEAST, vec_id: str = "vec_id", vector: str = "embedding",
           by_distance: bool = True) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest that were found for every query."""
    spark = df.sparkSession
    common.ship_package(spark)
    all_rows = vectors.unique(vectors.clean(df, vec_id, vector, zero_too=False))
    components = vectors.width(all_rows)
    if components < 2:
        if components:
            raise ValueError("vectors need two components at least")
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = vectors.query_rows(all_rows)
    rows = vectors.findable(all_rows, k)
    n = rows.count()
    books = train(rows, components, n)
    index = common.written(indexed(rows, books, components), "ann-index")
    counts = {(r[0], r[1]): r[2] for r in index.groupBy("c1", "c2").count().collect()}  # CENTROIDS squared at most
    first = {}
    for (c1, _), m in counts.items():
        first[c1] = first.get(c1, 0) + m
    blocks = F.lit(1)
    for c1, m in first.items():
        blocks = F.when(F.col("c1") == c1, vectors.block_count(m, vectors.VECTOR_BLOCK)).otherwise(blocks)
    probes = routes(vectors.distinct_queries(queries), books, counts, components, share, least, by_distance)
    query_blocks = vectors.block_count(n // vectors.QUERY_STEP, vectors.QUERY_BLOCK)
    left = index.withColumn("vb", F.pmod(F.xxhash64("vec_id"), blocks).cast("int")).withColumn("qb", vectors.every_block(query_blocks))
    right = probes.withColumn("qb", vectors.block_of("qkey", query_blocks)).withColumn(
        "vb", F.explode(F.sequence(F.lit(0), blocks - 1)))

    def rank(own: pa.Table, asked: pa.Table) -> pa.Table:
        if not own.num_rows or not asked.num_rows:
            return none
        rows, q = vectors.matrix(own.column("v"), components), vectors.matrix(asked.column("v"), components)
        ids, cell = own.column("vec_id").to_numpy(), own.column("c2").to_numpy()
        visited = np.zeros((len(q), int(cell.max()) + 1), bool)
        lists = asked.column("c2s").combine_chunks()
        at, to = np.repeat(np.arange(len(q)), np.asarray(lists.value_lengths())), np.asarray(lists.flatten())
        visited[at[to < visited.shape[1]], to[to < visited.shape[1]]] = True
        with np.errstate(over="ignore", invalid="ignore"):
            scores = q @ rows.T
            scores = np.where(visited[:, cell] & np.isfinite(scores), scores, -np.inf)
            # what rounding may have put below the k + 1 best goes on, too; ranks are given by the measure itself
            cut = np.partition(scores, -k - 1, axis=1)[:, -k - 1] if scores.shape[1] > k + 1 else np.full(len(q), -np.inf)
            margin = 1e-14 * components * np.sqrt((q**2).sum(axis=1)) * np.sqrt((rows**2).sum(axis=1).max())
            r, c = np.nonzero((scores > -np.inf) & (scores >= (cut - np.nan_to_num(margin, posinf=0.0))[:, None]))
            # component by component in order, as a later reader would compute it
            exact = np.einsum("ij,ij->i", q[r], rows[c])
        r, c, exact = r[np.isfinite(exact)], c[np.isfinite(exact)], exact[np.isfinite(exact)]
        return pa.table({"qkey": asked.column("qkey").to_numpy()[r], "vec_id": ids[c], "score": exact})

    none = pa.table({"qkey": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    keys = ["c1", "vb", "qb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(rank, "qkey long, vec_id long, score double")
    return vectors.ranked(found, queries, k)


def op5_multi_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every twentieth vector."""
    return search(common.table(spark, sf_dir, "embeddings"))
