"""Vectors as the two searches use them: clean ones, one row for each distinct vector and id that can be found, and blocks
of queries against blocks of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Queries, and vectors, that one task handles together.
QUERY_BLOCK = 2048
VECTOR_BLOCK = 8192
#: Rows whose id is divisible by this are queries.
QUERY_STEP = 20


def clean(df: DataFrame, vec_id: str, vector: str, zero_too: bool) -> DataFrame:
    """(vec_id, v): vectors without null or non-finite components, as doubles; zero vectors only if ``zero_too``."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col(vector).isNotNull() & F.col(vec_id).isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True)))
    return rows if zero_too else rows.where(F.exists("v", lambda x: x != 0))


def unique(rows: DataFrame) -> DataFrame:
    """One row for each vec_id, with the smallest of its vectors; only shuffled if an id repeats."""
    if rows.groupBy("vec_id").count().where("count > 1").head(1):
        return rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    return rows


def width(df: DataFrame, vector: str = "v") -> int:
    """The common number of components (0 without any row); vectors of several widths raise."""
    low, high = df.agg(F.min(F.size(vector)), F.max(F.size(vector))).first()
    if low != high:
        raise ValueError(f"vectors have from {low} to {high} components")
    return low or 0


def findable(vectors: DataFrame, k: int) -> DataFrame:
    """Of each distinct vector the k + 1 smallest ids. No result needs another one: its k nearest are ordered by score and
    then id, and only the query's own row is left out. Map tasks pass on no more than that of a vector either."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    return vectors.withColumn("r", rank).where(F.col("r") <= k + 1).drop("r")


def query_rows(vectors: DataFrame) -> DataFrame:
    """(query_id, v) of all queries."""
    return vectors.where(F.col("vec_id") % QUERY_STEP == 0).select(F.col("vec_id").alias("query_id"), "v")


def distinct_queries(queries: DataFrame) -> DataFrame:
    """(qkey, v): each distinct query vector once, under the smallest id of the queries that have it."""
    return queries.groupBy("v").agg(F.min("query_id").alias("qkey"))


def block_count(n: int, size: int) -> int:
    return max(1, -(-n // size))


def block_of(column: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(column), F.lit(blocks)), F.lit(blocks)).cast("int")


def every_block(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))


def matrix(column: pa.Array | pa.ChunkedArray, components: int, kind=np.float64) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).astype(kind, copy=False).reshape(-1, components)


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the k highest scores of each row, ties to the smaller id: (row, column), rows ascending. Scores of minus
    infinity are none."""
    n, m = scores.shape
    if m > k:
        least = np.partition(scores, m - k, axis=1)[:, m - k]
        row, col = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
    else:
        row, col = np.nonzero(scores > -np.inf)
    order = np.lexsort((ids[col], -scores[row, col], row))
    row, col = row[order], col[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    return row[nth < k], col[nth < k]


def ranked(found: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): of what was found for each distinct query vector (qkey, vec_id, score; k + 1 of
    them at least if there are so many), the k best of every query, without its own row."""
    distinct = distinct_queries(queries)
    top = F.row_number().over(Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id"))
    best = found.withColumn("r", top).where(F.col("r") <= k + 1).drop("r")
    named = queries.join(distinct, "v").select("query_id", "qkey")
    own = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    rows = named.join(best, "qkey").where("vec_id <> query_id").withColumn("rank", own).where(F.col("rank") <= k)
    return rows.select("query_id", "rank", "vec_id", "score")
