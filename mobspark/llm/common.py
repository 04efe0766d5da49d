"""Helpers shared by the operators: tables, the shared folder, splits, connected components."""

from __future__ import annotations

import atexit
import ctypes
import gc
import io
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HELD_OUT_REMAINDER = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Make this library importable in Python workers, once per application (Spark serves the file itself)."""
    sc = spark.sparkContext
    if getattr(sc, "_mobspark_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(root, "mobspark")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    path = os.path.join(tempfile.mkdtemp(prefix="mobspark-"), "mobspark_package.zip")
    with open(path, "wb") as f:
        f.write(packed.getvalue())
    sc.addPyFile(path)
    sc._mobspark_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only where that is unset, a folder of our own is taken: a temporary one in local mode (as in tests), else one
    below the warehouse, which is shared too.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    own = getattr(sc, "_mobspark_shared", None)
    if own is None:
        if sc.master.startswith("local[") or sc.master == "local":
            folder = tempfile.mkdtemp(prefix="mobspark-shared-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            own = f"file://{folder}"
        else:
            own = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_mobspark_shared"
        sc._mobspark_shared = own
    return own


def new_folder(spark: SparkSession, kind: str) -> str:
    path = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    atexit.register(_delete_quietly, spark, path)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of our own on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _delete_quietly(spark: SparkSession, path: str) -> None:
    try:
        delete_folder(spark, path)
    except Exception:  # the application is ending; the session may be gone
        pass


def written(df: DataFrame, kind: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = new_folder(df.sparkSession, kind)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._mobspark_path = path
    return out


def drop_written(df: DataFrame | None) -> None:
    path = getattr(df, "_mobspark_path", None)
    if path:
        delete_folder(df.sparkSession, path)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, which hands back the memory that it no longer uses when a task ends: Spark keeps its Python workers for the
    tasks of later stages, and what their allocators hold on to counts for the executor."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim := _malloc_trim():
            trim(0)

    return wrapped


@lru_cache(maxsize=1)
def _malloc_trim() -> Callable[[int], int] | None:
    """The C library's call that hands back free memory below what is in use, too (glibc only); freeing alone hands back what
    lies above."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.

    It does so whenever the driver's memory is collected, which a driver with little to do may not do for half an hour; to
    be called after a large plan's result was written. The first round lets go of the plans, the second of their shuffles.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()


def broadcast_if_small(df: DataFrame, most_mb: int, source: DataFrame | None = None) -> DataFrame:
    """Hint to broadcast a table if the files of ``source`` (by default itself), a written table that it is a projection
    of, are checked to hold at most ``most_mb``; beyond it Spark shuffles."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path((df if source is None else source)._mobspark_path)
    files = path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    return F.broadcast(df) if files.getContentSummary(path).getLength() <= most_mb << 20 else df


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4, is 2 (null ids: false)."""
    rest = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4
    return F.coalesce(rest == HELD_OUT_REMAINDER, F.lit(False))


def bounded_sample(df: DataFrame, group: str, rows_per_group: int, key: str = "doc_id") -> DataFrame:
    """About ``rows_per_group`` rows of each group at most (all, if fewer), chosen by a hash of ``key``.

    The share of a group that is taken follows from its count, so the expected size is bounded at every scale.
    """
    counts = {r[0]: r[1] for r in df.groupBy(group).count().collect()}
    keep = F.lit(False)
    unit = F.pmod(F.xxhash64(F.col(key), F.lit(71)), F.lit(1 << 30)) / float(1 << 30)
    for value, n in sorted(counts.items(), key=lambda x: str(x[0])):
        keep = F.when(F.col(group).eqNullSafe(F.lit(value)), unit < rows_per_group / max(n, 1)).otherwise(keep)
    return df.where(keep)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long); component is its smallest node.

    Alternating large-star and small-star steps. Each round is written to the shared folder, so plans stay short and
    a lost executor costs one round. Nothing but two counters per round reaches the driver.
    """

    def star(sym: DataFrame, larger: bool) -> DataFrame:
        # sym: (u, v) pairs; large star hangs the larger neighbours of u, small star the others and u itself
        if larger:
            least = sym.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
            out = sym.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            least = sym.groupBy("u").agg(F.min("v").alias("m"))
            near = sym.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
            out = near.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def both(e: DataFrame) -> DataFrame:
        return e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))

    def downward(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    seen = mark(current)
    while seen[0]:
        large = star(both(current), True)
        nxt = written(star(downward(large), False), "cc")
        now = mark(nxt)
        drop_written(current)
        current, before, seen = nxt, seen, now
        if now == before:
            break
    members = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.union(roots)
