"""Keyed report store: versioned Parquet snapshots per key, committed by one rename; CSV export, incremental runs.

Below ``root/<key>`` (a shared path on a cluster) lie

* ``data/run=<id>/folder=<case>/``: the rows that one run wrote, never changed afterwards;
* ``versions/v<number>/``: the manifest of a version, a table with a row for each finished case: the run that holds its
  rows, their number, and the fingerprint of the inputs they came from.

A run writes its data, then its manifest under a draft name, and renames that to the next number. Readers open the newest
version and only the runs that it names, so whatever fails before the rename changes nothing for them, and two writers
cannot commit the same number. Cases without rows are in the manifest with 0 rows, so they count as finished. Superseded
runs stay, for readers of older versions, until ``vacuum``.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobspark.sources.catalog import text_partitions

MANIFEST = "folder string, run string, rows long, fingerprint string, schema string"
_VERSION = re.compile(r"v(\d{9})$")


class CommitConflict(RuntimeError):
    """Another writer committed the version first."""


class ReportStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ---- versions ----------------------------------------------------------------------------------------------------

    def path(self, key: str) -> str:
        return f"{self.root}/{key}"

    def versions(self, key: str) -> list[int]:
        """Numbers of the committed versions, ascending."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.globStatus(path(f"{self.path(key)}/versions/v*")) or []]
        return sorted(int(m[1]) for m in map(_VERSION.match, names) if m)

    def manifest(self, key: str, version: int | None = None) -> DataFrame | None:
        """The manifest of a version, by default of the newest one; None if there is none."""
        if version is None:
            known = self.versions(key)
            if not known:
                return None
            version = known[-1]
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path(key)}/versions/v{version:09d}")

    def _commit(self, key: str, version: int, manifest: DataFrame) -> None:
        """Write a manifest and make it the given version by one rename, which fails if that exists."""
        draft = f"{self.path(key)}/versions/.draft-{uuid.uuid4().hex}"
        # the number of files follows from the amount of data, as for the rows
        manifest.select(*[c.split()[0] for c in MANIFEST.split(", ")]).hint("rebalance").write.parquet(draft)
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        conf = self.spark._jsc.hadoopConfiguration()
        place = hadoop.Path(f"{self.path(key)}/versions/v{version:09d}")
        options = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            hadoop.FileContext.getFileContext(place.toUri(), conf).rename(hadoop.Path(draft), place, options)
        except Py4JJavaError as e:
            hadoop.Path(draft).getFileSystem(conf).delete(hadoop.Path(draft), True)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                raise CommitConflict(f"version {version} of {key} was committed by another writer") from e
            raise

    # ---- rows --------------------------------------------------------------------------------------------------------

    def _write_run(self, key: str, df: DataFrame) -> str:
        """Write rows as a new run; they belong to no version yet.

        Rows are dealt out by case first, in parts of the advisory size, so that the number of files follows from the
        number of cases and the amount of data, not from the number of tasks.
        """
        run = uuid.uuid4().hex
        place = f"{self.path(key)}/data/run={run}"
        if "folder" in df.columns:
            df.hint("rebalance", "folder").write.partitionBy("folder").parquet(place)
        else:
            df.write.parquet(place)
        return run

    def _open_runs(self, key: str, runs: Sequence[str], schema: T.StructType) -> DataFrame:
        """The rows of some runs, with the column ``run``."""
        below = f"{self.path(key)}/data"
        whole = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
        if not runs:
            return self.spark.createDataFrame([], whole)
        with text_partitions(self.spark):
            return self.spark.read.schema(whole).option("basePath", below).parquet(*[f"{below}/run={r}" for r in runs])

    def _new_rows(self, key: str, run: str, cases: DataFrame | None, schema: T.StructType) -> DataFrame:
        """Manifest rows of a run for ``cases`` (folder and, if known, fingerprint), or for those it has rows of."""
        text = json.dumps(schema.jsonValue())
        rows = self._open_runs(key, [run], schema)
        if "folder" not in schema.names:
            counts = rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("folder", F.lit(None).cast("string"))
        else:
            counts = rows.groupBy("folder").agg(F.count(F.lit(1)).alias("rows"))
            if cases is not None:
                counts = cases.join(counts, "folder", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
        mark = F.col("fingerprint") if "fingerprint" in counts.columns else F.lit(None).cast("string")
        return counts.select("folder", F.lit(run).alias("run"), "rows", mark.alias("fingerprint"), F.lit(text).alias("schema"))

    def write(self, key: str, df: DataFrame, cases: DataFrame | None = None, bad: Column | None = None) -> set[str]:
        """Commit a version in which the rows of ``cases`` (by default, of those in ``df``) are those of ``df``; other cases
        stay as they are. Rows without a folder belong to no case and aren't read again.

        ``bad`` is a condition on the rows of ``df`` that no row may meet. It is looked at while they are written; cases in
        which it holds are left out of the version and keep what they had. Their names are returned. Columns of ``df``
        that begin with an underscore are for the condition only and aren't stored.
        """
        before = self.versions(key)
        version = before[-1] + 1 if before else 1
        stored = df
        if bad is not None:
            seen = Observation()
            found = F.collect_set(F.when(bad, F.col("folder"))).alias("bad")  # names of cases, not rows
            stored = df.observe(seen, found).drop(*[c for c in df.columns if c.startswith("_")])
        run = self._write_run(key, stored)
        rejected = set(seen.get["bad"]) if bad is not None else set()
        new = self._new_rows(key, run, cases, stored.schema)
        if rejected:
            new = new.where(~F.col("folder").isin(*rejected))
        if before and "folder" in stored.columns:
            new = self.manifest(key, before[-1]).join(new.select("folder"), "folder", "left_anti").unionByName(new)
        self._commit(key, version, new)
        return rejected

    def replace(self, key: str, df: DataFrame) -> None:
        """Commit a version that holds the rows of ``df`` only."""
        before = self.versions(key)
        run = self._write_run(key, df)
        self._commit(key, before[-1] + 1 if before else 1, self._new_rows(key, run, None, df.schema))

    def read_or_none(self, key: str, version: int | None = None) -> DataFrame | None:
        manifest = self.manifest(key, version)
        if manifest is None:
            return None
        # one row for each run that still holds a case, not for each case
        runs = manifest.groupBy("run", "schema").agg(F.max("rows").alias("rows")).collect()
        if not runs:  # every case of the only run was rejected
            return None
        filled = [r for r in runs if r["rows"]]
        schemas = [T.StructType.fromJson(json.loads(text)) for text in sorted({r["schema"] for r in runs})]
        schema = _widest(sorted(schemas, key=len, reverse=True))
        rows = self._open_runs(key, [r["run"] for r in filled], schema)
        if "folder" not in schema.names:
            return rows.drop("run")
        return rows.join(manifest.where("rows > 0").select("folder", "run"), ["folder", "run"], "left_semi").select(*schema.names)

    def read(self, key: str, version: int | None = None) -> DataFrame:
        found = self.read_or_none(key, version)
        if found is None:
            raise KeyError(f"{key} isn't stored")
        return found

    def finished(self, key: str) -> DataFrame | None:
        """(folder, fingerprint) of the cases whose report is stored, with rows or without any."""
        manifest = self.manifest(key)
        return None if manifest is None else manifest.select("folder", "fingerprint")

    def refresh(self, key: str, cases: DataFrame, compute: Callable[[DataFrame], DataFrame], force: bool = False,
                bad: Column | None = None, rejected: set[str] | None = None) -> DataFrame:
        """Compute only the cases that have to be (all of them if forced), commit them, and return the table.

        ``cases`` has a row for each folder and may have the ``fingerprint`` of its inputs; then a case whose stored
        fingerprint differs is computed anew, too. ``compute`` gets a DataFrame of the folders to do and returns the report
        for them. A case without rows counts as finished; one that is computed anew loses its old rows, at the commit.
        Names of cases in which ``bad`` holds (see ``write``) are added to ``rejected``; they stay to be done.
        """
        marked = "fingerprint" in cases.columns
        rows = cases.groupBy("folder").agg(F.first("fingerprint").alias("fingerprint")) if marked else cases.select("folder").distinct()
        done = self.finished(key)
        todo = rows if force or done is None else pending(rows, done)
        if todo.isEmpty():
            return self.read_or_none(key) if self.versions(key) else compute(todo.select("folder"))
        found = self.write(key, compute(todo.select("folder")), todo, bad)
        if rejected is not None:
            rejected |= found
        return self.read(key)

    def vacuum(self, key: str, keep: int = 1) -> int:
        """Delete what none of the ``keep`` newest versions needs: older manifests, drafts, and runs they don't name,
        among them those of failed runs. Not to be called while a writer is at work. The number of runs deleted."""
        if keep < 1:
            raise ValueError("at least the newest version has to stay")
        known = self.versions(key)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        needed = {r.run for v in known[-keep:] for r in self.manifest(key, v).where("rows > 0").select("run").distinct().collect()}
        for status in files.globStatus(path(f"{self.path(key)}/versions/*")) or []:
            m = _VERSION.match(status.getPath().getName())
            if not m or int(m[1]) not in known[-keep:]:
                files.delete(status.getPath(), True)
        gone = 0
        for status in files.globStatus(path(f"{self.path(key)}/data/run=*")) or []:
            if status.getPath().getName().removeprefix("run=") not in needed:
                gone += files.delete(status.getPath(), True)
        return gone


def pending(cases: DataFrame, done: DataFrame) -> DataFrame:
    """Cases that aren't done, or whose fingerprint isn't the one they were done with."""
    if "fingerprint" not in cases.columns:
        return cases.join(done.select("folder"), "folder", "left_anti")
    return cases.join(
        done.select("folder", F.col("fingerprint").alias("_done")).withColumn("_known", F.lit(True)), "folder", "left"
    ).where("_known IS NULL OR NOT _done <=> fingerprint").drop("_done", "_known")


def _widest(schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns of the runs, in the order in which they come up; a run that lacks one has NULL there."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            known = fields.setdefault(f.name, T.StructField(f.name, f.dataType))
            if known.dataType != f.dataType:
                raise ValueError(f"column {f.name} is {known.dataType.simpleString()} in one run, {f.dataType.simpleString()} in another")
    return T.StructType(list(fields.values()))


def fingerprints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(folder, table, fingerprint): what the rows of each case in each table hash to, in any order of the rows.

    The number of rows and the exact sums of two 64-bit hashes of each row, so equal rows count as often as they occur.
    One scan and one aggregate for each table, with a row for each case.
    """
    out = None
    for name, df in sorted(tables.items()):
        columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
        sums = [F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")) for seed in (1, 2)]
        marks = df.groupBy("folder").agg(F.concat_ws("-", F.count(F.lit(1)), *sums, F.lit(",".join(sorted(df.columns)))).alias("fingerprint"))
        rows = marks.select("folder", F.lit(name).alias("table"), F.sha2("fingerprint", 256).alias("fingerprint"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no tables to take fingerprints of")
    return out


def combined(marks: DataFrame, tables: Iterable[str]) -> DataFrame:
    """(folder, fingerprint) over some of the tables."""
    each = F.sort_array(F.collect_list(F.concat_ws(":", "table", "fingerprint")))  # one entry for each table
    return marks.where(F.col("table").isin(*tables)).groupBy("folder").agg(F.sha2(F.concat_ws("|", each), 256).alias("fingerprint"))


def write_csv(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """CSV files; with ``order`` the rows are sorted over all files."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").option("header", "true").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").csv(path)
