"""Case catalogue: iteration directories, case tables, and cases missing from stored results."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mobspark.functions.naming import strip_last_part

ITERATION = r"^(.*)_iteration_(\d+)?$"
INITIAL = "abm_init_iteration"


def list_run_dirs(spark: SparkSession, root: str) -> DataFrame:
    """Iteration directories ``root/<case>/<directory>``: case_name, dir_name, finished.

    Only these two levels and the markers in them are listed, never the result files below; what comes back is a row
    for each directory.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    below = root.rstrip("/")
    finished = {s.getPath().getParent().toString() for s in files.globStatus(path(f"{below}/*/*/finished")) or []}
    rows = []
    for status in files.globStatus(path(f"{below}/*/*")) or []:
        if status.isDirectory():
            place = status.getPath()
            rows.append((place.getParent().getName(), place.getName(), place.toString() in finished))
    return spark.createDataFrame(rows, "case_name string, dir_name string, finished boolean")


def iteration_number(dir_name: Column) -> Column:
    """Number of an iteration directory, NULL if the name is none."""
    number = F.regexp_extract(dir_name, ITERATION, 2)
    return (
        F.when(dir_name.rlike(ITERATION), F.when(number == "", -1).otherwise(number.try_cast("bigint")))
        .when(dir_name.contains(INITIAL), 0)
        .cast("bigint")
    )


def latest_iteration(run_dirs: DataFrame, finished_only: bool = True) -> DataFrame:
    """Highest iteration directory per case: case_name, iteration, dir_name.

    ``*_iteration_`` without a number counts as -1, the initial directory as 0; anything else is not
    an iteration.
    """
    runs = run_dirs.where("finished") if finished_only else run_dirs
    return (
        runs.withColumn("iteration", iteration_number(F.col("dir_name")))
        .where("iteration IS NOT NULL")
        .groupBy("case_name")
        .agg(F.max("iteration").alias("iteration"), F.max_by("dir_name", F.struct("iteration", "dir_name")).alias("dir_name"))
    )


@contextmanager
def text_partitions(spark: SparkSession) -> Iterator[None]:
    """While a table is opened, partition values stay the text they are (``007``, ``0.20``, ``1e5``)."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read_case_tables(spark: SparkSession, root: str, tables: Sequence[str], schemas: Mapping[str, object] | None = None,
                     folders: Sequence[str] | None = None, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Tables stored as ``root/<table>/folder=<case>/``; a case subset prunes partitions."""
    out = {}
    for name in tables:
        reader = spark.read.format(fmt)
        if fmt == "csv":
            reader = reader.option("header", "true")
        if schemas and name in schemas:
            reader = reader.schema(schemas[name])
        with text_partitions(spark):
            df = reader.load(f"{root}/{name}")
        out[name] = df if folders is None else df.where(F.col("folder").isin(*folders))
    return out


def read_iteration_tables(spark: SparkSession, root: str, tables: Sequence[str], newest: DataFrame,
                          schemas: Mapping[str, object] | None = None, folders: Sequence[str] | None = None,
                          fmt: str = "parquet") -> dict[str, DataFrame]:
    """Tables as the simulation leaves them, ``root/<case>/<iteration directory>/<table>.<fmt>`` (a file or a directory), of the
    iterations in ``newest`` (case_name, dir_name; see ``latest_iteration``), under the label ``folder`` of each case.

    Other iterations aren't opened. The label follows from a file's path, so a filter on ``folder`` keeps Spark from
    opening the files of other cases; with ``folders`` their paths aren't even listed. A case without the table has no
    rows in it, and a table that no case has raises. What reaches the driver is a path for each case and table.
    """
    chosen = newest.select("case_name", "dir_name").where(folder_label(F.col("case_name"), F.col("dir_name")).isNotNull())
    if folders is not None:
        chosen = chosen.where(folder_label(F.col("case_name"), F.col("dir_name")).isin(*folders))
    wanted = {(r.case_name, r.dir_name) for r in chosen.collect()}
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    out = {}
    for name in tables:
        found = [s.getPath() for s in files.globStatus(path(f"{root.rstrip('/')}/*/*/{name}.{fmt}")) or []]
        paths = [p.toString() for p in found if (p.getParent().getParent().getName(), p.getParent().getName()) in wanted]
        if not paths and not (schemas and name in schemas):
            raise FileNotFoundError(f"no chosen iteration below {root} has {name}.{fmt}")
        reader = spark.read.format(fmt)
        if fmt == "csv":
            reader = reader.option("header", "true")
        if schemas and name in schemas:
            reader = reader.schema(schemas[name])
        if not paths:
            out[name] = spark.createDataFrame([], schemas[name]).withColumn("folder", F.lit(None).cast("string"))
            continue
        # the path as text has its special characters in percent codes, but a plus sign as it is
        place = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        parts = F.regexp_extract(place, rf"/([^/]+)/[^/]+/{re.escape(name)}\.{fmt}(/[^/]*)?$", 1), F.regexp_extract(
            place, rf"/([^/]+)/{re.escape(name)}\.{fmt}(/[^/]*)?$", 1)
        df = reader.load(paths)
        out[name] = df.select(folder_label(*parts).alias("folder"), *[c for c in df.columns if c != "folder"])
    return out


def folder_label(case_name: Column, dir_name: Column) -> Column:
    """The label ``<case>_<iteration>``, NULL if the directory is no iteration."""
    number = iteration_number(dir_name)
    return F.when(number.isNotNull(), F.concat_ws("_", case_name, number.cast("string")))


def missing_cases(discovered: DataFrame, stored: DataFrame) -> DataFrame:
    """Discovered case names without stored results; stored labels lose their iteration part first."""
    done = stored.select(strip_last_part("folder").alias("case_name")).distinct()
    return discovered.select("case_name").distinct().join(done, "case_name", "left_anti")


def pending_cases(all_cases: DataFrame, stored: DataFrame) -> DataFrame:
    """Case labels that still have to be computed."""
    return all_cases.select("folder").distinct().join(stored.select("folder").distinct(), "folder", "left_anti")


def zone_master(zones: DataFrame) -> DataFrame:
    """Distinct (City, zone) over the cases' zone tables; the city is the first part of the case name."""
    city = F.get(F.split("folder", "_"), 0)
    return zones.select(city.alias("City"), F.col("zone").cast("string").alias("zone")).distinct()


def zone_master_from_lists(zone_lists: Mapping[str, DataFrame], prefixes: Mapping[str, str]) -> DataFrame:
    """Union of one zone table per city, labelled with the city's prefix."""
    parts = [
        zone_lists[city].select(F.lit(prefix).alias("City"), F.col("zone").cast("string").alias("zone"))
        for city, prefix in prefixes.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
