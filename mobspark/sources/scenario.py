"""Scenario parameters from JSON text: one row per file (case_name, file_name, content).

Missing paths give NULL. Bracket paths keep keys with spaces addressable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCENARIO_FILES = ["scenario_abm.modified.json", "scenario_abm_trajectories.modified.json"]
FLEET_FILES = ["SAEVFleetModel_optimization.json"]
POOLING_FILE = "PoolingModel.json"
DEFAULT_INTERVAL_S = 900


def read_model_files(spark: SparkSession, root: str, file_names: Sequence[str], newest: DataFrame | None = None) -> DataFrame:
    """Whole-file text of the named JSON files below ``root/<case>/``.

    With ``newest`` (case_name, dir_name; see ``catalog.latest_iteration``) only the files of that iteration directory
    and those of the case directory itself are read, so parameters never mix iterations; cases without such a directory
    have none. Without it every case may have one iteration directory only.
    """
    parts = F.split(F.substring_index("file_path", root.rstrip("/") + "/", -1), "/")
    files = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
        .text(root, wholetext=True)
        .select("value", "_metadata.file_path", "_metadata.file_name")
        .where(F.col("file_name").isin(*file_names))
        .select(
            F.get(parts, 0).alias("case_name"), F.when(F.size(parts) > 2, F.get(parts, 1)).alias("_dir"),
            "file_name", F.col("value").alias("content"),
        )
    )
    if newest is not None:
        files = files.join(newest.select("case_name", "dir_name"), "case_name").where("_dir IS NULL OR _dir = dir_name")
    return files.select("case_name", "file_name", "content")


def case_folders(newest: DataFrame) -> DataFrame:
    """The label ``<case>_<iteration>`` that tables and reports know a case by: case_name, dir_name, folder."""
    return newest.select("case_name", "dir_name", F.concat_ws("_", "case_name", F.col("iteration").cast("string")).alias("folder"))


def params_by_folder(params: DataFrame, newest: DataFrame) -> DataFrame:
    """Parameters under the labels of their cases' newest iterations."""
    return params.join(case_folders(newest).select("case_name", "folder"), "case_name").drop("case_name")


def json_value(content: str | Column, path: Sequence[str]) -> Column:
    """Text at a path of keys, NULL if any key is missing."""
    return F.get_json_object(F.col(content) if isinstance(content, str) else content,
                             "$" + "".join(f"['{key}']" for key in path))


def first_existing(files: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Per case the content of the first candidate file that exists."""
    rank = F.array_position(F.array(*[F.lit(c) for c in candidates]), F.col("file_name"))
    return (
        files.where(F.col("file_name").isin(*candidates))
        .groupBy("case_name")
        .agg(F.min_by("content", rank).alias("content"))
    )


def case_params(files: DataFrame) -> DataFrame:
    """trip_multiplier = 1 / scale factor, fleet size (with fallback key) and database name per case."""
    fleet_base = ["Operator_1", "Fleet_Base"]
    scenario = first_existing(files, SCENARIO_FILES).select(
        "case_name",
        F.try_divide(
            F.lit(1.0), json_value("content", ["Population synthesizer controls", "traffic_scale_factor"]).try_cast("double")
        ).alias("trip_multiplier"),
        json_value("content", ["General simulation controls", "database_name"]).alias("database_name"),
    )
    fleet = first_existing(files, FLEET_FILES).select(
        "case_name",
        F.coalesce(
            json_value("content", [*fleet_base, "Operator_1_TNC_FLEET_SIZE"]),
            json_value("content", [*fleet_base, "TNC_FLEET_SIZE"]),
        ).try_cast("bigint").alias("fleet_size"),
    )
    return scenario.join(fleet, "case_name", "left").select("case_name", "trip_multiplier", "fleet_size", "database_name")


def pricing_params(files: DataFrame) -> DataFrame:
    def price(key: str) -> Column:
        return json_value("content", ["Scenario controls", key]).try_cast("double")

    return first_existing(files, SCENARIO_FILES).select(
        "case_name", price("rideshare_cost_per_minute").alias("per_minute"),
        price("rideshare_cost_per_mile").alias("per_mile"), price("rideshare_base_fare").alias("base_fare"),
    )


def strategy_params(files: DataFrame, default: str = "default") -> DataFrame:
    """Assignment and repositioning strategy of the operator, looked up through its strategy name.

    Without a name or an assignment entry the strategy is ``default``.
    """
    sections = F.from_json("content", "map<string,string>")
    named = first_existing(files, FLEET_FILES).select(
        "case_name", json_value("content", ["Operator_1", "strategy_name"]).alias("strategy_name"),
        sections.alias("sections"),
    )
    chosen = F.element_at("sections", F.col("strategy_name"))
    return named.select(
        "case_name", "strategy_name",
        F.coalesce(json_value(chosen, ["assignment_strategy"]), F.lit(default)).alias("assignment_strategy"),
        json_value(chosen, ["reposition_strategy"]).alias("repositioning_strategy"),
    )


def repositioning_interval(files: DataFrame) -> DataFrame:
    interval = json_value("content", ["DRS_Discount_AR", "repositioning_batched_interval_seconds"]).try_cast("bigint")
    return first_existing(files, FLEET_FILES).select(
        "case_name", F.coalesce(interval, F.lit(DEFAULT_INTERVAL_S)).cast("bigint").alias("interval_s")
    )


def pooling_discount(files: DataFrame) -> DataFrame:
    return first_existing(files, [POOLING_FILE]).select(
        "case_name",
        json_value("content", ["TNC_Pooling_Model", "CU_DEFAULT_POOLING_DISCOUNT"]).try_cast("double").alias("pooling_discount"),
    )


def all_params(files: DataFrame) -> DataFrame:
    """Every case constant the reports need, keyed by case_name."""
    out = case_params(files)
    for part in (pricing_params(files), strategy_params(files).drop("strategy_name"), pooling_discount(files)):
        out = out.join(part, "case_name", "left")
    return out


def config_audit(files: DataFrame, path: Sequence[str], file_names: Sequence[str] | None = None) -> DataFrame:
    """One JSON path's value for every case and file; a missing key is a NULL row."""
    chosen = files if file_names is None else files.where(F.col("file_name").isin(*file_names))
    return chosen.select("case_name", "file_name", F.lit(path[-1]).alias("key"), json_value("content", path).alias("value"))


MAX_DEPTH = 12


def json_leaves(files: DataFrame, depth: int = MAX_DEPTH) -> DataFrame:
    """(case_name, file_name, path, value): every leaf of the files' JSON as text, and empty objects and lists.

    Levels are opened one by one without a shuffle. What lies deeper than ``depth`` is a leaf as JSON text, so nothing is
    lost. JSON null is NULL; a file that is no JSON is one leaf. Of keys that repeat in an object the last counts.
    """
    value, path = F.col("value"), F.col("path")
    rows = files.select("case_name", "file_name", F.lit("$").alias("path"), F.trim("content").alias("value"))

    def inner(e: Column) -> Column:
        plain = e["key"].rlike("^[A-Za-z_][A-Za-z0-9_]*$")
        key = F.when(plain, e["key"]).otherwise(F.concat(F.lit('"'), F.replace(e["key"], F.lit('"'), F.lit('\\"')), F.lit('"')))
        return F.struct(F.concat(path, F.lit("."), key).alias("path"), e["value"].alias("value"))

    own = F.array(F.struct(path.alias("path"), value.alias("value")))
    entries, items = F.map_entries(F.from_json(value, "map<string,string>")), F.from_json(value, "array<string>")
    kids = (
        F.when(value.startswith("{") & (F.size(entries) > 0), F.transform(entries, inner))
        .when(value.startswith("[") & (F.size(items) > 0), F.transform(
            items, lambda x, i: F.struct(F.concat(path, F.lit("["), i.cast("string"), F.lit("]")).alias("path"), x.alias("value"))))
        .otherwise(own)
    )
    for _ in range(depth):
        rows = rows.select("case_name", "file_name", F.explode(kids).alias("kid")).select("case_name", "file_name", "kid.path", "kid.value")
    return rows


def config_differences(files: DataFrame, file_names: Sequence[str] | None = None, depth: int = MAX_DEPTH) -> DataFrame:
    """All paths in which the cases that have a file differ: file_name, path, n_cases with the path, n_missing without it, n_values
    (different ones, JSON null among them), and the first and last value as text.

    Values are counted per path and value first, so a path that all cases share is one row by the time it is compared.
    """
    chosen = files if file_names is None else files.where(F.col("file_name").isin(*file_names))
    cases = chosen.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_files"))
    values = json_leaves(chosen, depth).groupBy("file_name", "path", "value").agg(F.count(F.lit(1)).alias("n"))
    paths = values.groupBy("file_name", "path").agg(
        F.sum("n").alias("n_cases"), F.count(F.lit(1)).alias("n_values"), F.min("value").alias("first_value"), F.max("value").alias("last_value"))
    return paths.join(cases, "file_name").withColumn("n_missing", F.col("n_files") - F.col("n_cases")).where(
        "n_values > 1 OR n_missing > 0").select("file_name", "path", "n_cases", "n_missing", "n_values", "first_value", "last_value")
