"""Transit load reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobspark.functions.exprs import METRES_PER_MILE, count_if, ratio, sum_if
from mobspark.operators.joins import attach_case_rows, one_row_per_case
from mobspark.operators.shape import capped_histogram
from mobspark.plans.common import Tables, times_multiplier

REPLACEABLE_LOAD = 4
TRANSIT_AGGREGATORS = ["City", "Strategy"]
FOLDER_COLUMNS = ["City", "Strategy", "Fleet Size"]


def transit_trip_max_load_helper(t: Tables, params: DataFrame) -> DataFrame:
    """Per transit trip: maximum load, length-weighted occupancy, length, pattern and route.

    Links are reduced per vehicle run before the dimension joins. Runs without a timetable trip
    form one row per case without trip, pattern and route; its label is the lowest run id.
    """
    load = F.col("value_seated_load") + F.col("value_standing_load")
    runs = t["transit_vehicle_links"].groupBy("folder", "object_id").agg(
        F.max(load).alias("max_load"), F.sum(load * F.col("value_length")).alias("_weighted"),
        F.sum("value_length").alias("trip_length"),
    )
    trips = t["transit_trips"].select("folder", F.col("trip_id").alias("object_id"), "pattern_id", F.lit(True).alias("_found"))
    patterns = t["transit_patterns"].select("folder", "pattern_id", "route_id")
    known = runs.join(trips, ["folder", "object_id"], "left")
    group = F.when(F.col("_found"), F.col("object_id"))
    grouped = known.groupBy("folder", group.alias("_trip")).agg(
        F.min("object_id").alias("trip_id"), F.min("pattern_id").alias("pattern_id"), F.max("max_load").alias("max_load"),
        ratio(F.sum("_weighted"), F.sum("trip_length")).alias("AVO"), F.sum("trip_length").alias("trip_length"),
    )
    routed = grouped.drop("_trip").join(patterns, ["folder", "pattern_id"], "left")
    return times_multiplier(routed, params, ["max_load", "AVO"]).select(
        "folder", "trip_id", "pattern_id", "route_id", "max_load", "AVO", "trip_length"
    )


def transit_trip_max_load(t: Tables, params: DataFrame) -> DataFrame:
    """Number of empty trips and of routes whose maximum load is at most four, per case."""
    helper = transit_trip_max_load_helper(t, params)
    routes = helper.groupBy("folder", "route_id").agg(
        F.max("max_load").alias("max_load"), count_if(F.col("max_load") == 0).alias("empty_trips")
    )
    counts = routes.groupBy("folder").agg(
        F.sum("empty_trips").alias("empty_trips"),
        count_if(F.col("max_load") <= REPLACEABLE_LOAD).alias("tnc_replaceable_routes"),
    )
    merged = one_row_per_case([params.select("folder", F.lit(True).alias("known")), counts]).where("known")
    return merged.select("folder", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("empty_trips", "tnc_replaceable_routes")])


def bus_avo(t: Tables, params: DataFrame) -> DataFrame:
    """Mileage and trip occupancy of buses, links and miles by load class, per case.

    Links are first reduced to one row per case and distinct load, where the multiplier is attached.
    """
    load = F.col("value_seated_load") + F.col("value_standing_load")
    by_load = t["transit_vehicle_links"].groupBy("folder", load.alias("load")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value_length").alias("length")
    )
    scaled = attach_case_rows(by_load, params.select("folder", "trip_multiplier"), "inner")
    size = F.col("load") * F.col("trip_multiplier")
    classes = {
        "mass": size > 4, "pool": (size > 1) & (size <= 4), "solo": size == 1, "empt": size < 1,
    }
    measures = [
        ratio(F.sum(size * F.col("length")), F.sum("length")).alias("mileage_avo"),
        ratio(F.sum(F.col("load") * F.col("n")), F.sum("n")).alias("trip_avo"),
    ]
    for name, cond in classes.items():
        measures.append(F.coalesce(sum_if(cond, "n"), F.lit(0)).alias(f"cnt_{name}"))
        measures.append((sum_if(cond, "length") / METRES_PER_MILE).alias(f"dist_{name}"))
    return scaled.groupBy("folder").agg(*measures)


def avg_avo(helper: DataFrame, unit: str, aggregators: Sequence[str] = TRANSIT_AGGREGATORS) -> DataFrame:
    """Load and occupancy per pattern or trip (``unit``) and aggregator; needs the case columns."""
    label = unit.capitalize()
    key = f"{unit}_id"
    grouped = helper.where(F.col(key).isNotNull()).groupBy(*aggregators, key).agg(
        F.max("max_load").alias("Max_Load"), F.max("AVO").alias("Max_AVO"), F.avg("max_load").alias("Average_Max_Load"),
        F.avg("trip_length").alias("Average_Trip_Length"),
        ratio(F.sum(F.col("AVO") * F.col("trip_length")), F.sum("trip_length")).alias("_avo"),
    )
    return grouped.withColumns({
        f"Empty_{label}": F.col("Max_Load") == 0,
        f"TNC_Replaceable_{label}": F.col("Max_Load") <= REPLACEABLE_LOAD,
        "AVO": F.col("_avo"),
    }).drop("_avo")


def replaceable_cases(helper: DataFrame, unit: str, columns: Sequence[str] = FOLDER_COLUMNS) -> DataFrame:
    """Trips, distance and occupancy by replaceable and empty flag of the pattern or trip, per case."""
    label = unit.capitalize()
    key = f"{unit}_id"
    flags = [f"TNC_Replaceable_{label}", f"Empty_{label}"]
    units = helper.where(F.col(key).isNotNull()).groupBy(*columns, key, "folder").agg(
        F.max("max_load").alias("Max_Load"), F.max("AVO").alias("Max_AVO"),
        F.sum(F.col("AVO") * F.col("trip_length")).alias("Weighted"), F.sum("trip_length").alias("Length"),
        F.count("trip_length").alias("Trips"),
    ).withColumns({flags[0]: F.col("Max_Load") <= REPLACEABLE_LOAD, flags[1]: F.col("Max_Load") == 0})
    return units.groupBy(*columns, *flags, "folder").agg(
        F.sum("Trips").alias("Count"), F.sum("Weighted").alias("Weighted_AVO_Sum"), F.sum("Length").alias("Distance_Sum"),
        F.max("Max_Load").alias("Max_Load"), F.max("Max_AVO").alias("Max_AVO"),
    )


def avo_cases(helper: DataFrame, unit: str, columns: Sequence[str] = FOLDER_COLUMNS) -> DataFrame:
    """Case-level occupancy and mean distance over patterns or trips."""
    label = unit.capitalize()
    return (
        replaceable_cases(helper, unit, columns).groupBy(*columns)
        .agg(
            F.sum("Weighted_AVO_Sum").alias("Weighted_AVO_Sum"), F.sum("Distance_Sum").alias("Distance_Sum"),
            F.sum("Count").alias("Count"), F.max("Max_Load").alias("Max_Load"), F.max("Max_AVO").alias("Max_AVO"),
        )
        .withColumns({
            f"{label}_AVO": ratio("Weighted_AVO_Sum", "Distance_Sum"),
            f"{label}_Distance": ratio("Distance_Sum", "Count"),
        })
    )


def avo_histogram(helper: DataFrame, unit: str, aggregators: Sequence[str] = TRANSIT_AGGREGATORS) -> DataFrame:
    """Patterns or trips per occupancy bin (0.1 wide, 5.0+ overflow), zero-filled."""
    return capped_histogram(avg_avo(helper, unit, aggregators), aggregators, "AVO")
