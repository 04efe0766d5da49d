"""Household, zone and senior reports and their dashboard tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mobspark.functions.exprs import (
    METRES_PER_MILE, QUARTILES, WALK_LIMIT_MIN, WALK_MPH, age_class, age_class_activity, count_if, income_quartile, level,
    miles, named, ratio,
)
from mobspark.operators.joins import join_by_shuffle, left_join_spreading_nulls
from mobspark.operators.nearest import nearest_stop
from mobspark.operators.shape import melt, pivot_expected
from mobspark.plans.common import Tables, residents

SENIOR = 2
FOLDER_COLUMNS = ["City", "Strategy", "Fleet Size"]
DEMOGRAPHIC_AGGREGATORS = ["City", "age_class"]
TRAVEL_MODES = ["SOV", "TAXI", "BUS", "RAIL", "BICYCLE", "WALK"]
BUDGET_MODES = {"TNC": "TAXI", "SOV": "SOV", "Bus": "BUS", "Rail": "RAIL"}
UNKNOWN = "n/a"


# ---- per-case reports -----------------------------------------------------------------------------

def elder_demo(t: Tables) -> DataFrame:
    """Trips, households, miles, minutes and income by home zone, mode, activity type and age class.

    Trips are summed per person before the join to persons, so rows without a traveller are few by then.
    """
    trips = t["trip"].where("has_artificial_trip = 0").select("folder", "trip_id", "person", "start_s", "end_s", "travel_distance")
    acts = t["activity"].select("folder", F.col("trip").alias("trip_id"), "mode", "type")
    people = residents(t).select("folder", "person", "age", "vehicles", "hh_id", "hh_income", "zone")
    by_person = join_by_shuffle(trips, acts, ["folder", "trip_id"], "left").groupBy("folder", "person", "mode", "type").agg(*named(
        n="count(1)", n_trips="count(trip_id)", metres="sum(travel_distance)", seconds="sum(end_s - start_s)"))
    return join_by_shuffle(by_person, people, ["folder", "person"], "left").groupBy(
        "folder", "zone", "mode", "type", age_class("age").alias("age_class")).agg(
        F.sum(F.col("vehicles") * F.col("n")).alias("vehicles"), F.sum("n_trips").alias("trip_count"),
        F.coalesce(F.sum(F.when(F.col("hh_id").isNotNull(), F.col("n"))), F.lit(0)).alias("household_count"),
        (F.sum("metres") / METRES_PER_MILE).alias("total_travel_distance_miles"), (F.sum("seconds") / 60).alias("total_ttime_mins"),
        F.sum(F.col("hh_income") * F.col("n")).alias("hh_inc_total"),
    )


def activity_times(t: Tables) -> DataFrame:
    """Duration of stationary activities by type, age class (activity variant) and home zone."""
    by_person = t["activity"].where("mode = 'NO_MOVE'").groupBy("folder", "person", "type").agg(F.sum("duration").alias("d"))
    people = residents(t).select("folder", "person", "age", "zone")
    return (
        join_by_shuffle(by_person, people, ["folder", "person"], "left")
        .groupBy("folder", F.col("type").alias("activity_type"), age_class_activity("age").alias("age_class"), "zone")
        .agg(F.sum("d").alias("activity_duration"))
    )


def household_rollup(t: Tables) -> DataFrame:
    """Members over 60 and up to 60 and their income per household, with position and zone."""
    members = t["person"].groupBy("folder", "household").agg(
        count_if(F.col("age") > 60).alias("over"), count_if(F.col("age") <= 60).alias("under"), F.sum("income").alias("inc")
    )
    homes = left_join_spreading_nulls(
        t["household"].select("folder", "household", "location", "workers", "vehicles"),
        t["location"].select("folder", F.col("location").alias("loc"), "x", "y", "zone"), "location", "loc", "household",
    ).withColumn("hh_id", F.col("household"))
    return join_by_shuffle(members, homes, ["folder", "household"], "left").groupBy("folder", F.col("hh_id").alias("household"), "x", "y", "zone").agg(
        F.min("workers").alias("workers"), F.min("vehicles").alias("vehicles"), F.sum("over").alias("people_over_60"),
        F.sum("under").alias("people_under_60"), F.sum("inc").alias("income"),
    )


def closest_stops(t: Tables) -> DataFrame:
    """Households by walkable distance to the nearest stop, vehicles, ages and zone.

    Without a stop in the case, or without coordinates of the home, no stop is in walking distance.
    """
    homes = household_rollup(t).where("zone IS NOT NULL AND vehicles IS NOT NULL")
    hits = nearest_stop(homes, t["transit_stops"]).select("folder", "x", "y", "distance")
    minutes = miles("distance") / WALK_MPH * 60
    return (
        join_by_shuffle(homes, hits, ["folder", "x", "y"], "left")
        .groupBy(
            "folder", F.when(minutes <= WALK_LIMIT_MIN, 1).otherwise(0).alias("walkable"), "vehicles",
            F.col("people_over_60").alias("over_60"), F.col("people_under_60").alias("under_60"), "zone",
        )
        .agg(F.count(F.lit(1)).alias("count"), F.coalesce(F.sum("income"), F.lit(0.0)).alias("total_income"))
    )


# ---- seniors by zone: input is a report with the case columns added ------------------------------------

def _whole(c: str) -> Column:
    """Whole part; the inner rounding keeps a sum like 123455.9999999 from losing a unit."""
    return F.round(c, 6).cast("bigint")


def zone_data(elder: DataFrame) -> DataFrame:
    """Senior rows of ``elder_demo`` with a known zone."""
    return elder.where((F.col("age_class") == SENIOR) & F.col("zone").isNotNull()).withColumns({
        "mode": F.coalesce("mode", F.lit(UNKNOWN)), "type": F.coalesce("type", F.lit(UNKNOWN)),
        "zone": F.col("zone").cast("string"), "hh_inc_total": _whole("hh_inc_total").cast("double"),
        "Age Group": F.lit("Senior"),
    })


def zone_income_check(elder: DataFrame, columns: Sequence[str] = FOLDER_COLUMNS) -> DataFrame:
    """Average senior household income and its quartile per zone and case."""
    return zone_data(elder).groupBy(*columns, "zone").agg(
        ratio(F.sum("hh_inc_total"), F.sum("household_count")).alias("avg_hh_inc")
    ).withColumn("HH_Inc_Quartile", income_quartile("avg_hh_inc"))


def mode_data(elder: DataFrame, columns: Sequence[str] = FOLDER_COLUMNS) -> DataFrame:
    """Senior travel by zone, mode and type with averages per trip and the zone's income quartile."""
    by_zone = Window.partitionBy(*columns, "zone")  # a zone's rows are one per mode, type and case: few
    income = ratio(F.sum("hh_inc_total").over(by_zone), F.sum("household_count").over(by_zone))
    return zone_data(elder).withColumn("avg_hh_inc", income).where("mode <> 'FAIL_REROUTE'").withColumns({
        "average travel distance": ratio("total_travel_distance_miles", "trip_count"),
        "average travel time": ratio("total_ttime_mins", "trip_count"),
        "HH_Inc_Quartile": income_quartile("avg_hh_inc"),
    })


def _senior_travel(elder: DataFrame) -> DataFrame:
    return zone_data(elder).where("mode <> 'FAIL_REROUTE'")


def hh_inc_map(elder: DataFrame, aggregators: Sequence[str] = DEMOGRAPHIC_AGGREGATORS) -> DataFrame:
    """Senior household income and quartile per zone."""
    return (
        _senior_travel(elder).groupBy(*aggregators, "zone")
        .agg(F.sum("hh_inc_total").alias("hh_inc_total"), F.sum("household_count").alias("household_count"))
        .withColumn("Senior HH Income Average", ratio("hh_inc_total", "household_count"))
        .withColumn("HH Inc Quartile", income_quartile("Senior HH Income Average"))
    )


def demo_agg_mode_data(elder: DataFrame, columns: Sequence[str] = FOLDER_COLUMNS) -> DataFrame:
    """Senior trips, miles, minutes and income by mode and activity type."""
    sums = _senior_travel(elder).groupBy(*columns, "mode", "type").agg(
        F.sum("trip_count").alias("Trip Count"), F.sum("household_count").alias("household_count"),
        F.sum("total_travel_distance_miles").alias("Travel Distance"), F.sum("total_ttime_mins").alias("Total Travel Time"),
        F.sum("hh_inc_total").alias("hh_inc_total"),
    )
    return sums.withColumn("avg_hh_inc", ratio("hh_inc_total", "household_count")).withColumns({
        "Household Income Quartile": income_quartile("avg_hh_inc"),
        "average travel time": ratio("Total Travel Time", "Trip Count"),
        "average travel distance": ratio("Travel Distance", "Trip Count"),
    })


def tnc_request_demo(skim_demo: DataFrame, columns: Sequence[str] = FOLDER_COLUMNS) -> DataFrame:
    """Ride-hail request sums by zone and age class."""
    sums = ["request_count", "total skim solo fare", "total discount", "total fare", "total discount percentage"]
    return skim_demo.groupBy(*columns, "zone", "folder", "age_class").agg(*[F.sum(c).alias(c) for c in sums]).withColumn(
        "mode", F.lit("TAXI")
    )


def tnc_request_demo_agg(skim_demo: DataFrame, columns: Sequence[str] = FOLDER_COLUMNS) -> DataFrame:
    """Senior requests by zone with fare and discount per request."""
    return (
        tnc_request_demo(skim_demo, columns).where(F.col("age_class") == SENIOR)
        .withColumnsRenamed({
            "request_count": "Request Count", "total skim solo fare": "Total Solo Skim Fare", "total discount": "Total Discount",
            "total fare": "Total Fare", "total discount percentage": "Total Discount %",
        })
        .withColumns({
            "zone": F.col("zone").cast("string"), "Fare per request": ratio("Total Fare", "Request Count"),
            "discount % per request": ratio("Total Discount %", "Request Count"),
        })
    )


def demo_zone_summary_tnc(zones: DataFrame, elder: DataFrame, skim_demo: DataFrame, columns: Sequence[str] = FOLDER_COLUMNS) -> DataFrame:
    """Every zone with its income quartile per case and the senior ride-hail requests."""
    return zones.join(zone_income_check(elder, columns), ["City", "zone"], "left").join(
        tnc_request_demo_agg(skim_demo, columns), [*columns, "zone"], "left"
    )


def demo_agg_tnc_case(zones: DataFrame, elder: DataFrame, skim_demo: DataFrame, columns: Sequence[str] = FOLDER_COLUMNS) -> DataFrame:
    """Senior ride-hail requests by income quartile with average fare and discount."""
    keys = [*columns, "HH_Inc_Quartile"]
    sums = ["Total Solo Skim Fare", "Total Discount", "Total Fare", "Total Discount %", "Request Count"]
    return (
        demo_zone_summary_tnc(zones, elder, skim_demo, columns).dropna(subset=keys).groupBy(*keys)
        .agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in sums])
        .withColumns({
            "Average Fare": ratio("Total Fare", "Request Count"), "Average Discount %": ratio("Total Discount %", "Request Count"),
        })
    )


def zone_mode_proportions(elder: DataFrame, columns: Sequence[str] = FOLDER_COLUMNS, modes: Sequence[str] = TRAVEL_MODES) -> DataFrame:
    """Senior travel time, distance and trips per zone and type, one column per mode and measure."""
    keys = [*columns, "zone", "type"]
    grouped = _senior_travel(elder).groupBy(*keys, "mode").agg(
        F.sum("total_ttime_mins").alias("Travel Time"), F.sum("total_travel_distance_miles").alias("Travel Distance"),
        F.sum("trip_count").alias("Trips"),
    )
    measures = ["Travel Time", "Travel Distance", "Trips"]
    long = melt(grouped, [*keys, "mode"], measures).withColumn("mode_attrib", F.concat_ws("_", "mode", "Attribute"))
    wide = pivot_expected(long, keys, "mode_attrib", [f"{mode}_{a}" for mode in modes for a in measures], "Value", fill=None)
    return wide.withColumn("zone", F.col("zone").cast("bigint"))


def demo_activity_time_usage(activity: DataFrame, elder: DataFrame, columns: Sequence[str] = FOLDER_COLUMNS) -> DataFrame:
    """Seniors' activity duration against travel time by mode: shares, time budgets and budget levels."""
    travel = zone_mode_proportions(elder, columns)
    mine = activity.where((F.col("age_class") == SENIOR) & F.col("zone").isNotNull()).select(
        *columns, F.col("zone").cast("bigint").alias("zone"), F.col("activity_type").alias("type"),
        F.col("activity_duration").alias("duration"),
    )
    used = ["duration", *[f"{m}_{a}" for m in BUDGET_MODES.values() for a in ("Travel Time", "Trips")]]
    sums = (
        mine.join(travel, [*columns, "zone", "type"], "left").groupBy(*columns, "type")
        .agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in used])
        .where("type NOT IN ('HOME', 'WORK AT HOME')")
        .withColumns({
            "Total Travel Time": sum((F.col(f"{m}_Travel Time") for m in BUDGET_MODES.values()), F.lit(0.0)),
            "Total Trips": sum((F.col(f"{m}_Trips") for m in BUDGET_MODES.values()), F.lit(0.0)),
        })
    )
    out = sums.withColumns({f"{name} Share": ratio(f"{m}_Travel Time", "Total Travel Time") for name, m in BUDGET_MODES.items()})
    out = out.withColumn("avg_duration_per_trip", ratio("duration", "Total Trips")).withColumns({
        f"{name} Time Budget": 1 - ratio(f"{m}_Travel Time", F.col("duration") * ratio(f"{m}_Trips", "Total Trips"))
        for name, m in BUDGET_MODES.items()
    })
    return out.withColumns({f"{name} Time Budget Level": level(f"{name} Time Budget", [0.8, 0.6, 0.4], "No Data") for name in BUDGET_MODES})


# ---- bus access, income histogram, vehicle ownership ----------------------------------------------

def closest_stops_by_zone(stops: DataFrame) -> DataFrame:
    """Households with seniors by walking distance to a bus stop."""
    return stops.where("over_60 > 0").withColumnRenamed("walkable", "Walking Distance to Bus Stop").withColumn(
        "zone", F.col("zone").cast("string")
    )


def closest_stops_helper(stops: DataFrame) -> DataFrame:
    walk = "Walking Distance to Bus Stop"
    return closest_stops_by_zone(stops).groupBy(walk, "zone", "City").agg(F.sum("count").alias("count")).withColumn(
        walk, F.col(walk).cast("boolean")
    )


def hh_inc_hist(elder: DataFrame, stops: DataFrame) -> DataFrame:
    """Income histogram (steps of 5,000 in units of 100,000, 1.5+ overflow) by bus access."""
    income = F.col("Senior HH Income Average")
    step = (F.rint(income / 5000).cast("bigint") * 5 / F.lit(100.0)).cast("string")
    zones = hh_inc_map(elder).withColumn("Rounded Income", F.when(income > 150000, F.lit("1.5+")).otherwise(step))
    walk = "Walking Distance to Bus Stop"
    counted = (
        zones.join(closest_stops_helper(stops), ["zone", "City"], "left").where(F.col(walk).isNotNull())
        .groupBy("Rounded Income", "City", walk)
        .agg(F.sum("household_count").alias("Count"), F.sum("count").alias("stops"))
        .withColumn("access", F.when(F.col(walk), "W/ Bus Access").otherwise("W/O Bus Access"))
    )
    return pivot_expected(counted, ["Rounded Income", "City", "Count"], "access", ["W/ Bus Access", "W/O Bus Access"], "stops", fill=None)


def hh_inc_pivot(elder: DataFrame) -> DataFrame:
    """Senior household counts per zone, one column per income quartile."""
    return pivot_expected(
        hh_inc_map(elder), ["City", "zone"], "HH Inc Quartile", QUARTILES, "household_count", fill=None
    ).withColumns({"city_zone": F.concat_ws("_", "City", "zone"), "zone": F.col("zone").cast("bigint")})


def vehicle_ownership(ownership: DataFrame, elder: DataFrame) -> DataFrame:
    """Vehicles per household of a zone, split by the quartiles' shares of its senior households."""
    zones = ownership.where("ZONE IS NOT NULL").groupBy("City", F.col("ZONE").alias("zone")).agg(
        F.sum("households").alias("households"), F.sum("vo").alias("vo")
    )
    merged = zones.join(hh_inc_pivot(elder).drop("city_zone"), ["City", "zone"], "left").fillna(0, subset=["vo", *QUARTILES])
    total = sum((F.col(q) for q in QUARTILES), F.lit(0))
    per_household = ratio("vo", "households")
    labels = {
        "3 VO for HH Inc Between 50% and 75%": QUARTILES[2], "4 VO for HH Inc >75%": QUARTILES[3],
        "2 VO for HH Inc between 25% and 50%": QUARTILES[1], "1 VO for HH Inc between <25%": QUARTILES[0],
    }
    return merged.withColumns({
        name: F.when(total == 0, per_household).otherwise(per_household * ratio(q, total)) for name, q in labels.items()
    })


