"""Trip distribution by mode and the mode shift tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mobspark.functions.exprs import METRES_PER_MILE, age_class, mode_name, purpose_flags, ratio, row_total
from mobspark.operators.compare import shift, with_baseline
from mobspark.operators.joins import join_by_shuffle
from mobspark.operators.shape import pivot_expected
from mobspark.plans.common import Tables, residents, times_multiplier

DASHBOARD_MODES = ["SOV", "BUS", "RAIL", "BICYCLE", "WALK", "TAXI", "FAIL_REROUTE"]
CASE_AGGREGATORS = ["City", "Fleet Size"]
STRATEGY_AGGREGATORS = ["City", "Strategy"]


def _resident_trips(t: Tables) -> DataFrame:
    """Trips longer than two seconds joined to their traveller (person and household required)."""
    trips = t["trip"].where("end_s - start_s > 2").select(
        "folder", "person", "origin", "destination", "mode", "travel_distance", "has_artificial_trip"
    )
    return join_by_shuffle(trips, residents(t).where("hh_id IS NOT NULL"), ["folder", "person"])


def _purposes() -> dict[str, Column]:
    return purpose_flags(F.col("origin"), F.col("destination"), F.col("home_location"), F.col("work_location_id"))


def _real_trips(trips: DataFrame) -> DataFrame:
    return trips.where("has_artificial_trip = 0 OR mode IN (7, 8)")


def mode_distribution_counts(t: Tables, params: DataFrame) -> DataFrame:
    """Trips by mode, age class and purpose."""
    counts = (
        _real_trips(_resident_trips(t)).groupBy("folder", "mode", age_class("age").alias("age_class"))
        .agg(*[F.sum(F.when(c, 1).otherwise(0)).alias(n) for n, c in _purposes().items()], F.count(F.lit(1)).alias("total"))
    )
    return times_multiplier(counts, params, ["HBW", "HBO", "NHB", "total"])


def mode_distribution_distance(t: Tables, params: DataFrame) -> DataFrame:
    """Miles by mode, age class and purpose; a purpose that is unknown for every trip stays NULL."""
    mi = F.col("travel_distance") / METRES_PER_MILE
    dist = (
        _real_trips(_resident_trips(t)).groupBy("folder", "mode", age_class("age").alias("age_class"))
        .agg(*[F.sum(mi * c.cast("int")).alias(n) for n, c in _purposes().items()], F.sum(mi).alias("total"))
    )
    return times_multiplier(dist, params, ["HBW", "HBO", "NHB", "total"])


def mode_distribution_zones(t: Tables, params: DataFrame) -> DataFrame:
    """Trips of people over 16 by mode, home zone and purpose."""
    counts = (
        _resident_trips(t).where("age > 16").groupBy("folder", "mode", "zone")
        .agg(*[F.sum(F.when(c, 1).otherwise(0)).alias(n) for n, c in _purposes().items()], F.count(F.lit(1)).alias("total"))
    )
    return times_multiplier(counts, params, ["HBW", "HBO", "NHB", "total"])


def mode_pivot(distribution: DataFrame, keys: Sequence[str] = ("folder",), modes: Sequence[str] = DASHBOARD_MODES) -> DataFrame:
    """Totals with one column per mode name."""
    named = distribution.withColumn("mode", mode_name("mode"))
    return pivot_expected(named, list(keys), "mode", modes, "total")


def trips_by_mode_name(t: Tables) -> DataFrame:
    """Trips per case and mode name."""
    return t["trip"].groupBy("folder", "mode").agg(F.count(F.lit(1)).alias("trips")).select(
        "folder", "mode", mode_name("mode").alias("mode_name"), "trips"
    )


def mode_combo(bus: DataFrame, ridehail: DataFrame, distribution: DataFrame, measure: str) -> DataFrame:
    """Bus, ride-hail and other modes side by side per case, with shift classes and shares.

    ``measure`` is ``dist`` (miles) or ``cnt`` (trips). Rail and bus are whole numbers.
    """
    # fixed values: the published column names
    noun = {"dist": "Distance", "cnt": "Trips"}[measure]
    vehicular = {"dist": "Vehicular Mileage", "cnt": "Vehicular Trips"}[measure]
    occupancy = {"dist": "mileage_avo", "cnt": "trip_avo"}[measure]
    names = {"mass": "Mass", "pool": "Pool", "solo": "Solo", "empt": "Empty"}
    buses = bus.select(
        "folder", F.col(occupancy).alias("Bus AVO"), *[F.col(f"{measure}_{c}").cast("double").alias(f"Bus {n}") for c, n in names.items()]
    ).fillna(0.0, subset=["Bus Mass", "Bus Pool"])
    cars = ridehail.select(
        "folder", *[F.col(f"{measure}_{c}").cast("double").alias(f"Rideshare {n}") for c, n in names.items() if c != "mass"]
    )
    others = mode_pivot(distribution)
    out = buses.join(cars, "folder", "left").join(others, "folder", "left")
    for mode in ("RAIL", "BUS"):
        out = out.withColumn(mode, F.coalesce(F.col(mode).cast("bigint"), F.lit(0)))
    bus_parts = ["Bus Mass", "Bus Pool", "Bus Solo", "Bus Empty"]
    car_parts = ["Rideshare Pool", "Rideshare Solo", "Rideshare Empty"]
    total = f"Total {noun}"
    replaceable = f"Rideshare Replaceable Bus {noun}"
    out = out.withColumns({
        "Bus Total": row_total(*bus_parts),
        "Rideshare Total": row_total(*car_parts),
        "Positive": row_total("Bus Mass", "RAIL", "BICYCLE", "WALK"),
        "Neutral": row_total("Bus Pool", "Rideshare Pool"),
        "Negative": row_total("Bus Solo", "Bus Empty", "Rideshare Solo", "Rideshare Empty", "SOV"),
        vehicular: row_total(*bus_parts, *car_parts, "SOV"),
        replaceable: row_total("Bus Pool", "Bus Solo", "Bus Empty"),
    }).withColumn(total, row_total("Bus Total", "Rideshare Total", "SOV", "RAIL", "BICYCLE", "WALK"))
    return out.withColumns({
        "Bus Mass Share": ratio("Bus Mass", "Bus Total"),
        "Rideshare Replaceable Bus Share": ratio(replaceable, total),
        "SOV Share": ratio("SOV", total),
        "Rideshare Share": ratio("Rideshare Total", total),
    })


def mode_combo_shift(
    combo: DataFrame, measure: str, baseline: Sequence[str] = ("Heuristic",), treatment: Sequence[str] | None = ("Proactive",),
    case_columns: Sequence[str] = CASE_AGGREGATORS, strategy_columns: Sequence[str] = STRATEGY_AGGREGATORS,
) -> DataFrame:
    """Treatment cases against their baseline case and both against their strategy's mean.

    ``combo`` carries the case columns. ``treatment=None`` compares every non-baseline strategy.
    """
    # fixed values: the published column names
    noun = {"dist": "Distance", "cnt": "Trips"}[measure]
    vehicular = {"dist": "Vehicular Mileage", "cnt": "Vehicular Trips"}[measure]
    trip_word = {"dist": "Mileage", "cnt": "Trip"}[measure]
    vehicular_shift = {"dist": "Vehicular Mileage Shift", "cnt": "Vehicular Trip Shift"}[measure]
    classes = ["Positive", "Neutral", "Negative"]
    shares = ["Bus Mass Share", "Rideshare Replaceable Bus Share", "SOV Share", "Rideshare Share"]
    kept = [f"Rideshare Replaceable Bus {noun}", f"Total {noun}", *shares]
    old = "heuristic "
    rows = with_baseline(combo, case_columns, "Strategy", baseline, [*classes, vehicular, *kept], treatment, old)
    by_strategy = Window.partitionBy(*strategy_columns)
    # the strategy's mean covers every case of the strategy, chosen for comparison or not
    rows = rows.withColumns({f"mean {c}": F.avg(c).over(by_strategy) for c in (*classes, vehicular)})

    new_sum = F.expr("Positive + Neutral + Negative")
    old_sum = F.expr(f"`{old}Positive` + `{old}Neutral` + `{old}Negative`")

    def gain(share: str) -> Column:
        return F.expr(f"`{share}` - `{old}{share}`")

    out = rows.withColumns({
        **{f"{c} Shift Heur": shift(c, old + c) for c in classes},
        **{f"{c} Shift Avg": shift(c, f"mean {c}") for c in classes},
        "Net Overall Shift Heur": shift(new_sum, old_sum),
        f"{vehicular_shift} Heur": shift(vehicular, old + vehicular),
        f"{vehicular_shift} Avg": shift(vehicular, f"mean {vehicular}"),
        f"High Capacity Bus {trip_word} Share Increase": gain("Bus Mass Share"),
        f"TNC Replaceable Bus {trip_word} Share Increase": gain("Rideshare Replaceable Bus Share"),
        "SOV Share Increase": gain("SOV Share"),
        "TNC Share Increase": gain("Rideshare Share"),
    }).withColumns({
        "Net Positive Shift Heur": F.expr("`Positive Shift Heur` - `Negative Shift Heur`"),
        "Net Positive Shift Avg": F.expr("`Positive Shift Avg` - `Negative Shift Avg`"),
        "Net TNC Increase vs SOV": F.expr("`TNC Share Increase` + `SOV Share Increase`"),
    })
    return out.select(
        "folder", "Bus AVO", "Bus Mass", "Bus Pool", "Bus Solo", "Bus Empty", "City", "Fleet Size", "Strategy", "Iteration",
        "Bus Total", "Rideshare Pool", "Rideshare Solo", "Rideshare Empty", "Rideshare Total", "SOV", "RAIL", "BICYCLE", "WALK",
        *classes, vehicular, f"Rideshare Replaceable Bus {noun}", f"Total {noun}", *shares, *[old + c for c in kept],
        *[f"{c} Shift Heur" for c in classes], "Net Overall Shift Heur", "Net Positive Shift Heur", f"{vehicular_shift} Heur",
        f"High Capacity Bus {trip_word} Share Increase", f"TNC Replaceable Bus {trip_word} Share Increase",
        "SOV Share Increase", "TNC Share Increase", "Net TNC Increase vs SOV",
        *[f"{c} Shift Avg" for c in classes], f"{vehicular_shift} Avg", "Net Positive Shift Avg",
    )


def positive_shift_reg(shifted: DataFrame) -> DataFrame:
    """Regression input: net positive shift against the numeric fleet size."""
    return shifted.select(
        "folder", "City", F.col("Fleet Size").try_cast("double").alias("Fleet Size"), "Strategy", "Iteration",
        "Net Positive Shift Avg",
    )
