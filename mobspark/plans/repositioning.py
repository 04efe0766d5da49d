"""Vehicle tours and repositioning success."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobspark.functions.exprs import METRES_PER_MILE, named, ratio
from mobspark.operators.asof import next_service_trip
from mobspark.operators.joins import attach_case_rows, left_join_spreading_nulls, one_row_per_case
from mobspark.operators.tours import add_sub_tours, tour_rollup
from mobspark.operators.vehicle_day import add_vehicle_day
from mobspark.plans.common import Tables
from mobspark.plans.ridehail import request_summary

PERIOD_S = 900


def vehicle_trips(t: Tables, period_s: int = PERIOD_S) -> DataFrame:
    """Vehicle trips of known tours with minutes, miles, hour and period."""
    return t["tnc_trip"].where("vehicle IS NOT NULL AND tour IS NOT NULL").selectExpr(
        "folder", "vehicle", "tour", "tnc_trip_id_int", "start_s", "end_s", "passengers", "init_status", "request",
        "skim_travel_time / 60 AS skim_travel_time", "routed_travel_time / 60 AS routed_travel_time",
        f"travel_distance / {METRES_PER_MILE}D AS travel_distance", "CAST(floor(start_s / 3600) AS INT) AS hour",
        f"CAST(floor(start_s / {period_s}) AS INT) AS repositioning_period",
    )


def with_request(trips: DataFrame, t: Tables) -> DataFrame:
    """Trips with their request's zones and service type, where there is one."""
    requests = t["tnc_request"].select("folder", "tnc_request_id", "service_type", "origin_zone", "destination_zone")
    return left_join_spreading_nulls(trips, requests, "request", "tnc_request_id", "tnc_trip_id_int")


def _tours(t: Tables) -> DataFrame:
    return tour_rollup(with_request(add_sub_tours(vehicle_trips(t)), t))


def tours(t: Tables) -> DataFrame:
    """One row per sub-tour. Its request ids are the rows of ``tour_requests``, counted in requests_served."""
    return _tours(t).select(
        "folder", "vehicle", "tour", "sub_tour", "final_tour_id", "tour_start", "tour_end", "max_passengers",
        "total_skim_travel_time", "total_routed_travel_time", "service_type", "hour", "origin_zone", "destination_zone",
        "total_travel_distance", "init_status", "requests_served", "pooled_tour",
    )


def tour_requests(t: Tables) -> DataFrame:
    """The request list of every sub-tour in long form, ordered by (start_s, tnc_trip_id_int)."""
    return add_sub_tours(t["tnc_trip"]).select(
        "folder", "vehicle", "tour", "sub_tour", "start_s", "tnc_trip_id_int", "request"
    )


def _cases_with_repositioning_type(t: Tables) -> DataFrame:
    """Cases where some vehicle trip serves a request of the repositioning type."""
    typed = t["tnc_request"].where("service_type = 99").select("folder", F.col("tnc_request_id").alias("request"))
    served = t["tnc_trip"].where("vehicle IS NOT NULL AND tour IS NOT NULL").select("folder", "request")
    return served.join(typed, ["folder", "request"], "left_semi").select("folder").distinct().withColumn("typed", F.lit(True))


def _split(trips: DataFrame, t: Tables) -> tuple[DataFrame, Column, Column]:
    """Conditions for repositioning and service trips; the rule depends on whether the case uses type 99."""
    flagged = attach_case_rows(trips, _cases_with_repositioning_type(t)).withColumn("typed", F.coalesce("typed", F.lit(False)))
    status, kind, typed = F.col("init_status"), F.col("service_type"), F.col("typed")
    probe = F.when(typed, (kind == 99) & (status == -2)).otherwise(status == -3)
    service = F.when(typed, ~kind.eqNullSafe(99)).otherwise(~status.eqNullSafe(-3))
    return flagged, probe, service


def next_service_trips(t: Tables, horizon_s: int = 3600) -> DataFrame:
    """Each repositioning trip with the vehicle's next service trip within the horizon."""
    trips, probe, service = _split(with_request(vehicle_trips(t), t), t)
    return next_service_trip(trips, probe, service, horizon_s).select(
        "folder", "vehicle", "tnc_trip_id_int", "start_s", "hour", "destination_zone", "next_trip", "next_origin_zone"
    )


def repositioning_by_hour(t: Tables, horizon_s: int = 3600) -> DataFrame:
    """Per hour: repositioning trips, those followed by a service trip from the target zone, success rate."""
    success = F.col("next_origin_zone") == F.col("destination_zone")
    return (
        next_service_trips(t, horizon_s).where("hour IS NOT NULL").groupBy("folder", "hour")
        .agg(F.count(F.lit(1)).alias("num_repositioned"), F.count(F.when(success, 1)).alias("num_successful"))
        .withColumn("success_rate", ratio("num_successful", "num_repositioned"))
    )


def vehicle_legs(t: Tables) -> DataFrame:
    """Trips of known tours with their request, and what ``repositioning_success_rate`` needs: sub-tours, and the next service
    trip under both rules. Which rule holds is known per case only when all its trips were seen."""
    status, kind = F.col("init_status"), F.col("service_type")
    rules = {
        "typed": ((kind == 99) & (status == -2), ~kind.eqNullSafe(99)), "untyped": (status == -3, ~status.eqNullSafe(-3)),
    }
    return add_vehicle_day(with_request(vehicle_trips(t), t), rules)


def repositioning_success_rate(t: Tables, params: DataFrame) -> DataFrame:
    """Daily success rate with tour times and distances, occupancy and the request summary, per case."""
    time, skim, dist = "total_routed_travel_time", "total_skim_travel_time", "total_travel_distance"
    groups = {
        "repo99": "service_type = 99", "repo3": "init_status = -3", "pooled": "pooled_tour",
        "solo99": "NOT pooled_tour AND NOT service_type <=> 99", "solo3": "NOT pooled_tour AND NOT init_status <=> -3",
    }
    means = {f"{g}_{c}": f"avg(CASE WHEN {cond} THEN {c} END)" for g, cond in groups.items() for c in (time, skim, dist)}
    pickups = [f"pickup_{w}_{r}" for w in ("distance", "legs") for r in ("99", "3")]
    counts = {}
    for rule in ("typed", "untyped"):
        counts[f"{rule}_repositioned"] = f"count_if({rule}_probe)"
        counts[f"{rule}_successful"] = f"count_if({rule}_probe AND {rule}_next.zone = destination_zone)"
    sub_tours = tour_rollup(vehicle_legs(t), counts)
    daily = sub_tours.groupBy("folder").agg(*named(
        **means, typed="max(any_repositioning)", total_travel_time=f"sum({time})", total_travel_distance=f"sum({dist})",
        empty_distance=f"sum(CASE WHEN max_passengers = 0 THEN {dist} END)", pooled_tour_count="count_if(pooled_tour)",
        pd="sum(passenger_distance)", opd="sum(occupied_passenger_distance)", od="sum(occupied_distance)",
        **{c: f"sum({c})" for c in [*pickups, *counts]},
    )).withColumns({
        c: F.expr(f"CASE WHEN typed = 1 THEN typed_{c} ELSE untyped_{c} END") for c in ("repositioned", "successful")
    })
    summary = request_summary(t, params)
    wide = one_row_per_case([daily, summary]).where("typed IS NOT NULL")

    def by_rule(with_type: str, without: str) -> str:
        return f"CASE WHEN typed = 1 THEN {with_type} ELSE {without} END"

    return wide.select("folder", *named(
        num_repositioned="coalesce(repositioned, 0L)", num_successful="coalesce(successful, 0L)",
        success_rate="coalesce(try_divide(successful, repositioned), 0D)",
        average_routed_ttime_repo=by_rule(f"repo99_{time}", f"repo3_{time}"),
        average_skim_ttime_repo=by_rule(f"repo99_{skim}", f"repo3_{skim}"),
        average_travel_distance_repo=by_rule(f"repo99_{dist}", f"repo3_{dist}"),
        average_routed_ttime_pooled=f"pooled_{time}", average_skim_ttime_pooled=f"pooled_{skim}",
        average_travel_distance_pooled=f"pooled_{dist}",
        average_routed_ttime_solo=by_rule(f"solo99_{time}", f"solo3_{time}"),
        average_skim_ttime_solo=by_rule(f"solo99_{skim}", f"solo3_{skim}"),
        average_travel_distance_solo=by_rule(f"solo99_{dist}", f"solo3_{dist}"),
        total_travel_time="total_travel_time", total_travel_distance=dist,
        total_empty_vehicle_travel_distance="coalesce(empty_distance, 0D)", pooled_tour_count="pooled_tour_count",
        average_vehicle_occupancy=f"try_divide(pd, {dist})", average_revenue_vehicle_occupancy="try_divide(opd, od)",
        average_pickup_segment_distance=by_rule(
            "try_divide(pickup_distance_99, pickup_legs_99)", "try_divide(pickup_distance_3, pickup_legs_3)"),
    ), *[c for c in summary.columns if c != "folder"])
