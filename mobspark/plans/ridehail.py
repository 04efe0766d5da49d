"""Ride-hail service reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobspark.functions.exprs import (
    METRES_PER_MILE, MILES_PER_KM, age_class, age_level, count_if, distance_bin, income_level, is_repositioning, named,
    ratio, sum_if,
)
from mobspark.operators.asof import skim_lookup
from mobspark.operators.joins import attach_case_rows, join_by_shuffle, left_join_spreading_nulls, one_row_per_case
from mobspark.operators.shape import describe_long
from mobspark.operators.skim_tiles import tiled_lookup
from mobspark.plans.common import Tables, optional, residents, times_multiplier, trips_by_request, unless_repo

DEMOGRAPHICS = ["PERSONS", "WORKERS", "EDUCATION", "GENDER", "RACE", "ZONE", "INC_LVL", "AGE_LVL"]
SUMMARY_METRICS = [
    "wait_min", "ttime", "discount", "fare", "pooled", "eVMT_perc", "occupied_VMT", "VMT", "mileage_AVO", "mileage_rAVO",
    "trip_AVO", "trip_rAVO", "operating_cost", "revenue",
]
OPERATING_COST_PER_MILE = 0.50


def _zero(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0))


def _per_case(params: DataFrame, *frames: DataFrame) -> DataFrame:
    """Wide one-row-per-case frame for every case in ``params``, with its multiplier as ``m``."""
    return one_row_per_case([params.select("folder", F.col("trip_multiplier").alias("m")), *frames]).where("m IS NOT NULL")


def pr_avo(t: Tables, params: DataFrame) -> DataFrame:
    """Ride-hail trips and miles that are pooled, solo or empty, per case."""
    sums = trips_by_request(t).groupBy("folder").agg(*named(
        n_pool=f"sum({unless_repo('n_pool')})", d_pool=f"sum({unless_repo('d_pool')})",
        n_solo=f"sum({unless_repo('n_solo')})", d_solo=f"sum({unless_repo('d_solo')})",
        n_empt=f"sum({unless_repo('n_empt', 'n_rows')})", d_empt=f"sum({unless_repo('d_empt', 'dist')})",
    ))
    out = {}
    for c in ("pool", "solo", "empt"):
        out |= {f"cnt_{c}": f"coalesce(n_{c}, 0) * m", f"dist_{c}": f"d_{c} / {METRES_PER_MILE}D * m"}
    return _per_case(params, sums).select("folder", *named(**out))


def fare_sensitivity_results(t: Tables, params: DataFrame) -> DataFrame:
    """Service level, vehicle use and occupancy of the ride-hail fleet, per case."""
    fleet = t["tnc_statistics"].groupBy("folder").agg(*named(fleet="count(1)", avg_trips="avg(tot_dropoffs)"))
    served = "assigned_vehicle IS NOT NULL AND service_type <> 99"
    requests = t["tnc_request"].groupBy("folder").agg(*named(
        wait=f"avg(CASE WHEN {served} THEN pickup_time - request_time END)",
        ttime=f"avg(CASE WHEN {served} THEN dropoff_time - request_time END)", served=f"count_if({served})",
        repo_served="count_if(assigned_vehicle IS NOT NULL AND service_type = 99)",
        unserved="count_if(assigned_vehicle IS NULL AND service_type <> 99)", all_requests="count(1)",
    ))
    trips = trips_by_request(t).groupBy("folder").agg(*named(
        evm=f"sum({unless_repo('d_zero', 'dist')})", vm="sum(dist)", pd=f"sum({unless_repo('pax_dist', '0D')})",
        pd_pos=f"sum({unless_repo('pax_dist_pos')})", dd_pos=f"sum({unless_repo('d_pos')})", secs="sum(seconds)",
        pax=f"sum({unless_repo('pax', '0L')})", pax_if_raw=f"sum(CASE WHEN n_pos > 0 THEN {unless_repo('pax_pos', '0L')} END)",
        trip_requests="count(request)",
    ))
    sov = t["trip"].where("mode = 0").groupBy("folder").agg(
        *named(sov_m="sum(travel_distance)", sov_s="sum(end_s - start_s)")
    )
    base = _per_case(params, fleet, requests, trips, sov).select("folder", *named(
        fleet_size="coalesce(fleet, 0) * m", avg_trips="avg_trips", wait_min="wait / 60", ttime_min="ttime / 60",
        requests_served="coalesce(served, 0) * m", repo_requests_served="coalesce(repo_served, 0) * m",
        evmt=f"evm / {METRES_PER_MILE}D * m", sav_vmt=f"vm / {METRES_PER_MILE}D * m", AVO="try_divide(pd, vm)",
        rAVO="try_divide(pd_pos, dd_pos)", sav_vht="secs / 3600 * m", unserved_requests="coalesce(unserved, 0) * m",
        sov_vmt=f"sov_m / {METRES_PER_MILE}D * m", sov_vht="sov_s / 3600 * m", trip_avo="try_divide(pax, all_requests)",
        trip_ravo="try_divide(pax_if_raw, trip_requests)",
    ))
    return base.select("*", *named(
        perc_evmt="try_divide(evmt, sav_vmt)", vmt_per_r="try_divide(sav_vmt, requests_served)",
        vht_per_r="try_divide(sav_vht * 60, requests_served)",
    ))


def distance_tnc_dist(t: Tables, params: DataFrame, half_units: bool = False) -> DataFrame:
    """Served requests (repositioning included) per distance bin."""
    binned = t["tnc_request"].where("assigned_vehicle IS NOT NULL").groupBy(
        "folder", distance_bin("distance", half_units).alias("binned_dist")
    ).agg(F.count(F.lit(1)).alias("num_trips"), F.min("service_type").alias("service_type"))
    return times_multiplier(binned, params, ["num_trips"])


def fare_sensitivity_results_zonal(t: Tables, params: DataFrame) -> DataFrame:
    """Waits, served and unserved requests and fares per origin zone; zones without served requests are absent."""
    assigned = F.col("assigned_vehicle").isNotNull()
    wait, ride = F.col("pickup_time") - F.col("request_time"), F.col("dropoff_time") - F.col("request_time")
    by_location = t["tnc_request"].where("service_type <> 99").groupBy("folder", F.col("origin_location").alias("location")).agg(
        count_if(assigned).alias("served"), count_if(~assigned).alias("unserved"),
        sum_if(assigned, wait).alias("wait"), F.count(F.when(assigned, wait)).alias("n_wait"),
        sum_if(assigned, ride).alias("ride"), F.count(F.when(assigned, ride)).alias("n_ride"),
        sum_if(assigned, "fare").alias("fare"),
    )
    zones = t["location"].select("folder", "location", "zone").join(t["zone"].select("folder", "zone", "area_type"), ["folder", "zone"])
    by_zone = by_location.join(zones, ["folder", "location"], "left").groupBy("folder", "zone").agg(
        F.min("area_type").alias("area_type"), (ratio(F.sum("wait"), F.sum("n_wait")) / 60).alias("wait_min"),
        (ratio(F.sum("ride"), F.sum("n_ride")) / 60).alias("ttime_min"), F.sum("served").alias("requests_served"),
        F.sum("unserved").alias("unserved"), F.sum("fare").alias("fare"),
    )
    known_unserved = F.when(F.col("zone").isNotNull() & (F.col("unserved") > 0), F.col("unserved"))
    served = by_zone.where("requests_served > 0").withColumn("unserved_requests", known_unserved).drop("unserved")
    return times_multiplier(served, params, ["requests_served", "unserved_requests"]).select(
        "folder", "zone", "area_type", "wait_min", "ttime_min", "requests_served", "unserved_requests", "fare"
    )


def _demographic_columns() -> list[Column]:
    return [
        F.col("persons").alias("PERSONS"), F.col("workers").alias("WORKERS"), F.col("education").alias("EDUCATION"),
        F.col("gender").alias("GENDER"), F.col("race").alias("RACE"), F.col("zone").alias("ZONE"),
        income_level("hh_income").alias("INC_LVL"), age_level("age").alias("AGE_LVL"),
    ]


def demographic_tnc_stats(t: Tables, params: DataFrame) -> DataFrame:
    """Served requests by household and person attributes and home zone.

    Requests are summed per person first; the sum and the join share one shuffle.
    """
    wait, ride = F.col("pickup_time") - F.col("request_time"), F.col("dropoff_time") - F.col("request_time")
    measures = {"fare": F.col("fare"), "dist": F.col("distance"), "wait": wait, "ride": ride}
    by_person = t["tnc_request"].where("assigned_vehicle IS NOT NULL AND service_type <> 99").groupBy("folder", "person").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(v).alias(f"s_{k}") for k, v in measures.items()], *[F.count(v).alias(f"n_{k}") for k, v in measures.items()],
    )
    named = join_by_shuffle(by_person, residents(t), ["folder", "person"], "left").select(
        "folder", "n", "vehicles", *[f"{p}_{k}" for k in measures for p in ("s", "n")], *_demographic_columns()
    )

    def mean(k: str) -> Column:
        return ratio(F.sum(f"s_{k}"), F.sum(f"n_{k}"))

    stats = named.groupBy("folder", *DEMOGRAPHICS).agg(
        F.sum("n").alias("REQUESTS"), mean("fare").alias("AVG_FARE"), (mean("dist") / METRES_PER_MILE).alias("AVG_DIST"),
        (mean("wait") / 60).alias("AVG_WAIT_MIN"), (mean("ride") / 60).alias("AVG_TTIME_MIN"),
        ratio(F.sum(F.col("vehicles") * F.col("n")), sum_if(F.col("vehicles").isNotNull(), "n")).alias("VO"),
    )
    return times_multiplier(stats, params, ["REQUESTS"])


def vehicle_ownership_stats(t: Tables) -> DataFrame:
    """Mean vehicles and household count over persons by the same attributes and the zone's area type."""
    groups = residents(t).select("folder", "vehicles", "hh_id", *_demographic_columns()).groupBy("folder", *DEMOGRAPHICS).agg(
        F.sum("vehicles").alias("s"), F.count("vehicles").alias("n"), F.count("hh_id").alias("households")
    )
    zones = t["zone"].select("folder", F.col("zone").alias("ZONE"), "area_type", F.lit(True).alias("known"))
    located = groups.join(zones, ["folder", "ZONE"], "left").withColumn("ZONE", F.when(F.col("known"), F.col("ZONE")))
    return located.groupBy("folder", *DEMOGRAPHICS, "area_type").agg(
        ratio(F.sum("s"), F.sum("n")).alias("vo"), F.sum("households").alias("households")
    )


def tnc_results_discount(t: Tables, params: DataFrame) -> DataFrame:
    """Pooling, fares, occupancy, empty share and rejection rate, per case."""
    service = "service_type <> 99"
    requests = t["tnc_request"].groupBy("folder").agg(*named(
        n=f"count_if({service})", solo=f"sum(CASE WHEN {service} THEN 1 - pooled_service END)",
        pool=f"sum(CASE WHEN {service} THEN pooled_service END)", s_fare="sum(fare)",
        s_disc="sum(CASE WHEN pooled_service = 1 THEN discount END)",
        repo="count_if(service_type = 99 AND assigned_vehicle IS NOT NULL)",
        rejected=f"count_if({service} AND assigned_vehicle IS NULL)",
    ))
    trips = trips_by_request(t).groupBy("folder").agg(*named(
        pax=f"sum({unless_repo('pax', '0L')})", n_pax=f"sum({unless_repo('n_p', 'n_rows')})", dist="sum(dist)",
        empty=f"sum({unless_repo('d_zero', 'dist')})",
        **{c: f"sum(CASE WHEN {service} THEN {c} END)" for c in ("pax_pos", "n_pos", "n_pool", "n_rows")},
    ))
    return _per_case(params, requests, trips).select("folder", *named(
        solo_perc="try_divide(solo, n)", pooled_perc="try_divide(pool, n)", fare="s_fare * m", AVO="try_divide(pax, n_pax)",
        rAVO="try_divide(pax_pos, n_pos)", vmt=f"dist / 1000 * {MILES_PER_KM}D", evmt_perc="try_divide(empty, dist)",
        pool_per="try_divide(n_pool, n_rows)", pooled_discount="s_disc * m", requests="coalesce(n, 0) * m",
        repo_requests="coalesce(repo, 0) * m", rejection_rate="try_divide(rejected, n)",
    ))


def tnc_stat_summary_helper(t: Tables, params: DataFrame) -> DataFrame:
    """One row per request: waits, fare, pooling, vehicle miles, occupancy, cost and revenue.

    Trips are summed per request before the join. Repositioning requests are kept, with 0 passengers.
    """
    p, mi = F.col("passengers"), F.col("travel_distance") / METRES_PER_MILE
    trips = t["tnc_trip"].where("request IS NOT NULL").groupBy("folder", F.col("request").alias("tnc_request_id")).agg(
        F.coalesce(sum_if(p == 0, mi), F.lit(0.0)).alias("e_raw"), F.coalesce(sum_if(p > 0, mi), F.lit(0.0)).alias("o_raw"),
        F.sum(mi).alias("miles"), F.sum(p).alias("pax_raw"), F.count("tnc_trip_id_int").alias("n"), F.max(p).alias("max_raw"),
    )
    requests = t["tnc_request"].select(
        "folder", "tnc_request_id", "assigned_vehicle", "request_time", "pickup_time", "dropoff_time",
        F.col("discount").alias("raw_discount"), F.col("fare").alias("raw_fare"), "party_size", "pooled_service", "service_type",
    )
    joined = attach_case_rows(
        requests.join(trips, ["folder", "tnc_request_id"], "left"), params.select("folder", F.col("trip_multiplier").alias("m")), "inner"
    )
    repo, has_trips = is_repositioning("service_type"), F.col("n").isNotNull()
    full = joined.withColumns({
        "pax": F.when(repo, F.when(has_trips, F.lit(0))).otherwise(F.col("pax_raw")).cast("double"),
        "max_pass": F.when(repo, F.when(has_trips, F.lit(0))).otherwise(F.col("max_raw")),
        "empty": F.when(repo, F.when(has_trips, F.coalesce("miles", F.lit(0.0)))).otherwise(F.col("e_raw")),
        "occupied": F.when(repo, F.when(has_trips, F.lit(0.0))).otherwise(F.col("o_raw")),
        "cost": F.col("miles") * OPERATING_COST_PER_MILE,
    })
    m = F.col("m")
    return full.select(
        "folder", "assigned_vehicle", "tnc_request_id",
        ((F.col("pickup_time") - F.col("request_time")) / 60).alias("wait_min"),
        ((F.col("dropoff_time") - F.col("pickup_time")) / 60).alias("ttime"),
        F.col("raw_discount").alias("discount_perc"), (F.col("raw_discount") * F.col("raw_fare") * m).alias("discount"),
        (F.col("raw_fare") * m).alias("fare"),
        F.when(F.col("max_pass") - F.col("party_size") > 0, 1).otherwise(0).alias("pooled"),
        ratio("empty", "miles").alias("eVMT_perc"), (F.col("occupied") * m).alias("occupied_VMT"), (F.col("miles") * m).alias("VMT"),
        F.when(repo, F.lit(0.0)).otherwise(F.col("pax")).alias("passengers"), (F.col("n") * m).alias("trips"),
        ratio("pax", "miles").alias("mileage_AVO"), ratio("pax", "occupied").alias("mileage_rAVO"),
        ratio("pax", "n").alias("trip_AVO"), F.col("pax").alias("trip_rAVO"), "pooled_service",
        (F.col("cost") * m).alias("operating_cost"), ((F.col("raw_fare") - F.col("raw_discount") - F.col("cost")) * m).alias("revenue"),
        "service_type",
    )


def tnc_stat_summary(t: Tables, params: DataFrame) -> DataFrame:
    """Sum, mean, deviation and count of the helper's metrics over assigned requests, in long form."""
    helper = attach_case_rows(tnc_stat_summary_helper(t, params), params.select("folder", "trip_multiplier"), "inner")
    assigned = F.col("assigned_vehicle").isNotNull()
    extra = {
        "assigned_requests": count_if(assigned) * F.max("trip_multiplier"),
        "requests": F.count(F.lit(1)) * F.max("trip_multiplier"),
    }
    return describe_long(helper, ["folder"], SUMMARY_METRICS, assigned, extra)


# ---- fares from the skim ------------------------------------------------------------------------

def priced_requests(t: Tables, params: DataFrame, mode: str = "first") -> DataFrame:
    """Service requests with skim time and distance, solo-equivalent fare, discount and corrected fare.

    The skim is looked up in the table ``skim_tiles`` (see ``tile_skim``) if there is one, else in ``skim``.
    """
    requests = t["tnc_request"].where("service_type <> 99").select(
        "folder", F.col("tnc_request_id").alias("request"), "person", "request_time", F.col("discount").alias("_own"),
        "origin_zone", "destination_zone", "pooled_service",
    )
    prices = params.select("folder", "per_minute", "per_mile", "base_fare", "assignment_strategy", "pooling_discount")
    periods, tiles = t.get("skim_periods"), optional(t, "skim_tiles")
    looked_up = skim_lookup(requests, t["skim"], mode, periods) if tiles is None else tiled_lookup(requests, tiles, mode, periods)
    priced = attach_case_rows(looked_up, prices)
    solo = F.col("skim_time") * F.col("per_minute") + F.col("skim_dist") * F.col("per_mile") + F.col("base_fare")
    rate = F.when(F.col("assignment_strategy") == "default", F.col("pooling_discount")).otherwise(F.col("_own"))
    pooled = F.col("pooled_service") == 1
    return priced.withColumns({
        "solo_equiv_fare_skim": solo, "discount_rate": F.when(pooled, rate).otherwise(F.lit(0.0)),
    }).withColumns({
        "corrected fare": F.when(pooled, F.col("solo_equiv_fare_skim") * (1 - F.col("discount_rate"))).otherwise(F.col("solo_equiv_fare_skim")),
        "discount": F.when(pooled, F.col("solo_equiv_fare_skim") * F.col("discount_rate")).otherwise(F.lit(0.0)),
    }).drop("per_minute", "per_mile", "base_fare", "assignment_strategy", "pooling_discount", "_own", "skim_period")


def requests_report(t: Tables, params: DataFrame, mode: str = "first") -> DataFrame:
    """``priced_requests`` with the traveller's attributes and home zone."""
    people = residents(t).select(
        "folder", "person", "zone", "vehicles", "disability", "race", "marital_status", F.col("hh_income").alias("income"), "age"
    )
    return left_join_spreading_nulls(priced_requests(t, params, mode), people, "person", "person", "request").select(
        "folder", "request", "request_time", "discount", "origin_zone", "destination_zone", "pooled_service", "zone", "vehicles",
        "disability", "race", "marital_status", "income", age_class("age").alias("age_class"), "skim_time", "skim_dist",
        "solo_equiv_fare_skim", "discount_rate", "corrected fare",
    )


def requests_sum(t: Tables, params: DataFrame, mode: str = "first") -> DataFrame:
    """Totals of the priced requests and revenue per vehicle and per request, per case."""
    sums = priced_requests(t, params, mode).groupBy("folder").agg(
        F.sum("solo_equiv_fare_skim").alias("solo"), F.sum("corrected fare").alias("fare"), F.sum("discount").alias("disc"),
        F.avg("discount_rate").alias("rate"), F.count(F.lit(1)).alias("n"),
    )
    fleet = t["tnc_statistics"].groupBy("folder").agg(F.count(F.lit(1)).alias("fleet"))
    m = F.col("m")
    fare = _zero("fare") * m
    return _per_case(params, sums, fleet).select(
        "folder", (_zero("solo") * m).alias("total skim solo fare"), fare.alias("total fare"), (_zero("disc") * m).alias("total discount"),
        F.col("rate").alias("average discount percentage"), ratio(fare, _zero("fleet") * m).alias("revenue per vehicle"),
        ratio(fare, _zero("n") * m).alias("revenue per request"),
    )


def tnc_skim_demo(t: Tables, params: DataFrame, mode: str = "first") -> DataFrame:
    """Priced requests summed by home zone and traveller attributes; unknown attributes are left out."""
    keys = ["zone", "vehicles", "disability", "race", "marital_status", "income", "age_class"]
    known = requests_report(t, params, mode).dropna(subset=keys)
    sums = known.groupBy("folder", *keys).agg(
        F.coalesce(F.sum("solo_equiv_fare_skim"), F.lit(0.0)).alias("total skim solo fare"),
        F.coalesce(F.sum("corrected fare"), F.lit(0.0)).alias("total fare"),
        F.coalesce(F.sum("discount"), F.lit(0.0)).alias("total discount"),
        F.coalesce(F.sum("discount_rate"), F.lit(0.0)).alias("total discount percentage"),
        F.count("request").alias("request_count"),
    )
    return times_multiplier(
        sums, params, ["total skim solo fare", "total fare", "total discount", "total discount percentage", "request_count"]
    )


def request_summary(t: Tables, params: DataFrame) -> DataFrame:
    """Eighteen request measures per case."""
    service, assigned = "service_type <> 99", "assigned_vehicle IS NOT NULL"
    ride = "dropoff_time - pickup_time"
    delay = f"({ride} - estimated_od_travel_time) / 60"
    sums = t["tnc_request"].groupBy("folder").agg(*named(
        n=f"count_if({service})", solo=f"sum(CASE WHEN {service} THEN 1 - pooled_service END)",
        pool=f"sum(CASE WHEN {service} THEN pooled_service END)", fare="sum(fare)",
        s_fare=f"sum(CASE WHEN {service} THEN fare END)", disc="sum(discount)",
        s_disc=f"sum(CASE WHEN {service} THEN discount END)", n_repo_assigned=f"count_if(service_type = 99 AND {assigned})",
        n_pool=f"count_if({service} AND pooled_service = 1 AND {assigned})",
        n_solo=f"count_if({service} AND pooled_service = 0 AND {assigned})",
        n_rejected=f"count_if({service} AND NOT {assigned})",
        wait=f"avg(CASE WHEN {service} THEN pickup_time - request_time END)",
        ride=f"sum(CASE WHEN {service} THEN {ride} END)", ride_repo=f"sum(CASE WHEN service_type = 99 THEN {ride} END)",
        n_repo="count_if(service_type = 99)",
        d_pool=f"sum(CASE WHEN {service} AND pooled_service = 1 THEN {delay} END)",
        all_pool=f"count_if({service} AND pooled_service = 1)",
        d_solo=f"sum(CASE WHEN {service} AND pooled_service = 0 THEN {delay} END)",
        all_solo=f"count_if({service} AND pooled_service = 0)",
    ))
    return _per_case(params, sums).select("folder", *named(
        solo_perc="try_divide(solo, n)", pooled_perc="try_divide(pool, n)", total_fare="fare * m",
        average_fare="try_divide(s_fare, n)", total_discount="disc * m", average_discount="try_divide(s_disc, n)",
        requests="coalesce(n, 0) * m", repo_requests="coalesce(n_repo_assigned, 0) * m",
        pooled_requests="coalesce(n_pool, 0) * m", solo_requests="coalesce(n_solo, 0) * m",
        rejected_requests="coalesce(n_rejected, 0) * m", average_wait_time_min="wait / 60",
        rejection_rate="try_divide(n_rejected, n)", average_discount_rate="try_divide(disc, fare)",
        average_person_ttime_min="try_divide(ride / 60, n)", average_repo_ttime_min="try_divide(ride_repo / 60, n_repo)",
        average_pooled_delay_time_min="try_divide(d_pool, all_pool)", average_solo_delay_time_min="try_divide(d_solo, all_solo)",
    ))
