"""Frames several reports build on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobspark.functions.exprs import named
from mobspark.operators.joins import attach_case_rows, left_join_spreading_nulls

Tables = Mapping[str, DataFrame]


def optional(t: Tables, name: str) -> DataFrame | None:
    """A table that need not be there, also of tables that are made when they are asked for."""
    try:
        return t[name]
    except KeyError:
        return None


def residents(t: Tables) -> DataFrame:
    """One row per person with household attributes and home zone (left joins throughout).

    Built once at dimension size so that a fact table needs a single join on (folder, person).
    ``hh_id`` is NULL for a person without household.
    """
    homes = left_join_spreading_nulls(
        t["household"].select(
            "folder", "household", F.col("location").alias("home_location"), F.col("income").alias("hh_income"),
            "vehicles", "persons", "workers",
        ),
        t["location"].select("folder", "location", "zone", "x", "y"),
        "home_location", "location", "household",
    )
    people = t["person"].select(
        "folder", "person", "household", "age", "work_location_id", F.col("income").alias("person_income"),
        "education", "gender", "race", "disability", "marital_status",
    )
    return left_join_spreading_nulls(
        people, homes.withColumn("hh_id", F.col("household")), "household", "household", "person"
    )


def trips_by_request(t: Tables) -> DataFrame:
    """Vehicle trips summed per request, then joined to the request's service type.

    Aggregating on the join key first leaves one row per request, so neither a request with very many
    trips nor the trips without a request can overload a task. Reports use only the columns they need;
    the rest is pruned. Column meaning, by raw passengers p: n_/d_ counts and metres for pool (p>1),
    solo (p=1), empty (p<1), ``zero`` (p=0) and ``pos`` (p>0).
    """
    sums = t["tnc_trip"].selectExpr(
        "folder", "request", "tnc_trip_id_int AS id", "passengers AS p", "travel_distance AS d", "end_s - start_s AS s"
    ).groupBy("folder", "request").agg(*named(
        n_rows="count(1)", n_trips="count(id)", n_p="count(p)", dist="sum(d)", seconds="sum(s)", pax="sum(p)", max_p="max(p)",
        pax_dist="sum(p * d)", n_pool="count_if(p > 1)", d_pool="sum(CASE WHEN p > 1 THEN d END)",
        n_solo="count_if(p = 1)", d_solo="sum(CASE WHEN p = 1 THEN d END)",
        n_empt="count_if(p < 1)", d_empt="sum(CASE WHEN p < 1 THEN d END)", d_zero="sum(CASE WHEN p = 0 THEN d END)",
        n_pos="count_if(p > 0)", pax_pos="sum(CASE WHEN p > 0 THEN p END)", d_pos="sum(CASE WHEN p > 0 THEN d END)",
        pax_dist_pos="sum(CASE WHEN p > 0 THEN p * d END)", sec_pos="sum(CASE WHEN p > 0 THEN s END)",
    ))
    kinds = t["tnc_request"].select("folder", F.col("tnc_request_id").alias("request"), "service_type")
    joined = sums.join(kinds, ["folder", "request"], "left")
    return joined.withColumn("repo", F.expr("coalesce(service_type = 99, false)"))


def unless_repo(c: str, if_repo: str = "NULL") -> str:
    """SQL of a per-request sum, replaced for repositioning requests (whose passengers count as 0)."""
    return f"CASE WHEN repo THEN {if_repo} ELSE {c} END"


def times_multiplier(df: DataFrame, params: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale already aggregated columns by the case's trip multiplier."""
    scaled = attach_case_rows(df, params.select("folder", "trip_multiplier"), "inner")
    return scaled.withColumns({c: F.col(c) * F.col("trip_multiplier") for c in columns}).drop("trip_multiplier")
