"""Repair of repositioning rows that carry passengers, and the check that it took effect."""

from __future__ import annotations

from collections import ChainMap

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobspark.functions.exprs import is_repositioning
from mobspark.functions.naming import strip_last_part
from mobspark.operators.joins import left_join_spreading_nulls, one_row_per_case
from mobspark.plans.common import Tables

UNREPAIRED_SUFFIXES = ("dr", "nr")
#: Column of the flagged tables: the repair should have cleared this row and did not.
LEFT_OVER = "_left_over"


def _repairable() -> Column:
    """Cases whose name (without iteration) ends in one of the suffixes have no repositioning to repair."""
    name = strip_last_part("folder")
    skip = F.lit(False)
    for suffix in UNREPAIRED_SUFFIXES:
        skip = skip | name.endswith(suffix)
    return ~skip


def flagged_requests(t: Tables) -> DataFrame:
    """Requests with party size 0 on repositioning rows, and whether a row that had to be cleared still isn't."""
    fix = _repairable() & is_repositioning("service_type")
    cleared = F.when(fix, F.lit(0)).otherwise(F.col("party_size")).cast("bigint")
    return t["tnc_request"].withColumn("party_size", cleared).withColumn(LEFT_OVER, fix & (F.col("party_size") > 0))


def repaired_requests(t: Tables) -> DataFrame:
    return flagged_requests(t).drop(LEFT_OVER)


def flagged_trips(t: Tables) -> DataFrame:
    """Vehicle trips with 0 passengers where the request is a repositioning request, and whether such a row still has some."""
    marks = t["tnc_request"].where("service_type = 99").select("folder", "tnc_request_id", F.lit(True).alias("_repo"))
    joined = left_join_spreading_nulls(t["tnc_trip"], marks, "request", "tnc_request_id", "tnc_trip_id_int")
    fix = _repairable() & F.coalesce("_repo", F.lit(False))
    cleared = F.when(fix, F.lit(0)).otherwise(F.col("passengers")).cast("bigint")
    return joined.withColumn("passengers", cleared).withColumn(LEFT_OVER, fix & (F.col("passengers") > 0)).drop("_repo")


def repaired_trips(t: Tables) -> DataFrame:
    return flagged_trips(t).drop(LEFT_OVER)


def repaired_tables(t: Tables) -> Tables:
    """The same tables with both repairs applied."""
    return ChainMap({"tnc_request": repaired_requests(t), "tnc_trip": repaired_trips(t)}, t)


def cases_with_requests(t: Tables) -> DataFrame:
    """Folders with at least one ride-hail request."""
    return t["tnc_request"].select("folder").distinct()


def repair_check(t: Tables) -> DataFrame:
    """Largest party size and passenger count on repositioning rows of the given tables, for every case with requests.

    ``ok`` is False only where the repair applies and something is there; an empty maximum passes.
    """
    requests = t["tnc_request"]
    parties = requests.groupBy("folder").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.when(is_repositioning("service_type"), F.col("party_size"))).alias("max_party")
    )
    by_request = t["tnc_trip"].groupBy("folder", "request").agg(F.max("passengers").alias("max_pass"))
    repo = requests.where("service_type = 99").select("folder", F.col("tnc_request_id").alias("request"))
    passengers = by_request.join(repo, ["folder", "request"]).groupBy("folder").agg(F.max("max_pass").alias("max_pass"))
    left = F.greatest(F.coalesce("max_party", F.lit(0)), F.coalesce("max_pass", F.lit(0)))
    return one_row_per_case([parties, passengers]).where("n IS NOT NULL").select(
        "folder", "max_party", "max_pass", _repairable().alias("repaired"), (~_repairable() | (left <= 0)).alias("ok")
    )


def require_repaired(t: Tables) -> None:
    """Raise if the tables, as the reports will read them, have passengers or party members on repositioning rows."""
    bad = repair_check(t).where("NOT ok").select("folder")
    total, first = bad.agg(F.count(F.lit(1)), F.min("folder")).first()
    if total:
        raise ValueError(f"repositioning rows still carry passengers in {total} cases, of which the first is {first}")
