"""As-of operators: next service trip of a vehicle, and the skim period of a request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mobspark.functions.exprs import METRES_PER_MILE
from mobspark.operators.joins import attach_case_rows

MICROS = 1_000_000
BUCKET_SECONDS = 60


def next_service_trip(
    trips: DataFrame, probe: Column, service: Column, horizon_s: int = 3600, bucket_s: int = BUCKET_SECONDS
) -> DataFrame:
    """For each ``probe`` trip the vehicle's next ``service`` trip, strictly later and within the horizon.

    Adds ``next_trip`` and ``next_origin_zone`` (NULL if none); ties in start go to the lower trip id.
    Time is cut into buckets so that one busy vehicle is many small windows: a probe looks for a later
    service start in its own bucket first and otherwise takes the first service start of the vehicle's
    next bucket that has one. Only one summary row per vehicle and bucket is ordered per vehicle.
    """
    step = bucket_s * MICROS
    rows = (
        trips.where("vehicle IS NOT NULL AND start_s IS NOT NULL")
        .withColumns({"_probe": F.coalesce(probe, F.lit(False)), "_service": F.coalesce(service, F.lit(False))})
        .where("_probe OR _service")
        .withColumn("_us", F.expr(f"CAST(round(start_s * {MICROS}) AS BIGINT)"))
        .withColumns({
            "_bucket": F.expr(f"CAST(floor(_us / {step}.0D) AS BIGINT)"),
            "_self": F.expr(
                "CASE WHEN _service THEN named_struct('us', _us, 'id', tnc_trip_id_int, 'zone', origin_zone) END"),
        })
    )
    key = ["folder", "vehicle", "_bucket"]
    later = Window.partitionBy(*key).orderBy(F.col("_us").desc()).rangeBetween(Window.unboundedPreceding, -1)
    in_bucket = rows.withColumn("_found", F.min("_self").over(later)).where("_probe")

    heads = rows.groupBy(*key).agg(F.min("_self").alias("_head"))
    following = (
        Window.partitionBy("folder", "vehicle").orderBy(F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    onward = heads.select(*key, F.last("_head", ignorenulls=True).over(following).alias("_onward"))
    hit = f"CASE WHEN coalesce(_found, _onward).us - _us <= {horizon_s * MICROS} THEN coalesce(_found, _onward) END"
    return (
        in_bucket.join(onward, key, "left")
        .withColumns({"next_trip": F.expr(f"({hit}).id"), "next_origin_zone": F.expr(f"({hit}).zone")})
        .drop("_probe", "_service", "_us", "_bucket", "_self", "_found", "_onward")
    )


def skim_periods(skim: DataFrame) -> DataFrame:
    """Sorted list of the skim's time periods per case (minutes of the day, so at most 1440)."""
    return skim.groupBy("folder").agg(F.sort_array(F.collect_set("period")).alias("periods"))


def with_skim_period(requests: DataFrame, skim: DataFrame, mode: str = "first", periods: DataFrame | None = None) -> DataFrame:
    """Add ``skim_period``: the smallest one not before the request minute, NULL after the last; with ``mode="last"`` the last
    period of the day for every request."""
    with_periods = attach_case_rows(requests, skim_periods(skim) if periods is None else periods)
    minute = F.col("request_time") / 60.0
    if mode == "first":
        period = F.array_min(F.filter("periods", lambda p: p >= minute))
    elif mode == "last":
        period = F.array_max("periods")
    else:
        raise ValueError("mode must be 'first' or 'last'")
    return with_periods.withColumn("skim_period", period).drop("periods")


def skim_lookup(requests: DataFrame, skim: DataFrame, mode: str = "first", periods: DataFrame | None = None) -> DataFrame:
    """Add ``skim_period`` (see ``with_skim_period``), ``skim_time`` (minutes) and ``skim_dist`` (miles) to requests."""
    values = skim.select(
        "folder", F.col("period").alias("skim_period"), "origin_zone", "destination_zone",
        F.col("time_min").alias("skim_time"), (F.col("dist_m") / METRES_PER_MILE).alias("skim_dist"),
    )
    return with_skim_period(requests, skim, mode, periods).join(
        values, ["folder", "skim_period", "origin_zone", "destination_zone"], "left")
