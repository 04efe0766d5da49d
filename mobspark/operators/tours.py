"""Sub-tours: split a vehicle's tour each time a leg starts empty."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mobspark.functions.exprs import named

TOUR = ["folder", "vehicle", "tour"]
BUCKET_SECONDS = 60
LAST_BUCKET = 1 << 30  # legs without a start time sort last
ROWS_PER_BUCKET = 1 << 32


def add_sub_tours(trips: DataFrame, bucket_s: int = BUCKET_SECONDS) -> DataFrame:
    """Add ``sub_tour`` (0, 1, ...) and ``seq`` (unique order key within the tour).

    The counter grows at every leg with 0 passengers except the first leg. It is a running count
    over (start, trip id), computed in two levels so that one very long tour is not one sort in one
    task: a running count inside each time bucket, plus a carry from the per-bucket totals. Only the
    totals, at most one row per tour and bucket, are ordered per tour. Rows without vehicle or tour
    belong to no tour and are left out.
    """
    empty = F.coalesce((F.col("passengers") == 0).cast("int"), F.lit(0))
    legs = trips.where("vehicle IS NOT NULL AND tour IS NOT NULL").withColumns({
        "_bucket": F.coalesce(F.floor(F.col("start_s") / F.lit(float(bucket_s))), F.lit(LAST_BUCKET)),
        "_empty": empty,
    })
    bucket_key = [*TOUR, "_bucket"]

    totals = legs.groupBy(*bucket_key).agg(
        F.sum("_empty").alias("_n"),
        F.min(F.struct("start_s", "tnc_trip_id_int", "_empty")).alias("_first"),
    )
    by_bucket = Window.partitionBy(*TOUR).orderBy("_bucket")
    carry = totals.select(
        *bucket_key,
        (
            F.coalesce(F.sum("_n").over(by_bucket.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            - F.first("_first._empty").over(by_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        ).alias("_carry"),
    )
    in_bucket = Window.partitionBy(*bucket_key).orderBy(F.col("start_s").asc_nulls_last(), "tnc_trip_id_int")
    running = in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = legs.withColumns({
        "_running": F.sum("_empty").over(running),
        "seq": F.col("_bucket") * F.lit(ROWS_PER_BUCKET) + F.row_number().over(in_bucket),
    })
    return (
        counted.join(carry, bucket_key)
        .withColumn("sub_tour", (F.col("_running") + F.col("_carry")).cast("bigint"))
        .drop("_bucket", "_empty", "_running", "_carry")
    )


def tour_rollup(legs: DataFrame, more: Mapping[str, str] | None = None) -> DataFrame:
    """One row per sub-tour from legs with ``sub_tour`` and ``seq``; ``more`` are further aggregates (name -> SQL).

    first/last mean the first/last non-NULL value in leg order. The trip-level sums at the end let
    case-level ratios be taken from this frame without a second pass over the legs.
    """
    def first(c: str) -> str:
        return f"min_by({c}, CASE WHEN {c} IS NOT NULL THEN seq END)"

    pickup = "coalesce(passengers < 1, false)"
    not_99, not_3 = "NOT service_type <=> 99", "NOT init_status <=> -3"
    agg = legs.groupBy(*TOUR, "sub_tour").agg(*named(
        tour_start="min(start_s)", tour_end="max(end_s)", max_passengers="max(passengers)",
        total_skim_travel_time="coalesce(sum(skim_travel_time), 0D)",
        total_routed_travel_time="coalesce(sum(routed_travel_time), 0D)",
        service_type=first("service_type"), hour=first("hour"), origin_zone=first("origin_zone"),
        destination_zone=first("destination_zone").replace("min_by", "max_by"),
        total_travel_distance="coalesce(sum(travel_distance), 0D)", init_status=first("init_status"),
        requests_served="count(1)", any_repositioning="max(CASE WHEN service_type = 99 THEN 1 ELSE 0 END)",
        passenger_distance="sum(passengers * travel_distance)",
        occupied_passenger_distance="sum(CASE WHEN passengers > 0 THEN passengers * travel_distance END)",
        occupied_distance="sum(CASE WHEN passengers > 0 THEN travel_distance END)",
        pickup_distance_99=f"sum(CASE WHEN {pickup} AND {not_99} THEN travel_distance END)",
        pickup_legs_99=f"count(CASE WHEN {pickup} AND {not_99} THEN travel_distance END)",
        pickup_distance_3=f"sum(CASE WHEN {pickup} AND {not_3} THEN travel_distance END)",
        pickup_legs_3=f"count(CASE WHEN {pickup} AND {not_3} THEN travel_distance END)", **(more or {}),
    ))
    return agg.withColumns({
        "pooled_tour": F.expr("requests_served > 1"),
        "final_tour_id": F.expr("concat(vehicle, '_tour_', tour, '_sub_', sub_tour)"),
    })
