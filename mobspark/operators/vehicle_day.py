"""A vehicle's day in one pass: sub-tours and next service trips of the same legs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mobspark.operators.asof import MICROS
from mobspark.operators.tours import BUCKET_SECONDS, LAST_BUCKET, ROWS_PER_BUCKET, TOUR


def add_vehicle_day(legs: DataFrame, rules: Mapping[str, tuple[Column, Column]], horizon_s: int = 3600,
                    bucket_s: int = BUCKET_SECONDS) -> DataFrame:
    """``add_sub_tours`` and, for each rule (name -> probe, service), ``next_service_trip`` at once.

    Adds ``sub_tour`` and ``seq``, and for each rule ``<name>_probe`` and ``<name>_next``, the struct (us, id, zone) of the
    vehicle's next service trip within the horizon, NULL for rows that are no probe. Rows without vehicle or tour are left
    out; rows without a start time are neither probe nor service.

    Time is cut into buckets as in both operators. Legs are dealt by (vehicle, bucket) once, for the windows inside a
    bucket. What crosses buckets, the empty legs before and the first service start after, comes from one row per tour and
    bucket, which is all that is ordered per vehicle, so a vehicle that holds very many legs is spread over many tasks.
    """
    step = bucket_s * MICROS
    rows = legs.where("vehicle IS NOT NULL AND tour IS NOT NULL").withColumns({
        "_us": F.expr(f"CAST(round(start_s * {MICROS}) AS BIGINT)"),
        "_empty": F.coalesce((F.col("passengers") == 0).cast("int"), F.lit(0)),
        **{f"{r}_probe": F.coalesce(probe, F.lit(False)) & F.col("start_s").isNotNull() for r, (probe, _) in rules.items()},
        **{f"_{r}_serves": F.coalesce(service, F.lit(False)) & F.col("start_s").isNotNull() for r, (_, service) in rules.items()},
    }).withColumns({
        "_bucket": F.coalesce(F.expr(f"CAST(floor(_us / {step}.0D) AS BIGINT)"), F.lit(LAST_BUCKET)),
        **{f"_{r}_self": F.when(F.col(f"_{r}_serves"), F.struct(
            F.col("_us").alias("us"), F.col("tnc_trip_id_int").alias("id"), F.col("origin_zone").alias("zone"))) for r in rules},
    }).drop(*[f"_{r}_serves" for r in rules])
    place, leg_place = ["folder", "vehicle", "_bucket"], [*TOUR, "_bucket"]

    totals = rows.groupBy(*leg_place).agg(
        F.sum("_empty").alias("_n"), F.min(F.struct("start_s", "tnc_trip_id_int", "_empty")).alias("_first"),
        *[F.min(f"_{r}_self").alias(f"_{r}_head") for r in rules])
    by_bucket = Window.partitionBy(*TOUR).orderBy("_bucket")
    later_buckets = Window.partitionBy("folder", "vehicle").orderBy(F.desc("_bucket")).rangeBetween(Window.unboundedPreceding, -1)
    across = totals.withColumns({f"_{r}_head": F.min(f"_{r}_head").over(Window.partitionBy(*place)) for r in rules}).select(
        *leg_place,
        (
            F.coalesce(F.sum("_n").over(by_bucket.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            - F.first("_first._empty").over(by_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        ).alias("_carry"),
        *[F.last(f"_{r}_head", ignorenulls=True).over(later_buckets).alias(f"_{r}_onward") for r in rules],
    )
    in_bucket = Window.partitionBy(*leg_place).orderBy(F.col("start_s").asc_nulls_last(), "tnc_trip_id_int")
    later = Window.partitionBy(*place).orderBy(F.desc("_us")).rangeBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumns({
        **{f"_{r}_found": F.min(f"_{r}_self").over(later) for r in rules},
        "_running": F.sum("_empty").over(in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "seq": F.col("_bucket") * F.lit(ROWS_PER_BUCKET) + F.row_number().over(in_bucket),
    })

    def onward(r: str) -> Column:
        hit = F.coalesce(f"_{r}_found", f"_{r}_onward")
        return F.when(F.col(f"{r}_probe") & (hit["us"] - F.col("_us") <= horizon_s * MICROS), hit)

    out = inside.join(across, leg_place).withColumns({
        "sub_tour": (F.col("_running") + F.col("_carry")).cast("bigint"), **{f"{r}_next": onward(r) for r in rules}})
    return out.drop("_us", "_empty", "_bucket", "_running", "_carry", *[f"_{r}_{x}" for r in rules for x in ("self", "found", "onward")])
