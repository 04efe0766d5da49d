"""Operating-model finances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobspark.functions.exprs import METRES_PER_MILE, MILES_PER_KM, age_class, level, named, ratio
from mobspark.operators.joins import join_by_shuffle, one_row_per_case
from mobspark.plans.common import Tables, trips_by_request, unless_repo
from mobspark.plans.ridehail import priced_requests

# ---- fixed values: pay and cost rates --------------------------------------------------------------
PAY_PER_MINUTE, PAY_PER_MILE, MINIMUM_PAY = 1.4, 0.51, 5.0
TAKE_RATE = 0.21
FLAT_FARE_LOW, FLAT_FARE_HIGH = 2, 4
VAN_PER_KM, MINIBUS_PER_KM = 3.54, 1.96
SAEV_POOLED_PER_KM, SAEV_SOLO_PER_KM = 0.58, 0.48
# ----------------------------------------------------------------------------------------------------
FOLDER_COLUMNS = ["City", "Strategy", "Fleet Size"]
CASE_GRAIN = ["age_class", "City", "Fleet Size", "Strategy", "Iteration"]
SENIOR = 2


def demo_financial_case_data(t: Tables, params: DataFrame, mode: str = "first") -> DataFrame:
    """Revenue and cost of the operating models by age class and origin zone.

    Requests are summed per person and zone before the join to persons.
    """
    dist, time = F.col("skim_dist"), F.col("skim_time")
    pay = dist * PAY_PER_MILE + time * PAY_PER_MINUTE
    pooled = F.coalesce(F.col("pooled_service") == 1, F.lit(False))
    saev = dist * F.when(pooled, F.lit(SAEV_POOLED_PER_KM / MILES_PER_KM)).otherwise(F.lit(SAEV_SOLO_PER_KM / MILES_PER_KM))
    ages = t["person"].select("folder", "person", "age")
    sums = ["pay", "under", "n", "minibus", "van", "saev", "fare"]
    by_person = priced_requests(t, params, mode).where("origin_zone IS NOT NULL").groupBy("folder", "person", "origin_zone").agg(
        F.sum(F.greatest(pay, F.lit(MINIMUM_PAY))).alias("pay"), F.count(F.when(pay < MINIMUM_PAY, 1)).alias("under"),
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(dist * (MINIBUS_PER_KM / MILES_PER_KM)), F.lit(0.0)).alias("minibus"),
        F.coalesce(F.sum(dist * (VAN_PER_KM / MILES_PER_KM)), F.lit(0.0)).alias("van"),
        F.coalesce(F.sum(saev), F.lit(0.0)).alias("saev"), F.coalesce(F.sum("corrected fare"), F.lit(0.0)).alias("fare"),
    )
    grouped = join_by_shuffle(by_person, ages, ["folder", "person"], "left").groupBy(
        "folder", age_class("age").alias("age_class"), "origin_zone").agg(*[F.sum(c).alias(c) for c in sums])
    requests = t["tnc_request"].where("service_type <> 99").groupBy("folder").agg(F.count(F.lit(1)).alias("all_requests"))
    revenue = trips_by_request(t).groupBy("folder").agg(
        *named(secs=f"sum({unless_repo('sec_pos')})", metres=f"sum({unless_repo('d_pos')})")
    )
    cases = one_row_per_case([
        params.select("folder", F.col("trip_multiplier").alias("m"), F.col("fleet_size").alias("fleet")), requests, revenue
    ]).where("m IS NOT NULL")
    m = F.col("m")
    fare, total = F.col("fare") * m, F.coalesce("all_requests", F.lit(0)) * m
    return grouped.join(cases, "folder").select(
        "folder", "age_class", "origin_zone", (F.col("pay") * m).alias("total pay 1_a"), (F.col("under") * m).alias("1_a_cnt_req_under_5"),
        (F.col("n") * FLAT_FARE_LOW * m).alias("total_fare_2_low"), (F.col("n") * FLAT_FARE_HIGH * m).alias("total_fare_2_high"),
        (F.col("minibus") * m).alias("total_operating_cost_2_minibus"), (F.col("van") * m).alias("total_operating_cost_2_van"),
        (F.col("saev") * m).alias("total_operating_cost_3"), fare.alias("total_fare"), total.alias("requests"),
        F.col("fleet").alias("fleet_size"), ratio(fare, "fleet").alias("revenue per vehicle"), ratio(fare, total).alias("revenue per request"),
        (F.col("secs") / 60 * m).alias("revenue_minutes_traveled"), (F.col("metres") / METRES_PER_MILE * m).alias("revenue_miles_traveled"),
        (fare * TAKE_RATE).alias("uber take"),
    )


# ---- dashboard tables: input is the report with the case columns added -------------------------------

def financial_case_data(report: DataFrame) -> DataFrame:
    """The report summed by age class and case; driver pay is what the take leaves of the fares."""
    sums = [
        "total pay 1_a", "1_a_cnt_req_under_5", "total_fare_2_low", "total_fare_2_high", "total_operating_cost_2_minibus",
        "total_operating_cost_2_van", "total_operating_cost_3", "total_fare", "requests", "uber take", "driver pay take rate",
        "revenue_minutes_traveled", "revenue_miles_traveled",
    ]
    sized = report.withColumns({
        "Fleet Size": F.col("fleet_size").cast("string"), "driver pay take rate": F.col("total_fare") - F.col("uber take"),
    })
    return sized.groupBy(*CASE_GRAIN).agg(*[F.sum(c).alias(c) for c in sums])


def case_1_a(data: DataFrame) -> DataFrame:
    """Operator pays drivers per mile and minute."""
    return data.select(
        *CASE_GRAIN, "total pay 1_a", "1_a_cnt_req_under_5", "total_fare", "requests", "revenue_minutes_traveled",
        "revenue_miles_traveled", (F.col("total_fare") - F.col("total pay 1_a")).alias("Gross Profit"),
    )


def case_1_b(data: DataFrame) -> DataFrame:
    """Operator keeps a share of the fares."""
    return data.select(
        *CASE_GRAIN, "total_fare", "requests", F.col("uber take").alias("Gross Profit"), "driver pay take rate",
        "revenue_minutes_traveled", "revenue_miles_traveled",
    )


def case_2(data: DataFrame) -> DataFrame:
    """Flat public fares with van or minibus operation."""
    low, high = F.col("total_fare_2_low"), F.col("total_fare_2_high")
    van, minibus = F.col("total_operating_cost_2_van"), F.col("total_operating_cost_2_minibus")
    return data.select(
        *CASE_GRAIN, "total pay 1_a", "total_fare_2_low", "total_fare_2_high", "total_operating_cost_2_minibus",
        "total_operating_cost_2_van", "total_fare", "requests", (low - van).alias("Low Fare Gross Profit Van"),
        (high - van).alias("High Fare Gross Profit Van"), (low - minibus).alias("Low Fare Gross Profit Minibus"),
        (high - minibus).alias("High Fare Gross Profit Minibus"),
    )


def case_3(data: DataFrame) -> DataFrame:
    """Operator-owned automated fleet."""
    return data.select(
        *CASE_GRAIN, "total_operating_cost_3", "total_fare", "requests", "revenue_minutes_traveled", "revenue_miles_traveled",
        (F.col("total_fare") - F.col("total_operating_cost_3")).alias("Gross Profit"),
    )


def combined_financial_cases(data: DataFrame) -> DataFrame:
    """All operating models side by side. They share one grain, so this is a projection, not a join."""
    low, high = F.col("total_fare_2_low"), F.col("total_fare_2_high")
    van, minibus = F.col("total_operating_cost_2_van"), F.col("total_operating_cost_2_minibus")
    return data.select(
        *CASE_GRAIN, "total pay 1_a", "1_a_cnt_req_under_5", "total_fare", "requests", "driver pay take rate", "total_fare_2_low",
        "total_fare_2_high", "total_operating_cost_2_minibus", "total_operating_cost_2_van", "total_operating_cost_3",
        "revenue_minutes_traveled", "revenue_miles_traveled", (F.col("total_fare") - F.col("total pay 1_a")).alias("Case 1 A"),
        F.col("uber take").alias("Case 1 B"), (low - van).alias("Case 2:Low Fare Van"), (high - van).alias("Case 2:High Fare Van"),
        (low - minibus).alias("Case 2:Low Fare Minibus"), (high - minibus).alias("Case 2:High Fare Minibus"),
        (F.col("total_fare") - F.col("total_operating_cost_3")).alias("Case 3"),
    )


def senior_cost_by_zone(demographic: DataFrame, report: DataFrame, columns: Sequence[str] = FOLDER_COLUMNS) -> DataFrame:
    """Senior fares of a zone against the distance of all its requests.

    The distance is in metres although the source's column name says miles; both unit costs are
    given, each with its level (1 above 1, 2 above 0.8, 3 above 0.7, 4 above 0.6, else 5).
    """
    distance = demographic.where("ZONE IS NOT NULL").groupBy(*columns, F.col("ZONE").cast("string").alias("zone")).agg(
        F.sum(F.col("AVG_DIST") * METRES_PER_MILE * F.col("REQUESTS")).alias("dist_metres"), F.sum("REQUESTS").alias("zone requests")
    )
    seniors = report.where((F.col("age_class") == SENIOR) & F.col("total_fare").isNotNull()).withColumns({
        "zone": F.col("origin_zone").cast("string"), "driver pay take rate": F.col("total_fare") - F.col("uber take"),
    }).drop("origin_zone")
    bands = [1, 0.8, 0.7, 0.6]
    return distance.join(seniors, [*columns, "zone"]).withColumns({
        "cost per metre": ratio("total_fare", "dist_metres"),
        "cost per mile": ratio("total_fare", F.col("dist_metres") / METRES_PER_MILE),
    }).withColumns({"Per Metre Level": level("cost per metre", bands), "Per Mile Level": level("cost per mile", bands)})
