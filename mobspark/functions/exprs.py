"""Column builders shared by the reports. All are native Spark expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------
METRES_PER_MILE = 1609.34
MILES_PER_KM = 0.621371
WALK_MPH = 2.1
WALK_LIMIT_MIN = 8.0
REPOSITIONING = 99  # service type of an empty repositioning request

INCOME_EDGES = [*range(0, 150_000, 10_000), 150_000, 175_000, 200_000, 225_000,
                250_000, 300_000, 350_000, 400_000, 450_000]
AGE_EDGES = [0, 12, 16, 18, 22, 25, 30, 35, 40, 45, 50, 60, 70]
OUT_OF_BAND = 999

QUARTILE_THRESHOLDS = [
    (95340, "4- >75%"),
    (51906, "3- between 50% and 75%"),
    (26339, "2- between 25% and 50%"),
]
QUARTILE_LOWEST = "1- <25%"
QUARTILES = [QUARTILE_LOWEST, *(label for _, label in reversed(QUARTILE_THRESHOLDS))]

# mode code -> name
MODE_NAMES = {
    0: "SOV", 1: "AUTO_NEST", 2: "HOV", 3: "TRUCK", 4: "BUS", 5: "RAIL",
    6: "NONMOTORIZED_NEST", 7: "BICYCLE", 8: "WALK", 9: "TAXI", 10: "SCHOOLBUS",
    11: "PARK_AND_RIDE", 12: "KISS_AND_RIDE", 13: "PARK_AND_RAIL", 14: "KISS_AND_RAIL",
    15: "TNC_AND_RIDE", 17: "MD_TRUCK", 18: "HD_TRUCK", 19: "BPLATE", 20: "LD_TRUCK",
    21: "RAIL_NEST", 22: "BUS40", 23: "BUS60", 24: "PNR_BIKE_NEST",
    25: "RIDE_AND_UNPARK", 26: "RIDE_AND_REKISS", 27: "RAIL_AND_UNPARK",
    28: "RAIL_AND_REKISS", 29: "MICROM", 30: "MICROM_NODOCK", 31: "MICROM_AND_TRANSIT",
    32: "MICROM_NODOCK_AND_TRANSIT", 33: "ODDELIVERY", 34: "DUMMY REPOSITIONING",
    999: "FAIL_MODE", 1000: "FAIL_ROUTE", 1001: "FAIL_REROUTE", 1002: "FAIL_UNPARK",
    1003: "FAIL_UNPARK2", 1004: "FAIL_MODE1", 1005: "FAIL_MODE2", 1006: "FAIL_MODE3",
    1007: "FAIL_ROUTE_ACTIVE", 1008: "FAIL_ROUTE_WALK_AND_TRANSI",
    1009: "FAIL_ROUTE_DRIVE_TO_TRANSI", 1010: "FAIL_ROUTE_DRIVE_FROM_TRAN",
    1011: "FAIL_ROUTE_TNC_AND_TRANSIT", 1012: "FAIL_ROUTE_TNC", 1013: "FAIL_ROUTE_SOV",
    1014: "FAIL_ROUTE_MICROMOBILITY", 1015: "NO_MOVE", 9999: "UNSIMULATED",
}
# -------------------------------------------------------------------------------


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def named(**expressions: str) -> list[Column]:
    """SQL expressions under their names; one parse per column instead of a chain of calls."""
    return [F.expr(text).alias(name) for name, text in expressions.items()]


def ratio(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL for a zero denominator (ANSI mode would raise)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def miles(metres: str | Column) -> Column:
    return col(metres) / F.lit(METRES_PER_MILE)


def age_class(age: str | Column) -> Column:
    """Senior 2, child 0, everyone else (unknown age too) 1."""
    a = col(age)
    return F.when(a > 60, 2).when(a < 18, 0).otherwise(1)


def age_class_activity(age: str | Column) -> Column:
    """Activity variant: 18-year-olds and unknown ages count as class 0."""
    a = col(age)
    return F.when(a > 60, 2).when(a > 18, 1).otherwise(0)


def band(value: str | Column, edges: Sequence[float]) -> Column:
    """Index of the half-open band a value falls in; below the first edge or NULL is 999."""
    v = col(value)
    out = None
    for i in reversed(range(len(edges))):
        out = F.when(v >= edges[i], i) if out is None else out.when(v >= edges[i], i)
    return out.otherwise(OUT_OF_BAND)


def income_level(income: str | Column) -> Column:
    return band(income, INCOME_EDGES)


def age_level(age: str | Column) -> Column:
    return band(age, AGE_EDGES)


def income_quartile(income: str | Column) -> Column:
    v = col(income)
    out = None
    for threshold, label in QUARTILE_THRESHOLDS:
        out = F.when(v > threshold, label) if out is None else out.when(v > threshold, label)
    return out.otherwise(QUARTILE_LOWEST)


def level(value: str | Column, thresholds: Sequence[float], no_data: str | None = None) -> Column:
    """1 above the first threshold, 2 above the second, ...; text so that a label fits too."""
    v = col(value)
    out = F.when(v.isNull(), F.lit(no_data)) if no_data is not None else None
    for i, edge in enumerate(thresholds, start=1):
        out = F.when(v > edge, F.lit(str(i))) if out is None else out.when(v > edge, F.lit(str(i)))
    return out.otherwise(F.lit(str(len(thresholds) + 1)))


def is_repositioning(service_type: str | Column) -> Column:
    """True only for repositioning; an unmatched (NULL) type is False."""
    return F.coalesce(col(service_type) == REPOSITIONING, F.lit(False))


def effective_passengers(passengers: str | Column, service_type: str | Column) -> Column:
    return F.when(col(service_type) == REPOSITIONING, 0).otherwise(col(passengers))


def purpose_flags(origin: Column, destination: Column, home: Column, work: Column) -> dict[str, Column]:
    """Home-based work, home-based other and non-home-based conditions.

    Three-valued: a NULL home or work location leaves a condition NULL where it matters.
    """
    return {
        "HBW": destination == work,
        "HBO": (origin == home) & (destination != work),
        "NHB": (origin != home) & (destination != home) & (destination != work),
    }


def row_total(*columns: str) -> Column:
    """Sum across columns, NULL counting as 0."""
    return F.expr(" + ".join(f"coalesce(CAST(`{c}` AS DOUBLE), 0D)" for c in columns))


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def sum_if(cond: Column, value: str | Column) -> Column:
    return F.sum(F.when(cond, col(value)))


def avg_if(cond: Column, value: str | Column) -> Column:
    return F.avg(F.when(cond, col(value)))


def time_bucket(seconds: str | Column, width: int) -> Column:
    return F.floor(col(seconds) / F.lit(float(width))).cast("int")


def distance_bin(distance: str | Column, half_units: bool = False) -> Column:
    """Bin of trunc(2*distance): whole units by default, half units on request."""
    doubled = (col(distance) * 2).cast("bigint")
    if half_units:
        return doubled / F.lit(2.0)
    return (doubled / F.lit(2)).cast("bigint")


def mode_name(code: str | Column) -> Column:
    """Mode code to name through a literal map; unknown codes are NULL."""
    pairs: list[Column] = []
    for k, v in MODE_NAMES.items():
        pairs += [F.lit(k).cast("bigint"), F.lit(v)]
    return F.element_at(F.create_map(*pairs), col(code).cast("bigint"))


def relabel(value: str | Column, names: Mapping[str, str]) -> Column:
    """Dictionary replacement; values without an entry are kept."""
    v = col(value)
    pairs: list[Column] = []
    for k, new in names.items():
        pairs += [F.lit(k), F.lit(new)]
    return F.coalesce(F.element_at(F.create_map(*pairs), v), v)


def stars(p_value: str | Column) -> Column:
    p = col(p_value)
    return F.when(p < 0.005, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("")


def short_number(value: str | Column, digits: int) -> Column:
    """Half-even rounding as text without a trailing zero beyond the first decimal."""
    text = F.bround(col(value), digits).cast(f"decimal(38,{digits})").cast("string")
    return F.regexp_replace(text, "0$", "") if digits > 1 else text


def starred(value: str | Column, star: str | Column) -> Column:
    return F.concat(short_number(value, 2), F.lit(" "), col(star))


def starred_percent(value: str | Column, star: str | Column) -> Column:
    return F.concat(short_number(col(value) * 100, 1), F.lit("% "), col(star))
