"""Simulation tables derived from the driver's parquet tables (definitions in FIXTURES.md).

Every view is plain arithmetic on stored keys and values. Case-wide copies are an
``explode`` of the four case labels, so no view needs a cross join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# case label, trip multiplier
CASES = [("gsc_300_nr_7", 4.0), ("gsc_300_jar_7", 4.0), ("atx_500_nr_3", 2.0), ("atx_500_0.2_3", 2.0)]
PERIODS = [360, 600, 900, 1140, 1440]
# ride-hail parameters of the demonstration case
FLEET_SIZE, PER_MINUTE, PER_MILE, BASE_FARE, POOLING_DISCOUNT = 500, 0.274, 1.22, 7.27, 0.42


def _folder_of(key: str) -> Column:
    return F.element_at(F.array(*[F.lit(f) for f, _ in CASES]), (F.expr(f"{key} % 4") + 1).cast("int"))


def _every_folder() -> Column:
    return F.explode(F.array(*[F.lit(f) for f, _ in CASES]))


class DriverTables(dict):
    """``tables[name]`` for the simulation tables, each built from the parquet files on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    def __missing__(self, name: str) -> DataFrame:
        if name not in _VIEWS:
            raise KeyError(name)
        self[name] = _VIEWS[name](self)
        return self[name]


def _case_params(t: DriverTables) -> DataFrame:
    rows = ", ".join(
        f"('{f}', {m}D, {FLEET_SIZE}L, {PER_MINUTE}D, {PER_MILE}D, {BASE_FARE}D, "
        f"'{'default' if '_nr_' in f else 'auction'}', {POOLING_DISCOUNT}D)" for f, m in CASES
    )
    columns = (
        "folder, trip_multiplier, fleet_size, per_minute, per_mile, base_fare, assignment_strategy, pooling_discount"
    )
    return t.spark.sql(f"SELECT * FROM VALUES {rows} AS t({columns})")


def _location(t: DriverTables) -> DataFrame:
    return t.raw("part").select(
        _every_folder().alias("folder"),
        F.col("p_partkey").alias("location"),
        F.col("p_size").cast("bigint").alias("zone"),
        F.expr("CAST((p_partkey*7919)%20011 AS DOUBLE) AS x"),
        F.expr("CAST((p_partkey*104729)%20021 AS DOUBLE) AS y"),
    )


def _zone(t: DriverTables) -> DataFrame:
    zones = t.raw("part").select(F.col("p_size").cast("bigint").alias("zone")).distinct()
    return zones.select(_every_folder().alias("folder"), "zone", F.expr("CAST(zone % 5 AS INT) AS area_type"))


def _household(t: DriverTables) -> DataFrame:
    return t.raw("customer").select(
        _folder_of("c_custkey").alias("folder"),
        F.col("c_custkey").alias("household"),
        F.expr("CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_custkey % 200 END AS location"),
        F.expr("CAST(c_acctbal*40 AS DOUBLE) AS income"),
        F.expr("c_custkey % 4 AS vehicles"),
        F.expr("1 + c_custkey % 5 AS persons"),
        F.expr("c_custkey % 3 AS workers"),
    )


def _person(t: DriverTables) -> DataFrame:
    members = t["household"].withColumn("i", F.explode(F.array(F.lit(0), F.lit(1))))
    return members.selectExpr(
        "folder", "household*2 + i AS person", "household",
        "CASE WHEN household % 23 = 0 THEN NULL ELSE (household*37 + i*41) % 95 END AS age",
        "CASE WHEN household % 5 = 0 THEN NULL ELSE (household*13 + i) % 200 END AS work_location_id",
        "income/2 AS income", "household % 6 AS education", "i AS gender", "household % 7 AS race",
        "household % 11 = 0 AS disability", "household % 3 AS marital_status",
    )


def _trip(t: DriverTables) -> DataFrame:
    return t.raw("orders").select(
        _folder_of("o_custkey").alias("folder"),
        F.col("o_orderkey").alias("trip_id"),
        F.expr("o_custkey*2 + o_orderkey % 2 AS person"),
        F.expr("CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 200 ELSE (o_orderkey*11) % 200 END AS origin"),
        F.expr(
            "CASE WHEN o_orderkey % 4 = 0 THEN (o_custkey*13 + o_orderkey % 2) % 200 "
            "WHEN o_orderkey % 4 = 1 THEN o_custkey % 200 ELSE (o_orderkey*7) % 200 END AS destination"
        ),
        F.expr("o_orderkey % 10 AS mode"),
        F.expr("CAST((o_orderkey*97) % 80000 AS DOUBLE) AS start_s"),
        F.expr("CAST((o_orderkey*97) % 80000 + (o_orderkey*31) % 3600 AS DOUBLE) AS end_s"),
        F.expr("o_totalprice/10 AS travel_distance"),
        F.expr("CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END AS has_artificial_trip"),
    )


def _activity(t: DriverTables) -> DataFrame:
    return t["trip"].selectExpr(
        "folder", "trip_id AS trip", "person",
        "CASE mode WHEN 0 THEN 'SOV' WHEN 4 THEN 'BUS' WHEN 5 THEN 'RAIL' WHEN 9 THEN 'TAXI' WHEN 8 THEN 'WALK' "
        "WHEN 7 THEN 'FAIL_REROUTE' ELSE 'NO_MOVE' END AS mode",
        "CASE trip_id % 4 WHEN 0 THEN 'WORK' WHEN 1 THEN 'HOME' WHEN 2 THEN 'SHOP' ELSE 'LEISURE' END AS type",
        "end_s - start_s + 600 AS duration",
    )


def _tnc_request(t: DriverTables) -> DataFrame:
    return t.raw("orders").select(
        _folder_of("o_custkey").alias("folder"),
        F.col("o_orderkey").alias("tnc_request_id"),
        F.expr("o_custkey*2 + o_orderkey % 2 AS person"),
        F.expr("CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderkey % 25 END AS assigned_vehicle"),
        F.expr("CASE WHEN o_orderkey % 7 = 0 THEN 99 ELSE 1 + o_orderkey % 2 END AS service_type"),
        F.expr("o_orderkey % 2 AS pooled_service"),
        F.expr("1 + o_orderkey % 3 AS party_size"),
        F.expr("CAST((o_orderkey*53) % 82000 AS DOUBLE) AS request_time"),
        F.expr("CAST((o_orderkey*53) % 82000 + (o_orderkey*29) % 900 AS DOUBLE) AS pickup_time"),
        F.expr(
            "CAST((o_orderkey*53) % 82000 + (o_orderkey*29) % 900 + 60 + (o_orderkey*41) % 2400 AS DOUBLE) AS dropoff_time"
        ),
        F.expr("CAST(60 + (o_orderkey*43) % 2000 AS DOUBLE) AS estimated_od_travel_time"),
        F.expr("o_totalprice/10000 AS fare"),
        F.expr("(o_orderkey % 5)/10.0D AS discount"),
        F.expr("o_totalprice/10000 AS distance"),
        F.expr("(o_orderkey*11) % 200 AS origin_location"),
        F.expr("1 + (o_orderkey*11) % 10 AS origin_zone"),
        F.expr("1 + (o_orderkey*7) % 10 AS destination_zone"),
    )


def _tnc_trip(t: DriverTables) -> DataFrame:
    requests = t["tnc_request"].select("folder", "tnc_request_id")
    # microseconds since the epoch, whatever the session time zone
    zoned = dict(t.raw("events").dtypes)["ts"] == "timestamp"
    micros = "unix_micros(ts)" if zoned else "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)"
    events = t.raw("events").select(
        "event_id", "user_id",
        F.expr(f"(CAST({micros} AS DOUBLE)/1000000 - 1704067200)/30 AS start_s"),
        F.expr("CAST(floor(event_id/2.0D) AS BIGINT) AS tnc_request_id"),
    )
    return events.join(requests, "tnc_request_id").selectExpr(
        "folder", "event_id AS tnc_trip_id_int",
        "CASE WHEN event_id % 31 = 0 THEN NULL ELSE tnc_request_id END AS request",
        "user_id AS vehicle", "CAST(floor(event_id/2000.0D) AS BIGINT) AS tour",
        "start_s", "start_s + 60 + (event_id*19) % 500 AS end_s", "event_id % 4 AS passengers",
        "CASE event_id % 5 WHEN 0 THEN -2 WHEN 1 THEN -3 ELSE 1 END AS init_status",
        "CAST(500 + (event_id*37) % 9000 AS DOUBLE) AS travel_distance",
        "CAST(60 + (event_id*23) % 1500 AS DOUBLE) AS skim_travel_time",
        "CAST(70 + (event_id*29) % 1700 AS DOUBLE) AS routed_travel_time",
    )


def _tnc_statistics(t: DriverTables) -> DataFrame:
    return t.raw("supplier").select(
        _folder_of("s_suppkey").alias("folder"),
        F.col("s_suppkey").alias("vehicle"),
        F.expr("CAST(floor(s_acctbal/100) AS INT) AS tot_dropoffs"),
    )


def _transit_vehicle_links(t: DriverTables) -> DataFrame:
    return t.raw("lineitem").select(
        _folder_of("l_orderkey").alias("folder"),
        F.col("l_orderkey").alias("object_id"),
        F.expr("CAST(floor(l_quantity) AS INT) % 4 AS value_seated_load"),
        F.expr("CASE WHEN l_linenumber % 4 = 0 THEN 1 ELSE 0 END AS value_standing_load"),
        F.expr("l_extendedprice/10 AS value_length"),
    )


def _transit_trips(t: DriverTables) -> DataFrame:
    # every tenth trip has an id that no vehicle refers to, so that there are vehicles without a trip
    return t.raw("orders").select(
        _folder_of("o_orderkey").alias("folder"),
        F.expr("CASE WHEN o_orderkey % 10 = 0 THEN -o_orderkey ELSE o_orderkey END AS trip_id"),
        F.expr("o_custkey % 100 AS pattern_id"),
    )


def _transit_patterns(t: DriverTables) -> DataFrame:
    # trips refer to the patterns 0 to 99; those below 10 are missing
    return t.raw("customer").select(
        _every_folder().alias("folder"),
        (F.col("c_custkey") + 10).alias("pattern_id"),
        F.col("c_nationkey").cast("bigint").alias("route_id"),
    )


def _transit_stops(t: DriverTables) -> DataFrame:
    return t.raw("supplier").select(
        _every_folder().alias("folder"),
        F.col("s_suppkey").alias("stop_id"),
        F.expr("CAST((s_suppkey*7907)%20011 AS DOUBLE) AS x"),
        F.expr("CAST((s_suppkey*6151)%20021 AS DOUBLE) AS y"),
    )


def _skim(t: DriverTables) -> DataFrame:
    """Dense zone x zone x period matrix over the zones (sizes of parts), which are few at every scale."""
    zones = t.raw("part").select(F.col("p_size").cast("bigint").alias("zone")).distinct()
    return (
        zones.agg(F.collect_set("zone").alias("zones"))
        .select("zones", F.explode("zones").alias("origin_zone"))
        .select("origin_zone", F.explode("zones").alias("destination_zone"))
        .withColumn("period", F.explode(F.array(*[F.lit(p) for p in PERIODS])))
        .select(
            _every_folder().alias("folder"), "period", "origin_zone", "destination_zone",
            F.expr("1.0D + abs(origin_zone - destination_zone)*0.7D + period/600.0D AS time_min"),
            F.expr("(1 + abs(origin_zone - destination_zone))*900.0D AS dist_m"),
        )
    )


def _run_dirs(t: DriverTables) -> DataFrame:
    """One row per iteration directory of a case (customer), with its finished marker."""
    return t.raw("orders").selectExpr(
        "concat('case_', o_custkey) AS case_name",
        "CASE o_orderkey % 8 WHEN 0 THEN concat('case_', o_custkey, '_iteration_') WHEN 1 THEN 'abm_init_iteration' "
        "WHEN 2 THEN 'logs' ELSE concat('case_', o_custkey, '_iteration_', o_orderkey % 13) END AS dir_name",
        "o_orderstatus <> 'F' AS finished",
    )


def _case_labels(t: DriverTables) -> DataFrame:
    """Case names of every accepted shape, one per customer."""
    return t.raw("customer").selectExpr(
        "c_custkey AS case_id",
        "CASE c_custkey % 6 WHEN 0 THEN concat('gvl_heur_', c_custkey % 9) "
        "WHEN 1 THEN concat('gsc_', 100 * c_nationkey, '_nr_', c_custkey % 9) "
        "WHEN 2 THEN concat('atx_', 100 * c_nationkey, '_0.', 1 + c_custkey % 9, '_', c_custkey % 9) "
        "WHEN 3 THEN concat('gsc_', 100 * c_nationkey, '_heur_', c_custkey % 9) "
        "WHEN 4 THEN concat('atx_', 100 * c_nationkey, '_jar') ELSE concat('x', c_custkey) END AS folder",
    )


def _model_files(t: DriverTables) -> DataFrame:
    """Scenario, fleet and pooling JSON text per case (customer): case_name, file_name, content."""
    q = "concat('case_', c_custkey) AS case_name"
    c = t.raw("customer")
    scenario = (
        "concat('{\"Population synthesizer controls\": {\"traffic_scale_factor\": ', "
        "CASE c_custkey % 4 WHEN 0 THEN '0.25' WHEN 1 THEN '0.5' WHEN 2 THEN '1.0' ELSE '0.0' END, "
        "'}, \"General simulation controls\": {\"database_name\": \"city', c_nationkey, "
        "'\"}, \"Scenario controls\": {\"rideshare_cost_per_minute\": 0.', 1 + c_custkey % 8, "
        "', \"rideshare_cost_per_mile\": 1.', c_custkey % 10, ', \"rideshare_base_fare\": ', 2 + c_custkey % 7, '}}')"
    )
    fleet = (
        "concat('{\"Operator_1\": {\"Fleet_Base\": {', "
        "CASE WHEN c_custkey % 2 = 0 THEN '\"Operator_1_TNC_FLEET_SIZE\": ' ELSE '\"TNC_FLEET_SIZE\": ' END, "
        "100 + c_custkey % 900, '}', CASE WHEN c_custkey % 5 = 0 THEN '' ELSE concat(', \"strategy_name\": \"S', "
        "c_custkey % 3, '\"') END, '}, \"S0\": {\"assignment_strategy\": \"default\", \"reposition_strategy\": \"none\"}, "
        "\"S1\": {\"assignment_strategy\": \"auction\", \"reposition_strategy\": \"zone\"}, \"S2\": {\"assignment_strategy\": "
        "\"default\"}, \"DRS_Discount_AR\": {\"repositioning_batched_interval_seconds\": ', "
        "CASE WHEN c_custkey % 3 = 0 THEN 'null' ELSE CAST(300 * (1 + c_custkey % 4) AS STRING) END, '}}')"
    )
    pooling = "concat('{\"TNC_Pooling_Model\": {\"CU_DEFAULT_POOLING_DISCOUNT\": 0.', 1 + c_custkey % 9, '}}')"
    parts = [
        c.where("c_custkey % 3 <> 0").selectExpr(q, "'scenario_abm.modified.json' AS file_name", f"{scenario} AS content"),
        c.where("c_custkey % 7 <> 0").selectExpr(
            q, "'scenario_abm_trajectories.modified.json' AS file_name",
            f"replace({scenario}, 'city', 'town') AS content"),
        c.selectExpr(q, "'SAEVFleetModel_optimization.json' AS file_name", f"{fleet} AS content"),
        c.where("c_custkey % 11 <> 0").selectExpr(q, "'PoolingModel.json' AS file_name", f"{pooling} AS content"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_VIEWS: dict[str, Callable[[DriverTables], DataFrame]] = {
    "case_params": _case_params, "location": _location, "zone": _zone, "household": _household, "person": _person,
    "trip": _trip, "activity": _activity, "tnc_request": _tnc_request, "tnc_trip": _tnc_trip,
    "tnc_statistics": _tnc_statistics, "transit_vehicle_links": _transit_vehicle_links,
    "transit_trips": _transit_trips, "transit_patterns": _transit_patterns, "transit_stops": _transit_stops,
    "skim": _skim, "run_dirs": _run_dirs, "case_labels": _case_labels, "model_files": _model_files,
}
