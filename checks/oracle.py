"""Oracle SQL (DuckDB dialect) for every query, written per case from the report definitions.

``statements()`` prefixes each text with the views and reports it names and rounds its floating columns.
"""

from __future__ import annotations

import re

from checks.views import VIEWS

M = "1609.34::DOUBLE"
AGE = "CASE WHEN {a} > 60 THEN 2 WHEN {a} < 18 THEN 0 ELSE 1 END"


def _bands(column: str, edges: list[float]) -> str:
    arms = [
        f"WHEN {column} >= {lo} AND {column} < {hi} THEN {i}" if hi is not None else f"WHEN {column} >= {lo} THEN {i}"
        for i, (lo, hi) in enumerate(zip(edges, [*edges[1:], None]))
    ]
    return "CASE " + " ".join(arms) + " ELSE 999 END"


INC_LVL = _bands("d.income", [*range(0, 150000, 10000), 150000, 175000, 200000, 225000, 250000, 300000, 350000, 400000, 450000])
AGE_LVL = _bands("c.age", [0, 12, 16, 18, 22, 25, 30, 35, 40, 45, 50, 60, 70])


def _quartile(x: str) -> str:
    return (f"CASE WHEN {x} > 95340 THEN '4- >75%' WHEN {x} > 51906 THEN '3- between 50% and 75%' "
            f"WHEN {x} > 26339 THEN '2- between 25% and 50%' ELSE '1- <25%' END")


def _cased(src: str) -> str:
    """A report with the case columns of the city_size_strategy_iteration scheme."""
    third, weight = "string_split(s.folder,'_')[3]", "TRY_CAST(string_split(s.folder,'_')[3] AS DOUBLE)"
    raw = f"CASE WHEN {weight} IS NULL THEN coalesce({third}, 'jar') ELSE 'jar' END"
    wtext = f"coalesce(CAST({weight} AS VARCHAR), '0')"
    return (
        f"(SELECT s.*, string_split(s.folder,'_')[1] AS \"City\", string_split(s.folder,'_')[2] AS \"Fleet Size\", "
        f"CASE WHEN len(string_split(s.folder,'_')) >= 4 THEN array_to_string(string_split(s.folder,'_')[4:], '_') END AS \"Iteration\", "
        f"{raw} AS \"Strat_Raw\", {wtext} AS \"Repo_Weight\", {raw} || '_' || {wtext} AS \"Strategy\" FROM {src} s)"
    )


R: dict[str, str] = {}  # named reports; registered queries and helpers alike

# ---- helpers ---------------------------------------------------------------------------------------------
R["h_trips"] = """
SELECT a.*, b.service_type, b.origin_zone, b.destination_zone, CASE WHEN b.service_type = 99 THEN 0 ELSE a.passengers END AS eff
FROM tnc_trip a LEFT JOIN tnc_request b ON a.folder = b.folder AND a.request = b.tnc_request_id"""
R["h_people"] = """
SELECT c.*, d.household AS hh_id, d.location AS home, d.income AS hh_income, d.vehicles, d.persons, d.workers, e.zone, e.x, e.y
FROM person c LEFT JOIN household d ON c.folder = d.folder AND c.household = d.household
LEFT JOIN location e ON d.folder = e.folder AND d.location = e.location"""
R["h_adult"] = """
SELECT t.*, p.age, p.work_location_id AS work, p.home, p.zone, d.trip_multiplier AS m FROM trip t
JOIN h_people p ON t.folder = p.folder AND t.person = p.person JOIN case_dim d ON t.folder = d.folder
WHERE p.hh_id IS NOT NULL AND t.end_s - t.start_s > 2"""

# ---- sources and catalogue ---------------------------------------------------------------------------------
_LATEST = """
SELECT case_name, n AS iteration, dir_name FROM (
 SELECT case_name, dir_name, finished, CASE WHEN regexp_matches(dir_name, '^(.*)_iteration_([0-9]+)?$')
  THEN coalesce(TRY_CAST(regexp_extract(dir_name, '_iteration_([0-9]+)$', 1) AS BIGINT), -1)
  WHEN contains(dir_name, 'abm_init_iteration') THEN 0 END AS n FROM run_dirs)
WHERE n IS NOT NULL {finished} QUALIFY row_number() OVER (PARTITION BY case_name ORDER BY n DESC, dir_name DESC) = 1"""
R["latest_iteration"] = _LATEST.format(finished="AND finished")
R["case_folders"] = "SELECT case_name, dir_name, case_name || '_' || CAST(iteration AS VARCHAR) AS folder FROM latest_iteration"
R["latest_iteration_any"] = _LATEST.format(finished="")
R["missing_cases"] = """
SELECT DISTINCT case_name FROM run_dirs WHERE case_name NOT IN (SELECT case_name FROM latest_iteration)"""
R["pending_cases"] = """
SELECT 'case_' || c_custkey AS folder FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')"""
R["h_scenario"] = """
SELECT case_name, content FROM model_files WHERE file_name LIKE 'scenario%'
QUALIFY row_number() OVER (PARTITION BY case_name ORDER BY CASE file_name WHEN 'scenario_abm.modified.json' THEN 1 ELSE 2 END) = 1"""
R["h_fleet"] = "SELECT case_name, content FROM model_files WHERE file_name = 'SAEVFleetModel_optimization.json'"
R["case_params"] = """
SELECT s.case_name, 1.0 / nullif(CAST(json_extract_string(s.content, '$."Population synthesizer controls".traffic_scale_factor') AS DOUBLE), 0) AS trip_multiplier,
 CAST(coalesce(json_extract_string(f.content, '$.Operator_1.Fleet_Base.Operator_1_TNC_FLEET_SIZE'),
  json_extract_string(f.content, '$.Operator_1.Fleet_Base.TNC_FLEET_SIZE')) AS BIGINT) AS fleet_size,
 json_extract_string(s.content, '$."General simulation controls".database_name') AS database_name
FROM h_scenario s LEFT JOIN h_fleet f ON s.case_name = f.case_name"""
R["pricing_params"] = """
SELECT case_name, CAST(json_extract_string(content, '$."Scenario controls".rideshare_cost_per_minute') AS DOUBLE) AS per_minute,
 CAST(json_extract_string(content, '$."Scenario controls".rideshare_cost_per_mile') AS DOUBLE) AS per_mile,
 CAST(json_extract_string(content, '$."Scenario controls".rideshare_base_fare') AS DOUBLE) AS base_fare FROM h_scenario"""
R["strategy_params"] = """
SELECT case_name, s AS strategy_name, CASE s WHEN 'S1' THEN 'auction' ELSE 'default' END AS assignment_strategy,
 CASE s WHEN 'S0' THEN 'none' WHEN 'S1' THEN 'zone' END AS repositioning_strategy
FROM (SELECT case_name, json_extract_string(content, '$.Operator_1.strategy_name') AS s FROM h_fleet)"""
R["pooling_discount"] = """
SELECT case_name, CAST(json_extract_string(content, '$.TNC_Pooling_Model.CU_DEFAULT_POOLING_DISCOUNT') AS DOUBLE) AS pooling_discount
FROM model_files WHERE file_name = 'PoolingModel.json'"""
R["repositioning_interval"] = """
SELECT case_name, coalesce(CAST(json_extract_string(content, '$.DRS_Discount_AR.repositioning_batched_interval_seconds') AS BIGINT), 900) AS interval_s
FROM h_fleet"""
R["config_audit"] = """
SELECT case_name, file_name, 'Operator_1_TNC_FLEET_SIZE' AS key,
 json_extract_string(content, '$.Operator_1.Fleet_Base.Operator_1_TNC_FLEET_SIZE') AS value
FROM model_files WHERE file_name = 'SAEVFleetModel_optimization.json'"""
R["config_differences"] = """
WITH leaves AS (SELECT m.file_name, t.fullkey AS path, t.atom ->> '$' AS value FROM model_files m, json_tree(m.content) t WHERE t.type NOT IN ('OBJECT', 'ARRAY')),
 v AS (SELECT file_name, path, value, count(*) AS n FROM leaves GROUP BY ALL),
 p AS (SELECT file_name, path, sum(n)::BIGINT AS n_cases, count(*) AS n_values, min(value) AS first_value, max(value) AS last_value FROM v GROUP BY ALL)
SELECT p.file_name, path, n_cases, n_files - n_cases AS n_missing, n_values, first_value, last_value
FROM p JOIN (SELECT file_name, count(*) AS n_files FROM model_files GROUP BY 1) f ON p.file_name = f.file_name WHERE n_values > 1 OR n_files > n_cases"""
R["skim_periods"] = """
SELECT folder, CAST(row_number() OVER (PARTITION BY folder ORDER BY period) - 1 AS INTEGER) AS position, period
FROM (SELECT DISTINCT folder, period FROM skim)"""
R["mode_names"] = """
SELECT folder, mode, CASE mode WHEN 0 THEN 'SOV' WHEN 1 THEN 'AUTO_NEST' WHEN 2 THEN 'HOV' WHEN 3 THEN 'TRUCK' WHEN 4 THEN 'BUS'
 WHEN 5 THEN 'RAIL' WHEN 6 THEN 'NONMOTORIZED_NEST' WHEN 7 THEN 'BICYCLE' WHEN 8 THEN 'WALK' WHEN 9 THEN 'TAXI' END AS mode_name,
 count(*) AS trips FROM trip GROUP BY folder, mode"""
# fixed values: the published mode codes and names
R["mode_names_all"] = """
WITH names(code, name) AS (VALUES
 (0, 'SOV'), (1, 'AUTO_NEST'), (2, 'HOV'), (3, 'TRUCK'), (4, 'BUS'), (5, 'RAIL'), (6, 'NONMOTORIZED_NEST'), (7, 'BICYCLE'), (8, 'WALK'), (9, 'TAXI'), 
 (10, 'SCHOOLBUS'), (11, 'PARK_AND_RIDE'), (12, 'KISS_AND_RIDE'), (13, 'PARK_AND_RAIL'), (14, 'KISS_AND_RAIL'), (15, 'TNC_AND_RIDE'), (17, 'MD_TRUCK'), 
 (18, 'HD_TRUCK'), (19, 'BPLATE'), (20, 'LD_TRUCK'), (21, 'RAIL_NEST'), (22, 'BUS40'), (23, 'BUS60'), (24, 'PNR_BIKE_NEST'), (25, 'RIDE_AND_UNPARK'), 
 (26, 'RIDE_AND_REKISS'), (27, 'RAIL_AND_UNPARK'), (28, 'RAIL_AND_REKISS'), (29, 'MICROM'), (30, 'MICROM_NODOCK'), (31, 'MICROM_AND_TRANSIT'), 
 (32, 'MICROM_NODOCK_AND_TRANSIT'), (33, 'ODDELIVERY'), (34, 'DUMMY REPOSITIONING'), (999, 'FAIL_MODE'), (1000, 'FAIL_ROUTE'), (1001, 'FAIL_REROUTE'), 
 (1002, 'FAIL_UNPARK'), (1003, 'FAIL_UNPARK2'), (1004, 'FAIL_MODE1'), (1005, 'FAIL_MODE2'), (1006, 'FAIL_MODE3'), (1007, 'FAIL_ROUTE_ACTIVE'), 
 (1008, 'FAIL_ROUTE_WALK_AND_TRANSI'), (1009, 'FAIL_ROUTE_DRIVE_TO_TRANSI'), (1010, 'FAIL_ROUTE_DRIVE_FROM_TRAN'), 
 (1011, 'FAIL_ROUTE_TNC_AND_TRANSIT'), (1012, 'FAIL_ROUTE_TNC'), (1013, 'FAIL_ROUTE_SOV'), (1014, 'FAIL_ROUTE_MICROMOBILITY'), (1015, 'NO_MOVE'), 
 (9999, 'UNSIMULATED')),
 c AS (SELECT CASE o_orderkey % 5 WHEN 0 THEN o_orderkey % 43 WHEN 4 THEN 9990 + o_orderkey % 13 ELSE 990 + o_orderkey % 37 END AS code, count(*) AS n
  FROM orders GROUP BY 1)
SELECT c.code, name AS mode_name, n FROM c LEFT JOIN names ON names.code = c.code"""
R["zone_master"] = """SELECT DISTINCT split_part(folder, '_', 1) AS "City", CAST(z.zone AS VARCHAR) AS zone FROM zone z"""
R["parse_case_name_a"] = """
SELECT case_id, folder, p[1] AS "City", CASE WHEN len(p) >= 3 THEN array_to_string(p[3:], '_') END AS "Iteration",
 CASE WHEN p[2] = 'heur' THEN 'Heuristic' ELSE 'Proactive' END AS "Strategy", CASE WHEN p[2] = 'heur' THEN 'N/A' ELSE p[2] END AS "WTP_Type"
FROM (SELECT *, string_split(folder, '_') AS p FROM case_labels)"""
R["parse_case_name_b"] = f"SELECT * FROM {_cased('case_labels')}"
R["parse_case_name_c"] = """
SELECT case_id, folder, p[1] AS "City", p[2] AS "Fleet Size", CASE WHEN p[3] = 'heur' THEN 'Heuristic' ELSE 'Proactive' END AS "Strategy",
 CASE WHEN len(p) >= 4 THEN array_to_string(p[4:], '_') ELSE p[3] END AS "Iteration"
FROM (SELECT *, string_split(folder, '_') AS p FROM case_labels)"""

# ---- operators -----------------------------------------------------------------------------------------------
R["h_nearest"] = """
SELECT l.folder, l.location, s.stop_id, sqrt((l.x-s.x)*(l.x-s.x) + (l.y-s.y)*(l.y-s.y)) AS distance
FROM location l JOIN transit_stops s ON l.folder = s.folder
QUALIFY row_number() OVER (PARTITION BY l.folder, l.location ORDER BY (l.x-s.x)*(l.x-s.x) + (l.y-s.y)*(l.y-s.y), s.stop_id) = 1"""
R["nearest_stop"] = "SELECT * FROM h_nearest"
_PERIOD = "list_min(list_filter([360,600,900,1140,1440], lambda p: p >= r.request_time / 60.0))"
R["skim_lookup"] = f"""
SELECT q.folder, q.tnc_request_id, q.origin_zone, q.destination_zone, q.skim_period, s.time_min AS skim_time, s.dist_m / {M} AS skim_dist
FROM (SELECT r.*, {_PERIOD} AS skim_period FROM tnc_request r) q LEFT JOIN skim s ON q.folder = s.folder AND q.skim_period = s.period
 AND q.origin_zone = s.origin_zone AND q.destination_zone = s.destination_zone"""
R["h_typed"] = "SELECT folder, max(CASE WHEN service_type = 99 THEN 1 ELSE 0 END) = 1 AS typed FROM h_trips WHERE vehicle IS NOT NULL AND tour IS NOT NULL GROUP BY folder"
R["h_probe"] = """
SELECT t.*, CASE WHEN y.typed THEN coalesce(t.service_type = 99 AND t.init_status = -2, false) ELSE coalesce(t.init_status = -3, false) END AS probe,
 CASE WHEN y.typed THEN t.service_type IS DISTINCT FROM 99 ELSE t.init_status IS DISTINCT FROM -3 END AS service
FROM h_trips t JOIN h_typed y ON t.folder = y.folder WHERE t.vehicle IS NOT NULL AND t.tour IS NOT NULL"""
R["next_service_trip"] = """
SELECT a.folder, a.vehicle, a.tnc_trip_id_int, a.start_s, CAST(floor(a.start_s/3600) AS INTEGER) AS hour, a.destination_zone,
 b.tnc_trip_id_int AS next_trip, b.origin_zone AS next_origin_zone
FROM (SELECT * FROM h_probe WHERE probe) a LEFT JOIN (SELECT * FROM h_probe WHERE service) b ON a.folder = b.folder AND a.vehicle = b.vehicle
 AND b.start_s > a.start_s AND b.start_s <= a.start_s + 3600
QUALIFY row_number() OVER (PARTITION BY a.folder, a.tnc_trip_id_int ORDER BY b.start_s, b.tnc_trip_id_int) = 1"""
R["h_sub"] = """
SELECT *, sum(CASE WHEN passengers = 0 AND rn > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY folder, vehicle, tour ORDER BY start_s, tnc_trip_id_int
 ROWS UNBOUNDED PRECEDING)::BIGINT AS sub_tour FROM (SELECT *, row_number() OVER (PARTITION BY folder, vehicle, tour ORDER BY start_s, tnc_trip_id_int) AS rn
 FROM h_trips WHERE vehicle IS NOT NULL AND tour IS NOT NULL)"""
R["sub_tours"] = "SELECT folder, tnc_trip_id_int, vehicle, tour, sub_tour FROM h_sub"
R["tour_requests"] = "SELECT folder, vehicle, tour, sub_tour, start_s, tnc_trip_id_int, request FROM h_sub"
R["describe_long"] = " UNION ALL ".join(
    f"SELECT folder, service_type, '{m}' AS \"Metric\", coalesce(sum({v}), 0)::DOUBLE AS \"Sum\", avg({v})::DOUBLE AS \"Mean\", stddev_samp({v}) AS \"StdDev\","
    f" count({v})::DOUBLE AS \"SampleSize\" FROM tnc_request GROUP BY folder, service_type"
    for m, v in ((m, f"CASE WHEN assigned_vehicle IS NOT NULL THEN ({e})::DOUBLE END") for m, e in
                 (("wait", "pickup_time - request_time"), ("fare", "fare"), ("party_size", "party_size")))
) + " UNION ALL SELECT folder, service_type, 'rows', count(*)::DOUBLE, NULL, NULL, NULL FROM tnc_request GROUP BY folder, service_type"
R["describe_merged"] = " UNION ALL ".join(
    f"SELECT folder, service_type, '{m}' AS \"Metric\", coalesce(sum({v}), 0)::DOUBLE AS \"Sum\", avg({v})::DOUBLE AS \"Mean\", stddev_samp({v}) AS \"StdDev\","
    f" count({v})::DOUBLE AS \"SampleSize\" FROM tnc_request GROUP BY folder, service_type"
    for m, v in ((m, f"CASE WHEN assigned_vehicle IS NOT NULL THEN ({e})::DOUBLE END") for m, e in
                 (("wait", "pickup_time - request_time"), ("fare", "fare"), ("party_size", "party_size"))))
_BIN = "CASE WHEN {v} > 5 THEN '5.0+' ELSE CAST(CAST(round_even({v}*10, 0) AS BIGINT)//10 AS VARCHAR) || '.' || CAST(CAST(round_even({v}*10, 0) AS BIGINT)%10 AS VARCHAR) END"


def _histogram(src: str, keys: str, value: str) -> str:
    """Counts per 0.1 bin with an overflow bin, joined onto a zero grid."""
    return f"""
WITH b AS (SELECT {keys}, {_BIN.format(v=value)} AS bin FROM {src} WHERE {value} IS NOT NULL),
 grid AS (SELECT k.*, CAST(i//10 AS VARCHAR) || '.' || CAST(i%10 AS VARCHAR) AS bin FROM (SELECT DISTINCT {keys} FROM b) k, range(0, 51) g(i)),
 allbins AS (SELECT {keys}, bin, 0 AS n FROM grid UNION ALL SELECT {keys}, bin, 1 FROM b)
SELECT {keys}, bin AS {value}, sum(n)::BIGINT AS "Count" FROM allbins GROUP BY {keys}, bin"""


R["capped_histogram"] = _histogram("(SELECT folder, service_type, distance/5 AS distance FROM tnc_request)", "folder, service_type", "distance")
R["pivot_expected"] = "SELECT folder, type, " + ", ".join(
    f"coalesce(sum(CASE WHEN mode = '{m}' THEN duration END), 0)::DOUBLE AS \"{m}\"" for m in ("SOV", "BUS", "RAIL", "TAXI", "WALK", "HOVERCRAFT")
) + " FROM activity GROUP BY folder, type"
R["melt_pivot"] = " UNION ALL ".join(
    f"SELECT folder, init_status, '{n}' AS \"Attribute\", {e}::DOUBLE AS \"Value\" FROM tnc_trip GROUP BY folder, init_status"
    for n, e in (("metres", "sum(travel_distance)"), ("routed", "sum(routed_travel_time)"), ("legs", "count(passengers)")))
R["baseline_shift"] = f"""
WITH s AS (SELECT * FROM {_cased('(SELECT folder, sum(travel_distance) AS metres, count(*) AS trips FROM trip GROUP BY folder)')})
SELECT a.folder, a."City", a."Fleet Size", a."Strategy", (a.metres - b.metres) / nullif(b.metres, 0) AS "metres shift",
 (a.trips - b.trips) / nullif(b.trips, 0)::DOUBLE AS "trips shift"
FROM (SELECT * FROM s WHERE "Strategy" <> 'nr_0') a LEFT JOIN (SELECT * FROM s WHERE "Strategy" = 'nr_0') b
 ON a."City" = b."City" AND a."Fleet Size" = b."Fleet Size" """


def _p_value(t: str, df: str) -> str:
    """Two-sided Student p-value: the tail of cos(u)^(df - 1) from atan(t / sqrt(df)), by Simpson's rule on 1001 nodes over the
    nine standard widths (or up to pi / 2) that hold all of it. The cost is the same for every df."""
    n = f"CAST({df} AS DOUBLE)"
    th = f"atan(abs({t}) / sqrt({n}))"
    step = f"((least(pi() / 2, {th} + 9 / sqrt({n})) - {th}) / 1000)"
    weight = "(CASE WHEN k IN (0, 1000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END)"
    total = f"list_sum(list_transform(range(0, 1001), lambda k: {weight} * pow(greatest(cos({th} + k * {step}), 0.0::DOUBLE), {n} - 1)))"
    scale = f"2 * exp(lgamma(({n} + 1) / 2) - lgamma({n} / 2) - 0.5 * ln(pi()))"
    return f"CASE WHEN {t} IS NOT NULL THEN least({scale} * {step} / 3 * {total}, 1.0) END"


_SP = "((n1-1)*s1*s1 + (n2-1)*s2*s2) / nullif(n1+n2-2, 0)"
_T = f"(m1 - m2) / nullif(sqrt({_SP} * (1.0/n1 + 1.0/n2)), 0)"
R["ttest_from_stats"] = f"""
WITH s AS (SELECT c_nationkey, o_orderstatus, avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS sd, count(*)::DOUBLE AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
 p AS (SELECT a.c_nationkey, a.o_orderstatus, b.m AS m1, b.sd AS s1, b.n AS n1, a.m AS m2, a.sd AS s2, a.n AS n2
  FROM s a JOIN s b ON a.c_nationkey = b.c_nationkey AND b.o_orderstatus = 'F' WHERE a.o_orderstatus <> 'F'),
 t AS (SELECT c_nationkey, o_orderstatus, {_T} AS t_statistic, n1 + n2 - 2 AS df FROM p)
SELECT *, {_p_value('t_statistic', 'df')} AS p_value FROM t"""
_FIXABLE = "NOT (regexp_replace(folder, '_[^_]*$', '') LIKE '%dr' OR regexp_replace(folder, '_[^_]*$', '') LIKE '%nr')"
R["h_fixed_trips"] = f"""
SELECT * REPLACE (CASE WHEN {_FIXABLE} AND service_type = 99 THEN 0 ELSE passengers END AS passengers) FROM h_trips"""
R["conditional_update"] = "SELECT folder, tnc_trip_id_int, request, vehicle, passengers FROM h_fixed_trips"
R["conditional_update_requests"] = f"""
SELECT folder, tnc_request_id, service_type, CASE WHEN {_FIXABLE} AND service_type = 99 THEN 0 ELSE party_size END AS party_size FROM tnc_request"""
_GUARD = """
SELECT '{label}' AS tables, folder, max_party, max_pass, {fixable} AS repaired,
 NOT {fixable} OR (coalesce(max_party, 0) <= 0 AND coalesce(max_pass, 0) <= 0) AS ok
FROM (SELECT folder, max(CASE WHEN service_type = 99 THEN party_size END) AS max_party FROM {requests} GROUP BY folder)
LEFT JOIN (SELECT folder, max(passengers) AS max_pass FROM {trips} WHERE service_type = 99 GROUP BY folder) USING (folder)"""
R["dq_guard"] = (
    _GUARD.format(label="raw", fixable=_FIXABLE, requests="tnc_request", trips="h_trips") + " UNION ALL "
    + _GUARD.format(label="repaired", fixable=_FIXABLE, requests="conditional_update_requests", trips="h_fixed_trips"))

# ---- per-case SQL reports --------------------------------------------------------------------------------------
R["transit_trip_max_load_helper"] = """
SELECT a.folder, min(a.object_id) AS trip_id, min(b.pattern_id) AS pattern_id, min(c.route_id) AS route_id,
 max(a.value_seated_load * d.trip_multiplier + a.value_standing_load * d.trip_multiplier) AS max_load,
 sum((a.value_seated_load * d.trip_multiplier + a.value_standing_load * d.trip_multiplier) * a.value_length) / nullif(sum(a.value_length), 0) AS "AVO",
 sum(a.value_length) AS trip_length
FROM transit_vehicle_links a JOIN case_dim d ON a.folder = d.folder LEFT JOIN transit_trips b ON a.folder = b.folder AND a.object_id = b.trip_id
LEFT JOIN transit_patterns c ON b.folder = c.folder AND b.pattern_id = c.pattern_id GROUP BY a.folder, b.trip_id"""
R["transit_trip_max_load"] = """
SELECT d.folder, (SELECT count(*) FROM transit_trip_max_load_helper h WHERE h.folder = d.folder AND max_load = 0) AS empty_trips,
 (SELECT count(*) FROM (SELECT h.folder, route_id, max(max_load) AS ml FROM transit_trip_max_load_helper h GROUP BY h.folder, route_id) x
  WHERE x.folder = d.folder AND ml <= 4) AS tnc_replaceable_routes FROM case_dim d"""
_COUNTS = """m * sum(CASE WHEN destination = work THEN 1 ELSE 0 END) AS "HBW",
 m * sum(CASE WHEN origin = home AND destination <> work THEN 1 ELSE 0 END) AS "HBO",
 m * sum(CASE WHEN origin <> home AND destination <> home AND destination <> work THEN 1 ELSE 0 END) AS "NHB", m * count(*) AS total"""
_REAL = "(has_artificial_trip = 0 OR mode IN (7, 8))"
R["mode_Distribution_ADULT_Counts"] = f"""
SELECT folder, mode, {AGE.format(a='age')} AS age_class, {_COUNTS} FROM h_adult WHERE {_REAL} GROUP BY folder, mode, 3, m"""
R["mode_Distribution_ADULT_Distance"] = f"""
SELECT folder, mode, {AGE.format(a='age')} AS age_class,
 m * sum(travel_distance / {M} * CAST(origin <> home AND destination <> home AND destination <> work AS INTEGER)) AS "NHB",
 m * sum(travel_distance / {M} * CAST(destination = work AS INTEGER)) AS "HBW",
 m * sum(travel_distance / {M} * CAST(origin = home AND destination <> work AS INTEGER)) AS "HBO", m * sum(travel_distance / {M}) AS total
FROM h_adult WHERE {_REAL} GROUP BY folder, mode, 3, m"""
R["mode_Distribution_ADULT"] = f"SELECT folder, mode, zone, {_COUNTS} FROM h_adult WHERE age > 16 GROUP BY folder, mode, zone, m"
_LOAD = "((value_seated_load + value_standing_load) * trip_multiplier)"
R["bus_avo"] = f"""
SELECT folder, sum(value_length * {_LOAD}) / nullif(sum(value_length), 0) AS mileage_avo, sum(value_seated_load + value_standing_load) / (count(*) * 1.0::DOUBLE) AS trip_avo,
""" + ", ".join(
    f"count(CASE WHEN {c} THEN 1 END) AS cnt_{n}, sum(CASE WHEN {c} THEN value_length / {M} END) AS dist_{n}"
    for n, c in (("mass", f"{_LOAD} > 4"), ("pool", f"{_LOAD} > 1 AND {_LOAD} <= 4"), ("solo", f"{_LOAD} = 1"), ("empt", f"{_LOAD} < 1"))
) + " FROM transit_vehicle_links JOIN case_dim USING (folder) GROUP BY folder"
R["pr_avo"] = "SELECT d.folder, " + ", ".join(
    f"(SELECT count(*) FROM h_trips t WHERE t.folder = d.folder AND eff {c}) * d.trip_multiplier AS cnt_{n}, "
    f"(SELECT sum(travel_distance / {M}) FROM h_trips t WHERE t.folder = d.folder AND eff {c}) * d.trip_multiplier AS dist_{n}"
    for n, c in (("pool", "> 1"), ("solo", "= 1"), ("empt", "< 1"))
) + " FROM case_dim d"
R["fare_sensitivity_results"] = f"""
WITH fleet AS (SELECT folder, count(*) AS vehicles, avg(tot_dropoffs) AS avg_trips FROM tnc_statistics GROUP BY folder),
 asked AS (
  SELECT folder, count(*) AS all_requests, count(*) FILTER (is_served) AS served, avg(pickup_time - request_time) FILTER (is_served) AS wait_s,
   avg(dropoff_time - request_time) FILTER (is_served) AS ride_s, count(*) FILTER (has_vehicle AND is_empty_move) AS empty_moves,
   count(DISTINCT tnc_request_id) FILTER (NOT has_vehicle AND NOT is_empty_move) AS refused
  FROM (SELECT *, has_vehicle AND NOT is_empty_move AS is_served
        FROM (SELECT *, assigned_vehicle IS NOT NULL AS has_vehicle, service_type = 99 AS is_empty_move FROM tnc_request)) GROUP BY folder),
 driven AS (
  SELECT folder, sum(travel_distance) AS metres, sum(travel_distance) FILTER (eff = 0) AS empty_metres, sum(end_s - start_s) AS seconds,
   sum(travel_distance * eff) AS person_metres, sum(travel_distance * eff) FILTER (eff > 0) AS carried_metres,
   sum(travel_distance) FILTER (eff > 0) AS metres_with_people, sum(eff) AS people, sum(eff) FILTER (passengers > 0) AS people_noted,
   count(DISTINCT request) AS requests_driven FROM h_trips GROUP BY folder),
 cars AS (SELECT folder, sum(travel_distance) AS car_metres, sum(end_s - start_s) AS car_seconds FROM trip WHERE mode = 0 GROUP BY folder),
 wide AS (
  SELECT *, trip_multiplier AS k FROM case_dim LEFT JOIN fleet USING (folder) LEFT JOIN asked USING (folder) LEFT JOIN driven USING (folder)
   LEFT JOIN cars USING (folder))
SELECT folder, k * coalesce(vehicles, 0) AS fleet_size, avg_trips, wait_s / 60 AS wait_min, ride_s / 60 AS ttime_min,
 k * coalesce(served, 0) AS requests_served, k * coalesce(empty_moves, 0) AS repo_requests_served, k * coalesce(refused, 0) AS unserved_requests,
 k * empty_metres / {M} AS evmt, k * metres / {M} AS sav_vmt, k * seconds / 3600 AS sav_vht, k * car_metres / {M} AS sov_vmt,
 k * car_seconds / 3600 AS sov_vht, person_metres::DOUBLE / nullif(metres, 0) AS "AVO", carried_metres::DOUBLE / nullif(metres_with_people, 0) AS "rAVO",
 people::DOUBLE / nullif(all_requests, 0) AS trip_avo, people_noted::DOUBLE / nullif(requests_driven, 0) AS trip_ravo,
 empty_metres::DOUBLE / nullif(metres, 0) AS perc_evmt, metres / {M} / nullif(served, 0) AS vmt_per_r, seconds / 60 / nullif(served, 0) AS vht_per_r
FROM wide"""
R["distance_tnc_dist"] = """
SELECT folder, CAST(trunc(distance * 2) AS BIGINT) // 2 AS binned_dist, count(*) * trip_multiplier AS num_trips, min(service_type) AS service_type
FROM tnc_request JOIN case_dim USING (folder) WHERE assigned_vehicle IS NOT NULL GROUP BY folder, 2, trip_multiplier"""
R["fare_sensitivity_results_zonal"] = """
WITH q AS (SELECT r.*, z.zone AS z, z.area_type, d.trip_multiplier AS m FROM tnc_request r JOIN case_dim d ON r.folder = d.folder
  LEFT JOIN location l ON r.folder = l.folder AND r.origin_location = l.location LEFT JOIN zone z ON l.folder = z.folder AND l.zone = z.zone WHERE service_type <> 99),
 a AS (SELECT folder, z, min(area_type) AS area_type, avg(pickup_time - request_time)/60 AS wait_min, avg(dropoff_time - request_time)/60 AS ttime_min,
  count(*)*m AS requests_served, sum(fare) AS fare FROM q WHERE assigned_vehicle IS NOT NULL GROUP BY folder, z, m),
 b AS (SELECT folder, z, count(DISTINCT tnc_request_id)*m AS unserved_requests FROM q WHERE assigned_vehicle IS NULL GROUP BY folder, z, m)
SELECT a.folder, a.z AS zone, a.area_type, a.wait_min, a.ttime_min, a.requests_served, b.unserved_requests, a.fare
FROM a LEFT JOIN b ON a.folder = b.folder AND a.z = b.z"""
R["fare_sensitivity_demograpic_tnc_stats"] = f"""
SELECT r.folder, count(*) * m.trip_multiplier AS "REQUESTS", avg(r.fare) AS "AVG_FARE", avg(r.distance)/{M} AS "AVG_DIST",
 avg(r.pickup_time - r.request_time)/60 AS "AVG_WAIT_MIN", avg(r.dropoff_time - r.request_time)/60 AS "AVG_TTIME_MIN", avg(d.vehicles) AS "VO",
 e.zone AS "ZONE", d.persons AS "PERSONS", d.workers AS "WORKERS", c.education AS "EDUCATION", c.gender AS "GENDER", c.race AS "RACE",
 {INC_LVL} AS "INC_LVL", {AGE_LVL} AS "AGE_LVL"
FROM tnc_request r JOIN case_dim m ON r.folder = m.folder LEFT JOIN person c ON r.folder = c.folder AND r.person = c.person
LEFT JOIN household d ON c.folder = d.folder AND c.household = d.household LEFT JOIN location e ON d.folder = e.folder AND d.location = e.location
WHERE r.assigned_vehicle IS NOT NULL AND r.service_type <> 99
GROUP BY r.folder, m.trip_multiplier, e.zone, d.persons, d.workers, c.education, c.gender, c.race, {INC_LVL}, {AGE_LVL}"""
R["fare_sensitivity_results_vo"] = f"""
SELECT c.folder, avg(d.vehicles) AS vo, count(d.household) AS households, d.persons AS "PERSONS", d.workers AS "WORKERS", c.education AS "EDUCATION",
 c.gender AS "GENDER", c.race AS "RACE", z.zone AS "ZONE", {INC_LVL} AS "INC_LVL", {AGE_LVL} AS "AGE_LVL", z.area_type
FROM person c LEFT JOIN household d ON c.folder = d.folder AND c.household = d.household LEFT JOIN location e ON d.folder = e.folder AND d.location = e.location
LEFT JOIN zone z ON e.folder = z.folder AND e.zone = z.zone
GROUP BY c.folder, d.persons, d.workers, c.education, c.gender, c.race, z.zone, z.area_type, {INC_LVL}, {AGE_LVL}"""
R["tnc_results_discount"] = """
WITH asked AS (
  SELECT folder, sum(fare) AS fares, sum(discount) FILTER (pooled_service = 1) AS reductions, count(*) FILTER (real) AS real_requests,
   avg(1 - pooled_service) FILTER (real) AS alone, avg(pooled_service) FILTER (real) AS shared,
   count(*) FILTER (NOT real AND assigned_vehicle IS NOT NULL) AS empty_moves, avg(CAST(assigned_vehicle IS NULL AS INTEGER)) FILTER (real) AS refused
  FROM (SELECT *, service_type <> 99 AS real FROM tnc_request) GROUP BY folder),
 driven AS (
  SELECT folder, avg(eff) AS mean_people, avg(passengers) FILTER (carrying) AS mean_carried, sum(travel_distance) AS metres,
   sum(travel_distance) FILTER (passengers = 0 OR service_type = 99) AS empty_metres, count(*) FILTER (service_type <> 99) AS real_moves,
   count(*) FILTER (carrying AND passengers > 1) AS shared_moves
  FROM (SELECT *, passengers > 0 AND service_type <> 99 AS carrying FROM h_trips) GROUP BY folder)
SELECT folder, alone AS solo_perc, shared AS pooled_perc, trip_multiplier * fares AS fare, mean_people AS "AVO", mean_carried AS "rAVO",
 metres / 1000 * 0.621371 AS vmt, empty_metres / nullif(metres, 0) AS evmt_perc, shared_moves::DOUBLE / nullif(real_moves, 0) AS pool_per,
 trip_multiplier * reductions AS pooled_discount, trip_multiplier * real_requests AS requests, trip_multiplier * empty_moves AS repo_requests,
 refused AS rejection_rate
FROM case_dim LEFT JOIN asked USING (folder) LEFT JOIN driven USING (folder)"""
R["elder_demo"] = f"""
SELECT a.folder, sum(p.vehicles)::BIGINT AS vehicles, p.zone, b.mode, b.type, {AGE.format(a='p.age')} AS age_class, count(a.trip_id) AS trip_count,
 count(p.hh_id) AS household_count, sum(a.travel_distance)/{M} AS total_travel_distance_miles, sum(a.end_s - a.start_s)/60 AS total_ttime_mins,
 sum(p.hh_income) AS hh_inc_total
FROM trip a LEFT JOIN activity b ON a.folder = b.folder AND a.trip_id = b.trip LEFT JOIN h_people p ON a.folder = p.folder AND a.person = p.person
WHERE a.has_artificial_trip = 0 GROUP BY a.folder, p.zone, b.mode, b.type, {AGE.format(a='p.age')}"""
R["tnc_stat_summary_helper"] = f"""
WITH s AS (SELECT folder, request, sum(CASE WHEN eff = 0 THEN travel_distance/{M} ELSE 0 END) AS evmt, sum(CASE WHEN eff > 0 THEN travel_distance/{M} ELSE 0 END) AS ovmt,
  sum(travel_distance/{M}) AS vmt, sum(eff) AS pax, count(tnc_trip_id_int) AS trips, max(eff) AS max_pass FROM h_trips GROUP BY folder, request)
SELECT a.folder, assigned_vehicle, tnc_request_id, (pickup_time - request_time)/60 AS wait_min, (dropoff_time - pickup_time)/60 AS ttime, discount AS discount_perc,
 discount*fare*m AS discount, fare*m AS fare, CASE WHEN max_pass - party_size > 0 THEN 1 ELSE 0 END AS pooled, evmt/nullif(vmt, 0) AS "eVMT_perc",
 ovmt*m AS "occupied_VMT", vmt*m AS "VMT", CASE WHEN service_type = 99 THEN 0 ELSE pax END::DOUBLE AS passengers, trips*m AS trips, pax/nullif(vmt, 0) AS "mileage_AVO",
 pax/nullif(ovmt, 0) AS "mileage_rAVO", pax::DOUBLE/nullif(trips, 0) AS "trip_AVO", pax::DOUBLE AS "trip_rAVO", pooled_service, vmt*0.5*m AS operating_cost,
 (fare - discount - vmt*0.5)*m AS revenue, service_type
FROM tnc_request a JOIN (SELECT folder, trip_multiplier AS m FROM case_dim) d ON a.folder = d.folder LEFT JOIN s ON a.folder = s.folder AND a.tnc_request_id = s.request"""
R["activity_times"] = """
SELECT a.folder, sum(a.duration) AS activity_duration, a.type AS activity_type, CASE WHEN p.age > 60 THEN 2 WHEN p.age > 18 THEN 1 ELSE 0 END AS age_class, p.zone
FROM activity a LEFT JOIN h_people p ON a.folder = p.folder AND a.person = p.person WHERE a.mode = 'NO_MOVE'
GROUP BY a.folder, a.type, CASE WHEN p.age > 60 THEN 2 WHEN p.age > 18 THEN 1 ELSE 0 END, p.zone"""

# ---- per-case post-processors ------------------------------------------------------------------------------------
R["household_rollup"] = """
SELECT folder, hh_id AS household, x, y, zone, min(workers) AS workers, min(vehicles) AS vehicles, count(CASE WHEN age > 60 THEN 1 END) AS people_over_60,
 count(CASE WHEN age <= 60 THEN 1 END) AS people_under_60, sum(income) AS income FROM h_people GROUP BY folder, hh_id, x, y, zone"""
R["closest_stops"] = f"""
SELECT h.folder, CASE WHEN n.distance / {M} / 2.1 * 60 > 8 THEN 0 ELSE 1 END AS walkable, h.vehicles, people_over_60 AS over_60, people_under_60 AS under_60, h.zone,
 count(*) AS "count", coalesce(sum(h.income), 0) AS total_income
FROM household_rollup h JOIN household d ON h.folder = d.folder AND h.household = d.household JOIN h_nearest n ON d.folder = n.folder AND d.location = n.location
WHERE h.vehicles IS NOT NULL AND h.zone IS NOT NULL GROUP BY h.folder, 2, h.vehicles, people_over_60, people_under_60, h.zone"""


def _priced(period: str) -> str:
    return f"""
SELECT x.*, CASE WHEN pooled_service = 1 THEN solo * (1 - discount_rate) ELSE solo END AS "corrected fare",
 CASE WHEN pooled_service = 1 THEN solo * discount_rate ELSE 0 END AS discount
FROM (SELECT q.folder, q.tnc_request_id AS request, q.person, q.request_time, q.origin_zone, q.destination_zone, q.pooled_service, s.time_min AS skim_time,
  s.dist_m / {M} AS skim_dist, s.time_min * p.per_minute + s.dist_m / {M} * p.per_mile + p.base_fare AS solo,
  CASE WHEN q.pooled_service = 1 THEN CASE WHEN p.assignment_strategy = 'default' THEN p.pooling_discount ELSE q.discount END ELSE 0 END AS discount_rate
 FROM (SELECT r.*, {period} AS skim_period FROM tnc_request r WHERE service_type <> 99) q JOIN h_params p ON q.folder = p.folder
 LEFT JOIN skim s ON q.folder = s.folder AND q.skim_period = s.period AND q.origin_zone = s.origin_zone AND q.destination_zone = s.destination_zone) x"""


R["h_params"] = VIEWS["case_params"]
R["h_priced"] = _priced(_PERIOD)
R["h_priced_last"] = _priced("1440")
R["requests"] = f"""
SELECT q.folder, q.request, q.request_time, q.discount, q.origin_zone, q.destination_zone, q.pooled_service, p.zone, p.vehicles, p.disability, p.race, p.marital_status,
 p.hh_income AS income, {AGE.format(a='p.age')} AS age_class, q.skim_time, q.skim_dist, q.solo AS solo_equiv_fare_skim, q.discount_rate, q."corrected fare"
FROM h_priced q LEFT JOIN h_people p ON q.folder = p.folder AND q.person = p.person"""


def _requests_sum(src: str) -> str:
    return f"""
SELECT q.folder, sum(solo)*m AS "total skim solo fare", sum("corrected fare")*m AS "total fare", sum(discount)*m AS "total discount",
 avg(discount_rate) AS "average discount percentage", sum("corrected fare")*m / nullif(fleet*m, 0) AS "revenue per vehicle",
 sum("corrected fare")*m / (count(*)*m) AS "revenue per request"
FROM {src} q JOIN (SELECT folder, trip_multiplier AS m FROM case_dim) d ON q.folder = d.folder
LEFT JOIN (SELECT folder, count(*) AS fleet FROM tnc_statistics GROUP BY folder) f ON q.folder = f.folder GROUP BY q.folder, m, fleet"""


R["requests_sum"] = _requests_sum("h_priced")
R["requests_last_period"] = _requests_sum("h_priced_last")
R["tnc_skim_demo"] = """
SELECT r.folder, r.zone, vehicles, disability, race, marital_status, income, age_class, coalesce(sum(solo_equiv_fare_skim), 0)*m AS "total skim solo fare",
 coalesce(sum("corrected fare"), 0)*m AS "total fare", coalesce(sum(discount), 0)*m AS "total discount", coalesce(sum(discount_rate), 0)*m AS "total discount percentage",
 count(request)*m AS request_count
FROM requests r JOIN (SELECT folder, trip_multiplier AS m FROM case_dim) d ON r.folder = d.folder
WHERE r.zone IS NOT NULL AND vehicles IS NOT NULL AND disability IS NOT NULL AND race IS NOT NULL AND marital_status IS NOT NULL AND income IS NOT NULL
GROUP BY r.folder, r.zone, vehicles, disability, race, marital_status, income, age_class, m"""
_METRICS = ["wait_min", "ttime", "discount", "fare", "pooled", "eVMT_perc", "occupied_VMT", "VMT", "mileage_AVO", "mileage_rAVO", "trip_AVO", "trip_rAVO",
            "operating_cost", "revenue"]
R["tnc_stat_summary"] = " UNION ALL ".join(
    f"SELECT folder, '{m}' AS \"Metric\", coalesce(sum(\"{m}\"), 0)::DOUBLE AS \"Sum\", avg(\"{m}\")::DOUBLE AS \"Mean\", stddev_samp(\"{m}\") AS \"StdDev\","
    f" count(\"{m}\")::DOUBLE AS \"SampleSize\" FROM tnc_stat_summary_helper WHERE assigned_vehicle IS NOT NULL GROUP BY folder" for m in _METRICS
) + "".join(
    f" UNION ALL SELECT folder, '{n}', {c} * trip_multiplier, NULL, NULL, NULL FROM tnc_stat_summary_helper JOIN case_dim USING (folder) GROUP BY folder, trip_multiplier"
    for n, c in (("assigned_requests", "count(assigned_vehicle)"), ("requests", "count(*)")))
R["demo_financial_case_data"] = f"""
WITH q AS (SELECT h.*, {AGE.format(a='c.age')} AS age_class, skim_dist*0.51 + skim_time*1.4 AS pay FROM h_priced h LEFT JOIN person c ON h.folder = c.folder AND h.person = c.person),
 rv AS (SELECT folder, sum(end_s - start_s)/60 AS mins, sum(travel_distance)/{M} AS mi FROM h_trips WHERE eff > 0 GROUP BY folder),
 rq AS (SELECT folder, count(*) AS n FROM tnc_request WHERE service_type <> 99 GROUP BY folder)
SELECT q.folder, age_class, origin_zone, sum(CASE WHEN pay >= 5 THEN pay ELSE 5 END)*m AS "total pay 1_a", count(CASE WHEN pay < 5 THEN 1 END)*m AS "1_a_cnt_req_under_5",
 count(*)*2*m AS "total_fare_2_low", count(*)*4*m AS "total_fare_2_high", coalesce(sum(skim_dist*(1.96::DOUBLE/0.621371)), 0)*m AS "total_operating_cost_2_minibus",
 coalesce(sum(skim_dist*(3.54::DOUBLE/0.621371)), 0)*m AS "total_operating_cost_2_van",
 coalesce(sum(skim_dist*(CASE WHEN pooled_service = 1 THEN 0.58::DOUBLE ELSE 0.48::DOUBLE END/0.621371)), 0)*m AS "total_operating_cost_3",
 coalesce(sum("corrected fare"), 0)*m AS total_fare, n*m AS requests, 500::BIGINT AS fleet_size, coalesce(sum("corrected fare"), 0)*m/500 AS "revenue per vehicle",
 coalesce(sum("corrected fare"), 0)*m/(n*m) AS "revenue per request", mins*m AS revenue_minutes_traveled, mi*m AS revenue_miles_traveled,
 coalesce(sum("corrected fare"), 0)*m*0.21 AS "uber take"
FROM q JOIN (SELECT folder, trip_multiplier AS m FROM case_dim) d ON q.folder = d.folder LEFT JOIN rv ON q.folder = rv.folder LEFT JOIN rq ON q.folder = rq.folder
GROUP BY q.folder, age_class, origin_zone, m, n, mins, mi"""
R["h_tours"] = f"""
SELECT folder, vehicle, tour, sub_tour, min(start_s) AS tour_start, max(end_s) AS tour_end, max(passengers) AS max_passengers,
 sum(skim_travel_time/60) AS total_skim_travel_time, sum(routed_travel_time/60) AS total_routed_travel_time,
 arg_min(service_type, rn) FILTER (service_type IS NOT NULL) AS service_type, arg_min(CAST(floor(start_s/3600) AS INTEGER), rn) AS hour,
 arg_min(origin_zone, rn) FILTER (origin_zone IS NOT NULL) AS origin_zone, arg_max(destination_zone, rn) FILTER (destination_zone IS NOT NULL) AS destination_zone,
 sum(travel_distance/{M}) AS total_travel_distance, arg_min(init_status, rn) FILTER (init_status IS NOT NULL) AS init_status,
 count(*) AS requests_served, count(*) > 1 AS pooled_tour FROM h_sub GROUP BY folder, vehicle, tour, sub_tour"""
R["tours"] = """
SELECT folder, vehicle, tour, sub_tour, vehicle || '_tour_' || tour || '_sub_' || sub_tour AS final_tour_id, tour_start, tour_end, max_passengers,
 total_skim_travel_time, total_routed_travel_time, service_type, hour, origin_zone, destination_zone, total_travel_distance, init_status, requests_served, pooled_tour FROM h_tours"""
R["repositioning_by_hour"] = """
SELECT folder, hour, count(*) AS num_repositioned, count(CASE WHEN next_origin_zone = destination_zone THEN 1 END) AS num_successful,
 count(CASE WHEN next_origin_zone = destination_zone THEN 1 END)::DOUBLE / count(*) AS success_rate FROM next_service_trip GROUP BY folder, hour"""
R["request_summary"] = """
SELECT d.folder, sum(CASE WHEN s THEN 1 - pooled_service END)::DOUBLE / nullif(count(CASE WHEN s THEN 1 END), 0) AS solo_perc,
 sum(CASE WHEN s THEN pooled_service END)::DOUBLE / nullif(count(CASE WHEN s THEN 1 END), 0) AS pooled_perc, sum(fare)*m AS total_fare,
 sum(CASE WHEN s THEN fare END) / nullif(count(CASE WHEN s THEN 1 END), 0) AS average_fare, sum(discount)*m AS total_discount,
 sum(CASE WHEN s THEN discount END) / nullif(count(CASE WHEN s THEN 1 END), 0) AS average_discount, count(CASE WHEN s THEN 1 END)*m AS requests,
 count(CASE WHEN service_type = 99 AND a THEN 1 END)*m AS repo_requests, count(CASE WHEN s AND pooled_service = 1 AND a THEN 1 END)*m AS pooled_requests,
 count(CASE WHEN s AND pooled_service = 0 AND a THEN 1 END)*m AS solo_requests, count(CASE WHEN s AND NOT a THEN 1 END)*m AS rejected_requests,
 avg(CASE WHEN s THEN pickup_time - request_time END)/60 AS average_wait_time_min, count(CASE WHEN s AND NOT a THEN 1 END)::DOUBLE / nullif(count(CASE WHEN s THEN 1 END), 0) AS rejection_rate,
 sum(discount)/nullif(sum(fare), 0) AS average_discount_rate, avg(CASE WHEN s THEN dropoff_time - pickup_time END)/60 AS average_person_ttime_min,
 avg(CASE WHEN service_type = 99 THEN dropoff_time - pickup_time END)/60 AS average_repo_ttime_min,
 avg(CASE WHEN s AND pooled_service = 1 THEN dropoff_time - pickup_time - estimated_od_travel_time END)/60 AS average_pooled_delay_time_min,
 avg(CASE WHEN s AND pooled_service = 0 THEN dropoff_time - pickup_time - estimated_od_travel_time END)/60 AS average_solo_delay_time_min
FROM (SELECT folder, trip_multiplier AS m FROM case_dim) d LEFT JOIN (SELECT *, service_type <> 99 AS s, assigned_vehicle IS NOT NULL AS a FROM tnc_request) r ON d.folder = r.folder
GROUP BY d.folder, m"""
_MEANS = ", ".join(
    f"CASE WHEN y.typed THEN avg(CASE WHEN {a} THEN {c} END) ELSE avg(CASE WHEN {b} THEN {c} END) END AS {n}_{g}"
    for g, a, b in (("repo", "service_type = 99", "init_status = -3"), ("pooled", "pooled_tour", "pooled_tour"),
                    ("solo", "NOT pooled_tour AND service_type IS DISTINCT FROM 99", "NOT pooled_tour AND init_status IS DISTINCT FROM -3"))
    for n, c in (("average_routed_ttime", "total_routed_travel_time"), ("average_skim_ttime", "total_skim_travel_time"),
                 ("average_travel_distance", "total_travel_distance")))
R["repositioning_success_rate"] = f"""
WITH t AS (SELECT h.folder, {_MEANS}, sum(total_routed_travel_time) AS total_travel_time, sum(total_travel_distance) AS total_travel_distance,
  coalesce(sum(CASE WHEN max_passengers = 0 THEN total_travel_distance END), 0) AS total_empty_vehicle_travel_distance, count(CASE WHEN pooled_tour THEN 1 END) AS pooled_tour_count
  FROM h_tours h JOIN h_typed y ON h.folder = y.folder GROUP BY h.folder, y.typed),
 v AS (SELECT p.folder, sum(passengers*travel_distance)/sum(travel_distance) AS average_vehicle_occupancy,
  sum(CASE WHEN passengers > 0 THEN passengers*travel_distance END)/sum(CASE WHEN passengers > 0 THEN travel_distance END) AS average_revenue_vehicle_occupancy,
  CASE WHEN y.typed THEN avg(CASE WHEN passengers < 1 AND service_type IS DISTINCT FROM 99 THEN travel_distance/{M} END)
   ELSE avg(CASE WHEN passengers < 1 AND init_status IS DISTINCT FROM -3 THEN travel_distance/{M} END) END AS average_pickup_segment_distance
  FROM h_sub p JOIN h_typed y ON p.folder = y.folder GROUP BY p.folder, y.typed),
 h AS (SELECT folder, sum(num_repositioned)::BIGINT AS num_repositioned, sum(num_successful)::BIGINT AS num_successful FROM repositioning_by_hour GROUP BY folder)
SELECT t.folder, coalesce(num_repositioned, 0) AS num_repositioned, coalesce(num_successful, 0) AS num_successful,
 coalesce(num_successful::DOUBLE/nullif(num_repositioned, 0), 0) AS success_rate, t.* EXCLUDE (folder), v.* EXCLUDE (folder), r.* EXCLUDE (folder)
FROM t JOIN v ON t.folder = v.folder LEFT JOIN h ON t.folder = h.folder LEFT JOIN request_summary r ON t.folder = r.folder"""

# ---- significance ---------------------------------------------------------------------------------------------------
_MEAN = "('eVMT_perc','wait_min','ttime','pooled','mileage_AVO','mileage_rAVO','trip_AVO','trip_rAVO')"


def _ttests(pair: str) -> str:
    return f"""
WITH p AS (SELECT left(a.folder, 3) AS city, b.folder AS base_case, a.folder, a."Metric" AS metric, b."Mean" AS m1, b."StdDev" AS s1, b."SampleSize" AS n1,
  a."Mean" AS m2, a."StdDev" AS s2, a."SampleSize" AS n2, CASE WHEN a."Metric" IN {_MEAN} THEN a."Mean" ELSE a."Sum" END AS value
  FROM tnc_stat_summary a JOIN tnc_stat_summary b ON a."Metric" = b."Metric" AND {pair}),
 t AS MATERIALIZED (SELECT *, {_T} AS t, n1 + n2 - 2 AS df FROM p)
SELECT city, base_case, folder, metric, t AS "t-statistic", {_p_value('t', 'df')} AS "p-value", value FROM t"""


R["tnc_ttests"] = _ttests("left(a.folder, 3) = left(b.folder, 3) AND split_part(a.folder, '_', 2) = split_part(b.folder, '_', 2) "
                          "AND contains(b.folder, '_nr') AND NOT contains(a.folder, '_nr')")
R["tnc_ttests_base_cases"] = _ttests("left(a.folder, 3) = left(b.folder, 3) AND b.folder IN ('gsc_300_jar_7', 'atx_500_nr_3') AND a.folder <> b.folder")
R["skim_lookup_tiled"] = "SELECT * FROM skim_lookup"
R["requests_tiled"] = "SELECT * FROM requests"
R["strategy_summary"] = " UNION ALL ".join(
    f"SELECT split_part(folder, '_', 1) AS city, split_part(folder, '_', 3) AS strategy, '{m}' AS \"Metric\", coalesce(sum(\"{m}\"), 0)::DOUBLE AS \"Sum\","
    f" avg(\"{m}\")::DOUBLE AS \"Mean\", stddev_samp(\"{m}\") AS \"StdDev\", count(\"{m}\")::DOUBLE AS \"SampleSize\""
    f" FROM tnc_stat_summary_helper WHERE assigned_vehicle IS NOT NULL GROUP BY 1, 2" for m in _METRICS)
R["strategy_ttests"] = f"""
WITH p AS (SELECT a.city, a.strategy, a."Metric" AS metric, b."Mean" AS m1, b."StdDev" AS s1, b."SampleSize" AS n1, a."Mean" AS m2, a."StdDev" AS s2,
  a."SampleSize" AS n2, a."Mean" AS value FROM strategy_summary a JOIN strategy_summary b ON a."Metric" = b."Metric" AND a.city = b.city
  AND b.strategy = 'nr' AND a.strategy <> 'nr'),
 t AS MATERIALIZED (SELECT *, {_T} AS t, n1 + n2 - 2 AS df FROM p)
SELECT city, strategy, metric, t AS "t-statistic", {_p_value('t', 'df')} AS "p-value", value FROM t"""
_NUM = "regexp_replace(CAST(CAST(round_even({v}, {d}) AS DECIMAL(38,{d})) AS VARCHAR), '{trim}', '')"


def _num2(v: str) -> str:
    return _NUM.format(v=v, d=2, trim="0$")


def _num1(v: str) -> str:
    return _NUM.format(v=v, d=1, trim="^$")


R["tnc_ttests_w_significance"] = f"""
SELECT *, {_num2('value')} || ' ' || "significance level" AS value_significance
FROM (SELECT city, base_case, folder, CASE metric WHEN 'wait_min' THEN 'Wait Time' WHEN 'ttime' THEN 'Travel Time' WHEN 'discount' THEN 'Discount' WHEN 'fare' THEN 'Fare'
  WHEN 'pooled' THEN 'Pooling %' WHEN 'occupied_VMT' THEN 'rVMT' WHEN 'mileage_AVO' THEN 'Mileage AVO' WHEN 'mileage_rAVO' THEN 'Mileage rAVO' WHEN 'trip_AVO' THEN 'Trip AVO'
  WHEN 'trip_rAVO' THEN 'Trip rAVO' WHEN 'operating_cost' THEN 'Operating Cost' WHEN 'revenue' THEN 'Revenue' WHEN 'assigned_requests' THEN 'Assigned Requests'
  WHEN 'requests' THEN 'Total Requests' ELSE metric END AS metric, "t-statistic", "p-value", value,
  CASE WHEN "p-value" < 0.005 THEN '***' WHEN "p-value" < 0.01 THEN '**' WHEN "p-value" < 0.05 THEN '*' ELSE '' END AS "significance level" FROM tnc_ttests)"""
R["discount_perc_unit_fix"] = f"""
SELECT a.* REPLACE ({_num1('a.value / nullif(b.value, 0) * 100')} || '% ' || a."significance level" AS value_significance), b.value AS value_fare,
 a.value / nullif(b.value, 0) AS "Discount %"
FROM tnc_ttests_w_significance a LEFT JOIN tnc_ttests_w_significance b ON a.base_case = b.base_case AND a.folder = b.folder AND b.metric = 'Fare' WHERE a.metric = 'Discount'"""
R["rejected_request_rate_unit_fix"] = """
SELECT a.*, b.value AS value_assigned, (a.value - b.value) / nullif(b.value, 0) AS "Rejected Request Rate"
FROM tnc_ttests_w_significance a LEFT JOIN tnc_ttests_w_significance b ON a.base_case = b.base_case AND a.folder = b.folder AND b.metric = 'Assigned Requests'
WHERE a.metric = 'Total Requests'"""
for _key, _metric in (("pooling_rate_unit_fix", "Pooling %"), ("evmt_unit_fix", "eVMT_perc")):
    R[_key] = (f"SELECT * REPLACE ({_num1('value * 100')} || '% ' || \"significance level\" AS value_significance) "
               f"FROM tnc_ttests_w_significance WHERE metric = '{_metric}'")

# ---- transit tables ---------------------------------------------------------------------------------------------------
R["h_loads"] = f"SELECT * FROM {_cased('transit_trip_max_load_helper')}"
for _unit in ("pattern", "trip"):
    _U = _unit.capitalize()
    R[f"{_unit}_avg_avo"] = f"""
SELECT "City", "Strategy", {_unit}_id, max(max_load) AS "Max_Load", max("AVO") AS "Max_AVO", avg(max_load) AS "Average_Max_Load", avg(trip_length) AS "Average_Trip_Length",
 max(max_load) = 0 AS "Empty_{_U}", max(max_load) <= 4 AS "TNC_Replaceable_{_U}", sum("AVO"*trip_length)/nullif(sum(trip_length), 0) AS "AVO"
FROM h_loads WHERE {_unit}_id IS NOT NULL GROUP BY "City", "Strategy", {_unit}_id"""
    R[f"{_unit}_replaceable_cases"] = f"""
SELECT "City", "Strategy", "Fleet Size", r AS "TNC_Replaceable_{_U}", e AS "Empty_{_U}", folder, sum(n)::BIGINT AS "Count", sum(w) AS "Weighted_AVO_Sum", sum(len) AS "Distance_Sum",
 max(ml) AS "Max_Load", max(ma) AS "Max_AVO"
FROM (SELECT folder, "City", "Strategy", "Fleet Size", {_unit}_id, max(max_load) AS ml, max("AVO") AS ma, sum("AVO"*trip_length) AS w, sum(trip_length) AS len, count(trip_length) AS n,
  max(max_load) <= 4 AS r, max(max_load) = 0 AS e FROM h_loads WHERE {_unit}_id IS NOT NULL GROUP BY folder, "City", "Strategy", "Fleet Size", {_unit}_id) u
GROUP BY "City", "Strategy", "Fleet Size", r, e, folder"""
    R[f"transit_{_unit}_avo_cases_vals"] = f"""
SELECT "City", "Strategy", "Fleet Size", sum("AVO"*trip_length) AS "Weighted_AVO_Sum", sum(trip_length) AS "Distance_Sum", count(trip_length) AS "Count", max(max_load) AS "Max_Load",
 max("AVO") AS "Max_AVO", sum("AVO"*trip_length)/sum(trip_length) AS "{_U}_AVO", sum(trip_length)/count(trip_length) AS "{_U}_Distance"
FROM h_loads WHERE {_unit}_id IS NOT NULL GROUP BY "City", "Strategy", "Fleet Size" """
    R[f"{_unit}_avo_histogram_vals"] = _histogram(f"{_unit}_avg_avo", '"City", "Strategy"', '"AVO"')

# ---- mode shift ---------------------------------------------------------------------------------------------------------
_MODES = {"SOV": 0, "BUS": 4, "RAIL": 5, "BICYCLE": 7, "WALK": 8, "TAXI": 9, "FAIL_REROUTE": 1001}


def _pivot(src: str) -> str:
    return "SELECT folder, " + ", ".join(
        f"coalesce(sum(CASE WHEN mode = {code} THEN total END), 0) AS \"{name}\"" for name, code in _MODES.items()) + f" FROM {src} GROUP BY folder"


R["mode_pivot"] = _pivot("mode_Distribution_ADULT_Counts")


def _combo(measure: str, dist_src: str, noun: str, vehicular: str, avo: str) -> str:
    z = "coalesce({}, 0)".format
    bus = [f"b.{measure}_{c}" for c in ("mass", "pool", "solo", "empt")]
    pr = [f"p.{measure}_{c}" for c in ("pool", "solo", "empt")]
    rail, busm = "CAST(trunc(coalesce(v.\"RAIL\", 0)) AS BIGINT)", "CAST(trunc(coalesce(v.\"BUS\", 0)) AS BIGINT)"
    s = lambda *xs: "(" + " + ".join(z(x) for x in xs) + ")::DOUBLE"
    sov, bike, walk = 'v."SOV"', 'v."BICYCLE"', 'v."WALK"'
    inner = f"""
SELECT b.folder, b.{avo} AS "Bus AVO", coalesce({bus[0]}, 0)::DOUBLE AS "Bus Mass", coalesce({bus[1]}, 0)::DOUBLE AS "Bus Pool", {bus[2]}::DOUBLE AS "Bus Solo", {bus[3]}::DOUBLE AS "Bus Empty",
 {pr[0]}::DOUBLE AS "Rideshare Pool", {pr[1]}::DOUBLE AS "Rideshare Solo", {pr[2]}::DOUBLE AS "Rideshare Empty", {sov} AS "SOV", {busm} AS "BUS", {rail} AS "RAIL", {bike} AS "BICYCLE",
 {walk} AS "WALK", v."TAXI", v."FAIL_REROUTE", {s(*bus)} AS "Bus Total", {s(*pr)} AS "Rideshare Total", {s(bus[0], rail, bike, walk)} AS "Positive", {s(bus[1], pr[0])} AS "Neutral",
 {s(bus[2], bus[3], pr[1], pr[2], sov)} AS "Negative", {s(*bus, *pr, sov)} AS "{vehicular}", {s(*bus[1:])} AS "Rideshare Replaceable Bus {noun}",
 {s(*bus, *pr, sov, rail, bike, walk)} AS "Total {noun}"
FROM bus_avo b LEFT JOIN pr_avo p ON b.folder = p.folder LEFT JOIN ({_pivot(dist_src)}) v ON b.folder = v.folder"""
    return _cased(f"""(SELECT *, "Bus Mass"/nullif("Bus Total", 0) AS "Bus Mass Share", "Rideshare Replaceable Bus {noun}"/nullif("Total {noun}", 0) AS "Rideshare Replaceable Bus Share",
 "SOV"/nullif("Total {noun}", 0) AS "SOV Share", "Rideshare Total"/nullif("Total {noun}", 0) AS "Rideshare Share" FROM ({inner}))""")


R["mode_dist_combo"] = "SELECT * FROM " + _combo("dist", "mode_Distribution_ADULT_Distance", "Distance", "Vehicular Mileage", "mileage_avo")
R["mode_cnt_combo"] = "SELECT * FROM " + _combo("cnt", "mode_Distribution_ADULT_Counts", "Trips", "Vehicular Trips", "trip_avo")


def _shifted(combo: str, noun: str, vehicular: str, word: str, vshift: str) -> str:
    rel = lambda new, old: f"(({new}) - ({old})) / nullif({old}, 0)"
    classes = ["Positive", "Neutral", "Negative"]
    keep = [f"Rideshare Replaceable Bus {noun}", f"Total {noun}", "Bus Mass Share", "Rideshare Replaceable Bus Share", "SOV Share", "Rideshare Share"]
    plain = ["folder", "Bus AVO", "Bus Mass", "Bus Pool", "Bus Solo", "Bus Empty", "City", "Fleet Size", "Strategy", "Iteration", "Bus Total", "Rideshare Pool", "Rideshare Solo",
             "Rideshare Empty", "Rideshare Total", "SOV", "RAIL", "BICYCLE", "WALK", *classes, vehicular, *keep]
    cols = [f'a."{c}"' for c in plain] + [f'h."{c}" AS "heuristic {c}"' for c in keep]
    cols += [f'{rel(f"""a."{c}" """, f"""h."{c}" """)} AS "{c} Shift Heur"' for c in classes]
    total = ' + '.join('{t}."' + c + '"' for c in classes)
    cols.append(f'{rel(total.format(t="a"), "(" + total.format(t="h") + ")")} AS "Net Overall Shift Heur"')
    a, h = 'a."Positive"', 'h."Positive"'
    b, g = 'a."Negative"', 'h."Negative"'
    cols.append(f'{rel(a, h)} - {rel(b, g)} AS "Net Positive Shift Heur"')
    av, hv = f'a."{vehicular}"', f'h."{vehicular}"'
    cols.append(f'{rel(av, hv)} AS "{vshift} Heur"')
    for share, name in (("Bus Mass Share", f"High Capacity Bus {word} Share Increase"), ("Rideshare Replaceable Bus Share", f"TNC Replaceable Bus {word} Share Increase"),
                        ("SOV Share", "SOV Share Increase"), ("Rideshare Share", "TNC Share Increase")):
        cols.append(f'a."{share}" - h."{share}" AS "{name}"')
    cols.append('(a."SOV Share" - h."SOV Share") + (a."Rideshare Share" - h."Rideshare Share") AS "Net TNC Increase vs SOV"')
    mean = lambda c: f'avg(a."{c}") OVER (PARTITION BY a."City", a."Strategy")'
    cols += [f'{rel(f"""a."{c}" """, mean(c))} AS "{c} Shift Avg"' for c in classes]
    cols.append(f'{rel(av, mean(vehicular))} AS "{vshift} Avg"')
    cols.append(f'{rel(a, mean("Positive"))} - {rel(b, mean("Negative"))} AS "Net Positive Shift Avg"')
    return (f"SELECT {', '.join(cols)} FROM {combo} a LEFT JOIN (SELECT * FROM {combo} WHERE \"Strategy\" = 'nr_0') h "
            "ON a.\"City\" = h.\"City\" AND a.\"Fleet Size\" = h.\"Fleet Size\" AND a.\"Strategy\" <> 'nr_0'")


R["mode_dist_combo_proactive"] = _shifted("mode_dist_combo", "Distance", "Vehicular Mileage", "Mileage", "Vehicular Mileage Shift")
R["mode_cnt_combo_proactive"] = _shifted("mode_cnt_combo", "Trips", "Vehicular Trips", "Trip", "Vehicular Trip Shift")
R["positive_shift_reg"] = """
SELECT folder, "City", TRY_CAST("Fleet Size" AS DOUBLE) AS "Fleet Size", "Strategy", "Iteration", "Net Positive Shift Avg" FROM mode_dist_combo_proactive"""

# ---- seniors and zones -----------------------------------------------------------------------------------------------------
R["zone_data"] = f"""
SELECT s.* REPLACE (coalesce(s.mode, 'n/a') AS mode, coalesce(s.type, 'n/a') AS type, CAST(s.zone AS VARCHAR) AS zone, CAST(trunc(round(s.hh_inc_total, 6)) AS DOUBLE) AS hh_inc_total),
 'Senior' AS "Age Group" FROM {_cased('elder_demo')} s WHERE s.age_class = 2 AND s.zone IS NOT NULL"""
R["zone_income_check"] = f"""
SELECT *, {_quartile('avg_hh_inc')} AS "HH_Inc_Quartile" FROM (SELECT "City", "Strategy", "Fleet Size", z.zone, sum(hh_inc_total)/nullif(sum(household_count), 0) AS avg_hh_inc
 FROM zone_data z GROUP BY "City", "Strategy", "Fleet Size", z.zone)"""
R["h_travel"] = "SELECT * FROM zone_data WHERE mode <> 'FAIL_REROUTE'"
R["mode_data"] = """
SELECT t.*, t.total_travel_distance_miles/nullif(t.trip_count, 0) AS "average travel distance", t.total_ttime_mins/nullif(t.trip_count, 0) AS "average travel time",
 c.avg_hh_inc, c."HH_Inc_Quartile"
FROM h_travel t LEFT JOIN zone_income_check c ON t."City" = c."City" AND t."Strategy" = c."Strategy" AND t."Fleet Size" = c."Fleet Size" AND t.zone = c.zone"""
R["hh_inc_map_df"] = f"""
SELECT *, {_quartile('"Senior HH Income Average"')} AS "HH Inc Quartile" FROM (SELECT "City", age_class, t.zone, sum(hh_inc_total) AS hh_inc_total,
 sum(household_count)::BIGINT AS household_count, sum(hh_inc_total)/nullif(sum(household_count), 0) AS "Senior HH Income Average" FROM h_travel t GROUP BY "City", age_class, t.zone)"""
R["hh_inc_map_gsc"] = "SELECT * FROM hh_inc_map_df WHERE \"City\" = 'gsc'"
R["hh_inc_map_atx"] = "SELECT * FROM hh_inc_map_df WHERE \"City\" = 'atx'"
R["demo_agg_mode_data_df"] = f"""
SELECT *, {_quartile('avg_hh_inc')} AS "Household Income Quartile" FROM (SELECT "City", "Strategy", "Fleet Size", mode, type, sum(trip_count)::BIGINT AS "Trip Count",
 sum(household_count)::BIGINT AS household_count, sum(total_travel_distance_miles) AS "Travel Distance", sum(total_ttime_mins) AS "Total Travel Time", sum(hh_inc_total) AS hh_inc_total,
 sum(hh_inc_total)/nullif(sum(household_count), 0) AS avg_hh_inc, sum(total_ttime_mins)/sum(trip_count) AS "average travel time",
 sum(total_travel_distance_miles)/sum(trip_count) AS "average travel distance" FROM h_travel GROUP BY "City", "Strategy", "Fleet Size", mode, type)"""
R["tnc_request_demo"] = f"""
SELECT "City", "Strategy", "Fleet Size", s.zone, folder, age_class, sum(request_count) AS request_count, sum("total skim solo fare") AS "total skim solo fare", sum("total discount") AS "total discount",
 sum("total fare") AS "total fare", sum("total discount percentage") AS "total discount percentage", 'TAXI' AS mode
FROM {_cased('tnc_skim_demo')} s GROUP BY "City", "Strategy", "Fleet Size", s.zone, folder, age_class"""
R["tnc_request_demo_agg"] = """
SELECT "City", "Strategy", "Fleet Size", CAST(d.zone AS VARCHAR) AS zone, folder, age_class, request_count AS "Request Count", "total skim solo fare" AS "Total Solo Skim Fare",
 "total discount" AS "Total Discount", "total fare" AS "Total Fare", "total discount percentage" AS "Total Discount %", mode, "total fare"/nullif(request_count, 0) AS "Fare per request",
 "total discount percentage"/nullif(request_count, 0) AS "discount % per request" FROM tnc_request_demo d WHERE age_class = 2"""
R["demo_zone_summary_tnc"] = """
SELECT z."City", z.zone, c."Strategy", c."Fleet Size", c.avg_hh_inc, c."HH_Inc_Quartile", a.* EXCLUDE ("City", "Strategy", "Fleet Size", zone)
FROM zone_master z LEFT JOIN zone_income_check c ON z."City" = c."City" AND z.zone = c.zone
LEFT JOIN tnc_request_demo_agg a ON z."City" = a."City" AND c."Strategy" = a."Strategy" AND c."Fleet Size" = a."Fleet Size" AND z.zone = a.zone"""
R["demo_agg_tnc_case_df"] = """
SELECT *, "Total Fare"/nullif("Request Count", 0) AS "Average Fare", "Total Discount %"/nullif("Request Count", 0) AS "Average Discount %"
FROM (SELECT "City", "Strategy", "Fleet Size", "HH_Inc_Quartile", """ + ", ".join(
    f'coalesce(sum("{c}"), 0) AS "{c}"' for c in ("Total Solo Skim Fare", "Total Discount", "Total Fare", "Total Discount %", "Request Count")
) + """ FROM demo_zone_summary_tnc WHERE "Strategy" IS NOT NULL AND "HH_Inc_Quartile" IS NOT NULL GROUP BY "City", "Strategy", "Fleet Size", "HH_Inc_Quartile")"""
_MEASURES = {"Travel Time": "total_ttime_mins", "Travel Distance": "total_travel_distance_miles", "Trips": "trip_count"}
R["zone_mode_proportions"] = 'SELECT "City", "Strategy", "Fleet Size", CAST(t.zone AS BIGINT) AS zone, type, ' + ", ".join(
    f"sum(CASE WHEN mode = '{m}' THEN {c} END)::DOUBLE AS \"{m}_{a}\"" for m in ("SOV", "TAXI", "BUS", "RAIL", "BICYCLE", "WALK") for a, c in _MEASURES.items()
) + ' FROM h_travel t GROUP BY "City", "Strategy", "Fleet Size", t.zone, type'
_BUDGET = {"TNC": "TAXI", "SOV": "SOV", "Bus": "BUS", "Rail": "RAIL"}
_TT = " + ".join(f'"{m}_Travel Time"' for m in _BUDGET.values())
_TR = " + ".join(f'"{m}_Trips"' for m in _BUDGET.values())
R["demo_activity_time_usage_df"] = f"""
WITH s AS (SELECT a."City", a."Strategy", a."Fleet Size", a.activity_type AS type, sum(activity_duration) AS duration, """ + ", ".join(
    f'coalesce(sum("{m}_{x}"), 0) AS "{m}_{x}"' for m in _BUDGET.values() for x in ("Travel Time", "Trips")
) + f""" FROM {_cased('activity_times')} a LEFT JOIN zone_mode_proportions p ON a."City" = p."City" AND a."Strategy" = p."Strategy" AND a."Fleet Size" = p."Fleet Size"
   AND a.zone = p.zone AND a.activity_type = p.type WHERE a.age_class = 2 AND a.zone IS NOT NULL AND a.activity_type NOT IN ('HOME', 'WORK AT HOME')
  GROUP BY a."City", a."Strategy", a."Fleet Size", a.activity_type),
 u AS (SELECT *, {_TT} AS "Total Travel Time", {_TR} AS "Total Trips" FROM s),
 v AS (SELECT *, """ + ", ".join(f'"{m}_Travel Time"/nullif("Total Travel Time", 0) AS "{n} Share"' for n, m in _BUDGET.items()) + """,
  duration/nullif("Total Trips", 0) AS avg_duration_per_trip, """ + ", ".join(
    f'1 - "{m}_Travel Time"/nullif(duration*("{m}_Trips"/nullif("Total Trips", 0)), 0) AS "{n} Time Budget"' for n, m in _BUDGET.items()) + """ FROM u)
SELECT *, """ + ", ".join(
    f"CASE WHEN \"{n} Time Budget\" IS NULL THEN 'No Data' WHEN \"{n} Time Budget\" > 0.8 THEN '1' WHEN \"{n} Time Budget\" > 0.6 THEN '2' "
    f"WHEN \"{n} Time Budget\" > 0.4 THEN '3' ELSE '4' END AS \"{n} Time Budget Level\"" for n in _BUDGET) + " FROM v"
R["closest_stops_by_zone"] = f"""
SELECT s.* EXCLUDE (walkable, zone), walkable AS "Walking Distance to Bus Stop", CAST(s.zone AS VARCHAR) AS zone FROM {_cased('closest_stops')} s WHERE over_60 > 0"""
R["closest_stops_helper"] = """
SELECT "Walking Distance to Bus Stop" = 1 AS "Walking Distance to Bus Stop", s.zone, "City", sum("count")::BIGINT AS "count" FROM closest_stops_by_zone s GROUP BY 1, 2, 3"""
R["hh_inc_hist_df"] = """
WITH z AS (SELECT *, CASE WHEN "Senior HH Income Average" > 150000 THEN '1.5+' ELSE CAST(CAST(round_even("Senior HH Income Average"/5000, 0) AS BIGINT)*5/100.0::DOUBLE AS VARCHAR) END AS r FROM hh_inc_map_df),
 g AS (SELECT r, z."City", c."Walking Distance to Bus Stop" AS w, sum(household_count)::BIGINT AS hh, sum(c."count")::BIGINT AS n
  FROM z JOIN closest_stops_helper c ON z.zone = c.zone AND z."City" = c."City" GROUP BY 1, 2, 3)
SELECT r AS "Rounded Income", "City", hh AS "Count", sum(CASE WHEN w THEN n END)::BIGINT AS "W/ Bus Access", sum(CASE WHEN NOT w THEN n END)::BIGINT AS "W/O Bus Access" FROM g GROUP BY 1, 2, 3"""
_Q = ["1- <25%", "2- between 25% and 50%", "3- between 50% and 75%", "4- >75%"]
R["hh_inc_pivot"] = 'SELECT "City", CAST(h.zone AS BIGINT) AS zone, ' + ", ".join(
    f"sum(CASE WHEN \"HH Inc Quartile\" = '{q}' THEN household_count END)::BIGINT AS \"{q}\"" for q in _Q
) + ", \"City\" || '_' || h.zone AS city_zone FROM hh_inc_map_df h GROUP BY \"City\", h.zone"
_QSUM = "(" + " + ".join(f'"{q}"' for q in _Q) + ")"
R["vehicle_ownership_df"] = f"""
WITH v AS (SELECT "City", "ZONE" AS zone, sum(households)::BIGINT AS households, coalesce(sum(vo), 0) AS vo FROM {_cased('fare_sensitivity_results_vo')} WHERE "ZONE" IS NOT NULL GROUP BY 1, 2),
 w AS (SELECT v.*, """ + ", ".join(f'coalesce(p."{q}", 0) AS "{q}"' for q in _Q) + """ FROM v LEFT JOIN hh_inc_pivot p ON v."City" = p."City" AND v.zone = p.zone)
SELECT *, """ + ", ".join(
    f'CASE WHEN {_QSUM} = 0 THEN vo/nullif(households, 0) ELSE vo/nullif(households, 0)*"{q}"/{_QSUM} END AS "{n}"' for n, q in (
        ("3 VO for HH Inc Between 50% and 75%", _Q[2]), ("4 VO for HH Inc >75%", _Q[3]), ("2 VO for HH Inc between 25% and 50%", _Q[1]), ("1 VO for HH Inc between <25%", _Q[0]))
) + " FROM w"

# ---- finance -------------------------------------------------------------------------------------------------------------------
_SUMS = ["total pay 1_a", "1_a_cnt_req_under_5", "total_fare_2_low", "total_fare_2_high", "total_operating_cost_2_minibus", "total_operating_cost_2_van", "total_operating_cost_3",
         "total_fare", "requests", "uber take", "revenue_minutes_traveled", "revenue_miles_traveled"]
_GRAIN = 'age_class, "City", "Fleet Size", "Strategy", "Iteration"'
R["financial_case_data_df"] = f"""
SELECT age_class, "City", '500' AS "Fleet Size", "Strategy", "Iteration", """ + ", ".join(f'sum("{c}") AS "{c}"' for c in _SUMS) + f""",
 sum(total_fare - "uber take") AS "driver pay take rate" FROM {_cased('demo_financial_case_data')} GROUP BY age_class, "City", "Strategy", "Iteration" """
R["case_1_a"] = f"""
SELECT {_GRAIN}, "total pay 1_a", "1_a_cnt_req_under_5", total_fare, requests, revenue_minutes_traveled, revenue_miles_traveled, total_fare - "total pay 1_a" AS "Gross Profit" FROM financial_case_data_df"""
R["case_1_b"] = f"""
SELECT {_GRAIN}, total_fare, requests, "uber take" AS "Gross Profit", "driver pay take rate", revenue_minutes_traveled, revenue_miles_traveled FROM financial_case_data_df"""
_PROFITS = {
    "Low Fare Gross Profit Van": "total_fare_2_low - total_operating_cost_2_van", "High Fare Gross Profit Van": "total_fare_2_high - total_operating_cost_2_van",
    "Low Fare Gross Profit Minibus": "total_fare_2_low - total_operating_cost_2_minibus", "High Fare Gross Profit Minibus": "total_fare_2_high - total_operating_cost_2_minibus",
}
R["case_2"] = f"""
SELECT {_GRAIN}, "total pay 1_a", total_fare_2_low, total_fare_2_high, total_operating_cost_2_minibus, total_operating_cost_2_van, total_fare, requests, """ + ", ".join(
    f'{e} AS "{n}"' for n, e in _PROFITS.items()) + " FROM financial_case_data_df"
R["case_3"] = f"""
SELECT {_GRAIN}, total_operating_cost_3, total_fare, requests, revenue_minutes_traveled, revenue_miles_traveled, total_fare - total_operating_cost_3 AS "Gross Profit" FROM financial_case_data_df"""
R["combined_financial_cases_df"] = """
SELECT a.*, b."driver pay take rate", c.total_fare_2_low, c.total_fare_2_high, c.total_operating_cost_2_minibus, c.total_operating_cost_2_van, d.total_operating_cost_3,
 b."Gross Profit" AS "Case 1 B", c."Low Fare Gross Profit Van" AS "Case 2:Low Fare Van", c."High Fare Gross Profit Van" AS "Case 2:High Fare Van",
 c."Low Fare Gross Profit Minibus" AS "Case 2:Low Fare Minibus", c."High Fare Gross Profit Minibus" AS "Case 2:High Fare Minibus", d."Gross Profit" AS "Case 3"
FROM (SELECT * EXCLUDE ("Gross Profit"), "Gross Profit" AS "Case 1 A" FROM case_1_a) a """ + " ".join(
    f'LEFT JOIN {t} {x} ON a.age_class = {x}.age_class AND a."City" = {x}."City" AND a."Fleet Size" = {x}."Fleet Size" AND a."Strategy" = {x}."Strategy" AND a."Iteration" = {x}."Iteration"'
    for t, x in (("case_1_b", "b"), ("case_2", "c"), ("case_3", "d")))
_LEVEL = "CASE WHEN {v} > 1 THEN '1' WHEN {v} > 0.8 THEN '2' WHEN {v} > 0.7 THEN '3' WHEN {v} > 0.6 THEN '4' ELSE '5' END"
R["demo_financial_case_data_df"] = f"""
WITH d AS (SELECT "City", "Strategy", "Fleet Size", CAST("ZONE" AS VARCHAR) AS zone, sum("AVG_DIST"*{M}*"REQUESTS") AS dist_metres, sum("REQUESTS") AS "zone requests"
  FROM {_cased('fare_sensitivity_demograpic_tnc_stats')} WHERE "ZONE" IS NOT NULL GROUP BY 1, 2, 3, 4),
 j AS (SELECT d.dist_metres, d."zone requests", f.* EXCLUDE (origin_zone), d.zone, f.total_fare - f."uber take" AS "driver pay take rate",
  f.total_fare/nullif(d.dist_metres, 0) AS "cost per metre", f.total_fare/nullif(d.dist_metres/{M}, 0) AS "cost per mile"
  FROM d JOIN {_cased('demo_financial_case_data')} f ON d."City" = f."City" AND d."Strategy" = f."Strategy" AND d."Fleet Size" = f."Fleet Size" AND d.zone = CAST(f.origin_zone AS VARCHAR)
  WHERE f.age_class = 2)
SELECT *, {_LEVEL.format(v='"cost per metre"')} AS "Per Metre Level", {_LEVEL.format(v='"cost per mile"')} AS "Per Mile Level" FROM j"""

HELPERS = {k for k in R if k.startswith("h_")}

# the driver's tables, for finding out which result columns are floating
_TABLES = {
    "customer": "c_custkey BIGINT, c_name VARCHAR, c_nationkey INTEGER, c_acctbal DOUBLE, c_mktsegment VARCHAR",
    "supplier": "s_suppkey BIGINT, s_name VARCHAR, s_nationkey INTEGER, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name VARCHAR, p_brand VARCHAR, p_type VARCHAR, p_size INTEGER, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus VARCHAR, o_totalprice DOUBLE, o_orderdate TIMESTAMP, o_orderpriority VARCHAR",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, "
                "l_tax DOUBLE, l_returnflag VARCHAR, l_linestatus VARCHAR, l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR",
}


def _with_ctes(name: str) -> str:
    """The text of a report behind the views and reports it mentions, in definition order."""
    everything = {**VIEWS, **R}
    if name in VIEWS and name in R:
        everything[name] = R[name]
    wanted: list[str] = []

    def visit(key: str, text: str) -> None:
        for other in everything:
            if other != key and re.search(rf"(?:FROM|JOIN|,)\s+\(*{other}\b(?!\s*\.)", text):
                visit(other, everything[other])
                if other not in wanted:
                    wanted.append(other)

    visit(name, R[name])
    ctes = ",\n".join(f"{k} AS ({everything[k]})" for k in wanted if k != name)
    return f"WITH {ctes}\nSELECT * FROM ({R[name]})" if ctes else R[name]


def _rounded(c: str) -> str:
    """Six decimals up to 1e5, fewer beyond; the offset keeps exact ties on one side in both engines."""
    return (f'CASE WHEN abs("{c}") < 1e5 THEN round("{c}" + 3e-8, 6) WHEN abs("{c}") < 1e9 THEN round("{c}" + 3e-4, 2) '
            f'ELSE round("{c}" + 0.03, 0) END')


def statements() -> dict[str, str]:
    import duckdb

    con = duckdb.connect()
    for table, columns in _TABLES.items():
        con.execute(f"CREATE TABLE {table} ({columns})")
    out = {}
    for name in R:
        if name in HELPERS:
            continue
        text = _with_ctes(name)
        described = con.execute(f"DESCRIBE {text}").fetchall()
        columns = ", ".join(f'{_rounded(c)} AS "{c}"' if kind == "DOUBLE" else f'"{c}"' for c, kind, *_ in described)
        out[name] = f"SELECT {columns} FROM ({text})"
    con.close()
    return out
