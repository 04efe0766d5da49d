"""DuckDB definitions of the simulation tables (see FIXTURES.md)."""

VIEWS: dict[str, str] = {}

VIEWS["case_dim"] = """
SELECT * FROM (VALUES (0,'gsc_300_nr_7',4.0::DOUBLE),(1,'gsc_300_jar_7',4.0::DOUBLE),(2,'atx_500_nr_3',2.0::DOUBLE),
 (3,'atx_500_0.2_3',2.0::DOUBLE)) AS t(case_id, folder, trip_multiplier)"""

VIEWS["case_params"] = """
SELECT folder, trip_multiplier, 500::BIGINT AS fleet_size, 0.274::DOUBLE AS per_minute, 1.22::DOUBLE AS per_mile,
 7.27::DOUBLE AS base_fare, CASE WHEN case_id IN (0, 2) THEN 'default' ELSE 'auction' END AS assignment_strategy,
 0.42::DOUBLE AS pooling_discount FROM case_dim"""

VIEWS["location"] = """
SELECT f.folder, p_partkey AS location, CAST(p_size AS BIGINT) AS zone, CAST((p_partkey*7919)%20011 AS DOUBLE) AS x,
 CAST((p_partkey*104729)%20021 AS DOUBLE) AS y FROM part CROSS JOIN case_dim f"""

VIEWS["zone"] = """
SELECT DISTINCT folder, location.zone AS zone, CAST(location.zone % 5 AS INTEGER) AS area_type FROM location"""

VIEWS["household"] = """
SELECT f.folder, c_custkey AS household, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_custkey % 200 END AS location,
 CAST(c_acctbal*40 AS DOUBLE) AS income, c_custkey % 4 AS vehicles, 1 + c_custkey % 5 AS persons, c_custkey % 3 AS workers
FROM customer JOIN case_dim f ON c_custkey % 4 = f.case_id"""

VIEWS["person"] = """
SELECT h.folder, h.household*2 + k.i AS person, h.household,
 CASE WHEN h.household % 23 = 0 THEN NULL ELSE (h.household*37 + k.i*41) % 95 END AS age,
 CASE WHEN h.household % 5 = 0 THEN NULL ELSE (h.household*13 + k.i) % 200 END AS work_location_id, h.income/2 AS income,
 h.household % 6 AS education, k.i AS gender, h.household % 7 AS race, h.household % 11 = 0 AS disability,
 h.household % 3 AS marital_status
FROM household h CROSS JOIN (VALUES (0),(1)) AS k(i)"""

VIEWS["trip"] = """
SELECT f.folder, o_orderkey AS trip_id, o_custkey*2 + o_orderkey % 2 AS person,
 CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 200 ELSE (o_orderkey*11) % 200 END AS origin,
 CASE WHEN o_orderkey % 4 = 0 THEN (o_custkey*13 + o_orderkey % 2) % 200 WHEN o_orderkey % 4 = 1 THEN o_custkey % 200
  ELSE (o_orderkey*7) % 200 END AS destination,
 o_orderkey % 10 AS mode, CAST((o_orderkey*97) % 80000 AS DOUBLE) AS start_s,
 CAST((o_orderkey*97) % 80000 + (o_orderkey*31) % 3600 AS DOUBLE) AS end_s, o_totalprice/10 AS travel_distance,
 CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END AS has_artificial_trip
FROM orders JOIN case_dim f ON o_custkey % 4 = f.case_id"""

VIEWS["activity"] = """
SELECT folder, trip_id AS trip, person, CASE mode WHEN 0 THEN 'SOV' WHEN 4 THEN 'BUS' WHEN 5 THEN 'RAIL' WHEN 9 THEN 'TAXI'
  WHEN 8 THEN 'WALK' WHEN 7 THEN 'FAIL_REROUTE' ELSE 'NO_MOVE' END AS mode,
 CASE trip_id % 4 WHEN 0 THEN 'WORK' WHEN 1 THEN 'HOME' WHEN 2 THEN 'SHOP' ELSE 'LEISURE' END AS type,
 end_s - start_s + 600 AS duration FROM trip"""

VIEWS["tnc_request"] = """
SELECT f.folder, o_orderkey AS tnc_request_id, o_custkey*2 + o_orderkey % 2 AS person,
 CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderkey % 25 END AS assigned_vehicle,
 CASE WHEN o_orderkey % 7 = 0 THEN 99 ELSE 1 + o_orderkey % 2 END AS service_type,
 o_orderkey % 2 AS pooled_service, 1 + o_orderkey % 3 AS party_size, CAST((o_orderkey*53) % 82000 AS DOUBLE) AS request_time,
 CAST((o_orderkey*53) % 82000 + (o_orderkey*29) % 900 AS DOUBLE) AS pickup_time,
 CAST((o_orderkey*53) % 82000 + (o_orderkey*29) % 900 + 60 + (o_orderkey*41) % 2400 AS DOUBLE) AS dropoff_time,
 CAST(60 + (o_orderkey*43) % 2000 AS DOUBLE) AS estimated_od_travel_time, o_totalprice/10000 AS fare,
 (o_orderkey % 5)/10.0::DOUBLE AS discount, o_totalprice/10000 AS distance, (o_orderkey*11) % 200 AS origin_location,
 1 + (o_orderkey*11) % 10 AS origin_zone, 1 + (o_orderkey*7) % 10 AS destination_zone
FROM orders JOIN case_dim f ON o_custkey % 4 = f.case_id"""

VIEWS["tnc_trip"] = """
SELECT r.folder, e.event_id AS tnc_trip_id_int, CASE WHEN e.event_id % 31 = 0 THEN NULL ELSE r.tnc_request_id END AS request,
 e.user_id AS vehicle, CAST(floor(e.event_id/2000.0::DOUBLE) AS BIGINT) AS tour,
 (CAST(epoch_us(e.ts) AS DOUBLE)/1000000 - 1704067200)/30 AS start_s,
 (CAST(epoch_us(e.ts) AS DOUBLE)/1000000 - 1704067200)/30 + 60 + (e.event_id*19) % 500 AS end_s, e.event_id % 4 AS passengers,
 CASE e.event_id % 5 WHEN 0 THEN -2 WHEN 1 THEN -3 ELSE 1 END AS init_status,
 CAST(500 + (e.event_id*37) % 9000 AS DOUBLE) AS travel_distance, CAST(60 + (e.event_id*23) % 1500 AS DOUBLE) AS skim_travel_time,
 CAST(70 + (e.event_id*29) % 1700 AS DOUBLE) AS routed_travel_time
FROM events e JOIN tnc_request r ON CAST(floor(e.event_id/2.0::DOUBLE) AS BIGINT) = r.tnc_request_id"""

VIEWS["tnc_statistics"] = """
SELECT f.folder, s_suppkey AS vehicle, CAST(floor(s_acctbal/100) AS INTEGER) AS tot_dropoffs
FROM supplier JOIN case_dim f ON s_suppkey % 4 = f.case_id"""

VIEWS["transit_vehicle_links"] = """
SELECT f.folder, l_orderkey AS object_id, CAST(floor(l_quantity) AS INTEGER) % 4 AS value_seated_load,
 CASE WHEN l_linenumber % 4 = 0 THEN 1 ELSE 0 END AS value_standing_load, l_extendedprice/10 AS value_length
FROM lineitem JOIN case_dim f ON l_orderkey % 4 = f.case_id"""

VIEWS["transit_trips"] = """
SELECT f.folder, CASE WHEN o_orderkey % 10 = 0 THEN -o_orderkey ELSE o_orderkey END AS trip_id, o_custkey % 100 AS pattern_id
FROM orders JOIN case_dim f ON o_orderkey % 4 = f.case_id"""

VIEWS["transit_patterns"] = """
SELECT f.folder, c_custkey + 10 AS pattern_id, CAST(c_nationkey AS BIGINT) AS route_id FROM customer CROSS JOIN case_dim f"""

VIEWS["transit_stops"] = """
SELECT f.folder, s_suppkey AS stop_id, CAST((s_suppkey*7907)%20011 AS DOUBLE) AS x, CAST((s_suppkey*6151)%20021 AS DOUBLE) AS y
FROM supplier CROSS JOIN case_dim f"""

VIEWS["skim"] = """
SELECT f.folder, p.period, o.zone AS origin_zone, d.zone AS destination_zone,
 1.0::DOUBLE + abs(o.zone - d.zone)*0.7::DOUBLE + p.period/600.0::DOUBLE AS time_min, (1 + abs(o.zone - d.zone))*900.0::DOUBLE AS dist_m
FROM case_dim f CROSS JOIN (VALUES (360),(600),(900),(1140),(1440)) AS p(period)
CROSS JOIN (SELECT DISTINCT CAST(p_size AS BIGINT) AS zone FROM part) o
CROSS JOIN (SELECT DISTINCT CAST(p_size AS BIGINT) AS zone FROM part) d"""

VIEWS["run_dirs"] = """
SELECT 'case_' || o_custkey AS case_name, CASE o_orderkey % 8 WHEN 0 THEN 'case_' || o_custkey || '_iteration_'
  WHEN 1 THEN 'abm_init_iteration' WHEN 2 THEN 'logs' ELSE 'case_' || o_custkey || '_iteration_' || (o_orderkey % 13) END AS dir_name,
 o_orderstatus <> 'F' AS finished FROM orders"""

VIEWS["case_labels"] = """
SELECT c_custkey AS case_id, CASE c_custkey % 6 WHEN 0 THEN 'gvl_heur_' || (c_custkey % 9)
 WHEN 1 THEN 'gsc_' || (100 * c_nationkey) || '_nr_' || (c_custkey % 9)
 WHEN 2 THEN 'atx_' || (100 * c_nationkey) || '_0.' || (1 + c_custkey % 9) || '_' || (c_custkey % 9)
 WHEN 3 THEN 'gsc_' || (100 * c_nationkey) || '_heur_' || (c_custkey % 9)
 WHEN 4 THEN 'atx_' || (100 * c_nationkey) || '_jar' ELSE 'x' || c_custkey END AS folder FROM customer"""

_SCENARIO = """'{"Population synthesizer controls": {"traffic_scale_factor": ' ||
  (CASE c_custkey % 4 WHEN 0 THEN '0.25' WHEN 1 THEN '0.5' WHEN 2 THEN '1.0' ELSE '0.0' END) ||
  '}, "General simulation controls": {"database_name": "city' || c_nationkey ||
  '"}, "Scenario controls": {"rideshare_cost_per_minute": 0.' || (1 + c_custkey % 8) || ', "rideshare_cost_per_mile": 1.' ||
  (c_custkey % 10) || ', "rideshare_base_fare": ' || (2 + c_custkey % 7) || '}}'"""
_FLEET = """'{"Operator_1": {"Fleet_Base": {' || (CASE WHEN c_custkey % 2 = 0 THEN '"Operator_1_TNC_FLEET_SIZE": '
  ELSE '"TNC_FLEET_SIZE": ' END) || (100 + c_custkey % 900) || '}' ||
  (CASE WHEN c_custkey % 5 = 0 THEN '' ELSE ', "strategy_name": "S' || (c_custkey % 3) || '"' END) ||
  '}, "S0": {"assignment_strategy": "default", "reposition_strategy": "none"}, "S1": {"assignment_strategy": "auction", ' ||
  '"reposition_strategy": "zone"}, "S2": {"assignment_strategy": "default"}, "DRS_Discount_AR": ' ||
  '{"repositioning_batched_interval_seconds": ' ||
  (CASE WHEN c_custkey % 3 = 0 THEN 'null' ELSE CAST(300 * (1 + c_custkey % 4) AS VARCHAR) END) || '}}'"""
_POOLING = """'{"TNC_Pooling_Model": {"CU_DEFAULT_POOLING_DISCOUNT": 0.' || (1 + c_custkey % 9) || '}}'"""

VIEWS["model_files"] = f"""
SELECT 'case_' || c_custkey AS case_name, 'scenario_abm.modified.json' AS file_name, {_SCENARIO} AS content
 FROM customer WHERE c_custkey % 3 <> 0
UNION ALL SELECT 'case_' || c_custkey, 'scenario_abm_trajectories.modified.json', replace({_SCENARIO}, 'city', 'town')
 FROM customer WHERE c_custkey % 7 <> 0
UNION ALL SELECT 'case_' || c_custkey, 'SAEVFleetModel_optimization.json', {_FLEET} FROM customer
UNION ALL SELECT 'case_' || c_custkey, 'PoolingModel.json', {_POOLING} FROM customer WHERE c_custkey % 11 <> 0"""
