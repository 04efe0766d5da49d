"""Hand-made edge cases of the reports."""

from collections import ChainMap

import pytest
from pyspark.sql import functions as F

from mobspark.functions import naming
from mobspark.plans import demographics, finance, modes, repair, repositioning, ridehail, significance, transit
from mobspark.analysis import run_reports
from mobspark.registry import Registry, Report, default_registry
from mobspark.sources.store import ReportStore

SCHEMAS = {
    "trip": "folder string, trip_id bigint, person bigint, origin bigint, destination bigint, mode bigint, start_s double, end_s double, travel_distance double, has_artificial_trip int",
    "activity": "folder string, trip bigint, person bigint, mode string, type string, duration double",
    "person": "folder string, person bigint, household bigint, age bigint, work_location_id bigint, income double, education bigint, gender int, race bigint, disability boolean, marital_status bigint",
    "household": "folder string, household bigint, location bigint, income double, vehicles bigint, persons bigint, workers bigint",
    "location": "folder string, location bigint, zone bigint, x double, y double",
    "zone": "folder string, zone bigint, area_type int",
    "tnc_request": "folder string, tnc_request_id bigint, person bigint, assigned_vehicle bigint, service_type bigint, pooled_service bigint, party_size bigint, request_time double, pickup_time double, dropoff_time double, estimated_od_travel_time double, fare double, discount double, distance double, origin_location bigint, origin_zone bigint, destination_zone bigint",
    "tnc_trip": "folder string, tnc_trip_id_int bigint, request bigint, vehicle bigint, tour bigint, start_s double, end_s double, passengers bigint, init_status int, travel_distance double, skim_travel_time double, routed_travel_time double",
    "tnc_statistics": "folder string, vehicle bigint, tot_dropoffs int",
    "transit_vehicle_links": "folder string, object_id bigint, value_seated_load double, value_standing_load double, value_length double",
    "transit_trips": "folder string, trip_id bigint, pattern_id bigint",
    "transit_patterns": "folder string, pattern_id bigint, route_id bigint",
    "transit_stops": "folder string, stop_id bigint, x double, y double",
    "skim": "folder string, period int, origin_zone bigint, destination_zone bigint, time_min double, dist_m double",
}
MILE = 1609.34


@pytest.fixture
def tables(frame):
    def make(**rows):
        return {name: frame(schema, *rows.get(name, [])) for name, schema in SCHEMAS.items()}

    return make


@pytest.fixture
def params(frame):
    def make(*folders, m=2.0, strategy="default"):
        return frame(
            "folder string, trip_multiplier double, fleet_size bigint, per_minute double, per_mile double, base_fare double, assignment_strategy string, pooling_discount double",
            *[(f, m, 10, 0.5, 2.0, 3.0, strategy, 0.4) for f in folders])

    return make


def request(id, vehicle=1, kind=1, pooled=0, party=1, t=0.0, person=1, folder="f", **kw):
    base = dict(pickup=t + 60, dropoff=t + 180, est=100.0, fare=10.0, discount=0.5, dist=5.0, loc=1, o=1, d=2) | kw
    return (folder, id, person, vehicle, kind, pooled, party, t, base["pickup"], base["dropoff"], base["est"], base["fare"], base["discount"], base["dist"], base["loc"], base["o"], base["d"])


def move(id, req, passengers, start=0.0, vehicle=1, tour=1, status=1, dist=MILE, folder="f"):
    return (folder, id, req, vehicle, tour, start, start + 60, passengers, status, dist, 60.0, 120.0)


def one(df, **where):
    for k, v in where.items():
        df = df.where(F.col(f"`{k}`") == v)
    got = df.collect()
    assert len(got) == 1
    return got[0].asDict()


def test_pr_avo_classes_with_repositioning_and_missing_requests(tables, params):
    t = tables(
        tnc_request=[request(1), request(2, kind=99)],
        tnc_trip=[move(1, 1, 2), move(2, 1, 1), move(3, 2, 3), move(4, None, 0), move(5, None, 1), move(6, 77, 2), move(7, 1, None)],
    )
    got = one(ridehail.pr_avo(t, params("f", "empty")), folder="f")
    assert (got["cnt_pool"], got["cnt_solo"], got["cnt_empt"]) == (4.0, 4.0, 4.0)  # 2 pooled, 2 solo, 2 empty legs x 2
    assert got["dist_empt"] == pytest.approx(4.0)
    empty = one(ridehail.pr_avo(t, params("f", "empty")), folder="empty")
    assert empty["cnt_pool"] == 0.0 and empty["dist_pool"] is None


def test_fare_sensitivity_results_counts_and_ratios(tables, params):
    t = tables(
        tnc_request=[request(1), request(2, vehicle=None), request(3, kind=99), request(4, kind=99, vehicle=None)],
        tnc_trip=[move(1, 1, 2), move(2, 3, 4), move(3, None, 0)], tnc_statistics=[("f", 1, 4), ("f", 2, 6)],
    )
    got = one(ridehail.fare_sensitivity_results(t, params("f")))
    assert (got["fleet_size"], got["avg_trips"], got["requests_served"], got["repo_requests_served"], got["unserved_requests"]) == (4.0, 5.0, 2.0, 2.0, 2.0)
    assert got["AVO"] == pytest.approx(2 / 3) and got["rAVO"] == pytest.approx(2.0) and got["perc_evmt"] == pytest.approx(2 / 3)
    assert got["trip_avo"] == pytest.approx(2 / 4)  # effective passengers over all requests
    assert got["trip_ravo"] == pytest.approx(2 / 2)  # repositioning legs with raw passengers count 0
    assert got["sov_vmt"] is None


def test_unmatched_transit_runs_collapse_per_case(tables, params):
    t = tables(
        transit_vehicle_links=[("f", 1, 1.0, 0.0, 100.0), ("f", 1, 3.0, 0.0, 300.0), ("f", 2, 0.0, 0.0, 50.0), ("f", 3, 9.0, 0.0, 50.0), ("f", 4, 0.0, 0.0, 10.0)],
        transit_trips=[("f", 1, 11), ("f", 4, 12)], transit_patterns=[("f", 11, 5)],
    )
    helper = transit.transit_trip_max_load_helper(t, params("f"))
    rows = {r.trip_id: r for r in helper.collect()}
    assert set(rows) == {1, 2, 4}
    assert rows[1].max_load == 6.0 and rows[1].AVO == pytest.approx(5.0) and (rows[1].pattern_id, rows[1].route_id) == (11, 5)
    assert rows[2].max_load == 18.0 and rows[2].pattern_id is None and rows[2].trip_length == 100.0
    assert rows[4].route_id is None
    counts = one(transit.transit_trip_max_load(t, params("f", "g")), folder="f")
    assert (counts["empty_trips"], counts["tnc_replaceable_routes"]) == (1, 0)  # route 5 has 6, the route-less group 18
    assert one(transit.transit_trip_max_load(t, params("f", "g")), folder="g")["empty_trips"] == 0


def test_purposes_with_unknown_work_place(tables, params):
    t = tables(
        trip=[("f", 1, 1, 5, 6, 0, 0.0, 100.0, MILE, 0), ("f", 2, 2, 7, 8, 0, 0.0, 100.0, MILE, 0), ("f", 3, 1, 5, 9, 0, 0.0, 2.0, MILE, 0), ("f", 4, 1, 5, 9, 7, 0.0, 9.0, MILE, 1)],
        person=[("f", 1, 1, 30, 6, 0.0, 0, 0, 0, False, 0), ("f", 2, 2, None, None, 0.0, 0, 0, 0, False, 0)],
        household=[("f", 1, 5, 0.0, 1, 1, 1), ("f", 2, None, 0.0, 1, 1, 1)], location=[("f", 5, 1, 0.0, 0.0)],
    )
    counts = {r["mode"]: r for r in modes.mode_distribution_counts(t, params("f")).collect()}
    assert (counts[0].HBW, counts[0].HBO, counts[0].NHB, counts[0].total) == (2.0, 0.0, 0.0, 4.0)
    assert (counts[7].HBO, counts[7].total) == (2.0, 2.0)  # artificial trips count for cycling and walking only
    t2 = dict(t, person=t["person"].where("person = 2"))
    dist = one(modes.mode_distribution_distance(t2, params("f")))
    assert dist["HBW"] is None and dist["NHB"] is None and dist["total"] == pytest.approx(2.0)


def test_summary_helper_keeps_repositioning_and_raw_discount(tables, params):
    t = tables(
        tnc_request=[request(1, party=1), request(2, kind=99, party=2), request(3)],
        tnc_trip=[move(1, 1, 0), move(2, 1, 2), move(3, 2, 3)],
    )
    rows = {r.tnc_request_id: r for r in ridehail.tnc_stat_summary_helper(t, params("f")).collect()}
    assert rows[1].pooled == 1 and rows[1].eVMT_perc == pytest.approx(0.5) and rows[1].VMT == pytest.approx(4.0)
    assert rows[1].revenue == pytest.approx((10 - 0.5 - 1.0) * 2) and rows[1].discount == pytest.approx(10.0)
    assert rows[2].passengers == 0 and rows[2].eVMT_perc == 1.0 and rows[2].mileage_rAVO is None and rows[2].pooled == 0
    assert rows[3].VMT is None and rows[3].revenue is None and rows[3].pooled == 0
    summary = {r.Metric: r for r in ridehail.tnc_stat_summary(t, params("f")).collect()}
    assert summary["requests"].Sum == 6.0 and summary["wait_min"].SampleSize == 3.0 and len(summary) == 16


def test_fares_from_the_skim(tables, params):
    t = tables(
        tnc_request=[request(1, pooled=1, discount=0.25), request(2), request(3, t=1e6), request(4, kind=99)],
        skim=[("f", 360, 1, 2, 10.0, MILE)], tnc_statistics=[("f", 1, 1)],
        person=[("f", 1, 1, 70, 6, 0.0, 0, 0, 0, False, 0)], household=[("f", 1, 5, 9.0, 1, 1, 1)], location=[("f", 5, 4, 0.0, 0.0)],
    )
    rows = {r.request: r.asDict() for r in ridehail.requests_report(t, params("f")).collect()}
    assert set(rows) == {1, 2, 3} and rows[1]["solo_equiv_fare_skim"] == pytest.approx(10.0)
    assert rows[1]["corrected fare"] == pytest.approx(6.0) and rows[1]["discount"] == pytest.approx(4.0) and rows[1]["age_class"] == 2
    assert rows[2]["corrected fare"] == pytest.approx(10.0) and rows[3]["corrected fare"] is None and rows[3]["discount_rate"] == 0
    own = {r.request: r["corrected fare"] for r in ridehail.requests_report(t, params("f", strategy="auction")).collect()}
    assert own[1] == pytest.approx(7.5)
    total = one(ridehail.requests_sum(t, params("f")))
    assert total["total fare"] == pytest.approx(32.0) and total["revenue per vehicle"] == pytest.approx(16.0) and total["revenue per request"] == pytest.approx(32 / 6)
    costs = {r.age_class: r.asDict() for r in finance.demo_financial_case_data(t, params("f")).collect()}
    assert costs[2]["total pay 1_a"] == pytest.approx((14.51 + 14.51 + 5) * 2)  # an unknown distance earns the minimum
    assert costs[2]["1_a_cnt_req_under_5"] == 0 and costs[2]["total_fare_2_high"] == 24.0


def test_repair_skips_cases_without_repositioning_strategy(tables):
    rows = [request(1, kind=99, party=2), request(2)]
    trips = [move(1, 1, 3), move(2, 2, 3), move(3, None, 3)]
    as_case = lambda data, f: [(f, *r[1:]) for r in data]
    t = tables(tnc_request=as_case(rows, "gsc_300_jar_7") + as_case(rows, "gsc_300_nr_7"), tnc_trip=as_case(trips, "gsc_300_jar_7") + as_case(trips, "gsc_300_nr_7"))
    fixed = {(r.folder, r.tnc_trip_id_int): r.passengers for r in repair.repaired_trips(t).collect()}
    assert fixed["gsc_300_jar_7", 1] == 0 and fixed["gsc_300_jar_7", 2] == 3 and fixed["gsc_300_jar_7", 3] == 3 and fixed["gsc_300_nr_7", 1] == 3
    raw = {r.folder: r for r in repair.repair_check(t).collect()}
    assert not raw["gsc_300_jar_7"].ok and raw["gsc_300_jar_7"].max_pass == 3 and raw["gsc_300_nr_7"].ok
    with pytest.raises(ValueError, match="1 cases"):
        repair.require_repaired(t)
    check = {r.folder: r for r in repair.repair_check(repair.repaired_tables(t)).collect()}
    assert check["gsc_300_jar_7"].ok and check["gsc_300_jar_7"].max_party == 0
    assert check["gsc_300_nr_7"].ok and not check["gsc_300_nr_7"].repaired and check["gsc_300_nr_7"].max_pass == 3
    repair.require_repaired(repair.repaired_tables(t))


def test_repair_check_without_repositioning_rows(tables):
    t = tables(tnc_request=[request(1)], tnc_trip=[move(1, 1, 3)])
    got = one(repair.repair_check(t))
    assert got["ok"] and got["max_party"] is None and got["max_pass"] is None
    assert repair.repair_check(tables(tnc_trip=[move(1, 1, 1)])).count() == 0


def test_repositioning_rules_by_case(tables, params):
    typed = [move(1, 1, 0, 0.0, status=-2, folder="a"), move(2, 2, 1, 100.0, folder="a"), move(3, None, 0, 200.0, status=-3, folder="a")]
    plain = [move(1, None, 0, 0.0, status=-3, folder="b"), move(2, 2, 1, 100.0, folder="b"), move(3, None, 0, 90.0, status=-3, folder="b")]
    none = [move(1, 2, 1, 0.0, folder="c")]
    t = tables(
        tnc_request=[request(1, kind=99, d=1, folder="a"), request(2, o=1, folder="a"), request(2, o=1, folder="b"), request(2, folder="c")],
        tnc_trip=typed + plain + none,
    )
    hours = {r.folder: r for r in repositioning.repositioning_by_hour(t).collect()}
    assert (hours["a"].num_repositioned, hours["a"].num_successful) == (1, 1)
    assert (hours["b"].num_repositioned, hours["b"].num_successful) == (2, 0)  # target zone unknown without a request
    daily = {r.folder: r.asDict() for r in repositioning.repositioning_success_rate(t, params("a", "b", "c")).collect()}
    assert daily["a"]["success_rate"] == 1.0 and daily["b"]["success_rate"] == 0.0
    assert daily["c"]["num_repositioned"] == 0 and daily["c"]["success_rate"] == 0.0 and daily["c"]["average_routed_ttime_repo"] is None
    assert daily["c"]["average_vehicle_occupancy"] == pytest.approx(1.0) and daily["c"]["average_pickup_segment_distance"] is None


def test_tours_first_last_and_request_rows(tables):
    t = tables(tnc_request=[request(1, o=3, d=4), request(2, o=5, d=6)], tnc_trip=[move(1, None, 0, 0.0), move(2, 1, 2, 10.0), move(3, 2, 1, 20.0), move(4, None, 0, 30.0)])
    got = {r.sub_tour: r for r in repositioning.tours(t).collect()}
    assert (got[0].origin_zone, got[0].destination_zone, got[0].requests_served, got[0].pooled_tour) == (3, 6, 3, True)
    assert got[0].final_tour_id == "1_tour_1_sub_0" and got[1].service_type is None and not got[1].pooled_tour
    listed = [(r.sub_tour, r.request) for r in repositioning.tour_requests(t).orderBy("start_s").collect()]
    assert listed == [(0, None), (0, 1), (0, 2), (1, None)]


def test_zonal_results_without_zone(tables, params):
    t = tables(
        tnc_request=[request(1, loc=1), request(2, loc=1, vehicle=None), request(3, loc=99), request(4, loc=99, vehicle=None), request(5, loc=2, vehicle=None)],
        location=[("f", 1, 7, 0.0, 0.0), ("f", 2, 8, 0.0, 0.0)], zone=[("f", 7, 1), ("f", 8, 1)],
    )
    got = {r.zone: r for r in ridehail.fare_sensitivity_results_zonal(t, params("f")).collect()}
    assert set(got) == {7, None} and got[7].unserved_requests == 2.0 and got[None].unserved_requests is None and got[None].requests_served == 2.0


def test_household_rollup_and_walkable(tables):
    t = tables(
        person=[("f", 1, 1, 61, 0, 10.0, 0, 0, 0, False, 0), ("f", 2, 1, None, 0, 5.0, 0, 0, 0, False, 0), ("f", 3, 2, 60, 0, 1.0, 0, 0, 0, False, 0), ("f", 4, 9, 30, 0, 1.0, 0, 0, 0, False, 0)],
        household=[("f", 1, 1, 0.0, 2, 1, 1), ("f", 2, 2, 0.0, 1, 1, 1)],
        location=[("f", 1, 7, 0.0, 0.0), ("f", 2, 8, 450.9, 0.0)], transit_stops=[("f", 1, 0.0, 450.0), ("f", 2, 0.0, 451.0)],
    )
    homes = {r.household: r for r in demographics.household_rollup(t).collect()}
    assert set(homes) == {1, 2, None} and (homes[1].people_over_60, homes[1].people_under_60, homes[1].income) == (1, 0, 15.0)
    got = {r.zone: r for r in demographics.closest_stops(t).collect()}
    assert got[7].walkable == 1 and got[8].walkable == 0 and got[7]["count"] == 1 and got[7].total_income == 15.0


def test_ttests_against_suffix_and_named_base(frame):
    stats = frame(
        "folder string, Metric string, Sum double, Mean double, StdDev double, SampleSize double",
        ("gsc_300_nr_7", "fare", 60.0, 10.0, 2.0, 6.0), ("gsc_300_jar_7", "fare", 48.0, 8.0, 2.0, 6.0), ("gsc_900_jar_7", "fare", 48.0, 8.0, 2.0, 6.0),
        ("gsc_300_nr_7", "requests", 6.0, None, None, None), ("gsc_300_jar_7", "requests", 7.0, None, None, None),
        ("gsc_300_nr_7", "discount", 6.0, 1.0, 1.0, 6.0), ("gsc_300_jar_7", "discount", 12.0, 2.0, None, 1.0),
    )
    got = {(r.folder, r.metric): r for r in significance.tnc_ttests(stats, base_suffix="_nr").collect()}
    assert set(f for f, _ in got) == {"gsc_300_jar_7"}
    assert got["gsc_300_jar_7", "fare"]["t-statistic"] == pytest.approx(3**0.5) and got["gsc_300_jar_7", "fare"].value == 48.0
    assert got["gsc_300_jar_7", "requests"]["p-value"] is None and got["gsc_300_jar_7", "requests"].value == 7.0
    named = {(r.folder, r.metric) for r in significance.tnc_ttests(stats, base_cases=["gsc_300_jar_7"]).collect()}
    assert ("gsc_300_nr_7", "fare") in named and ("gsc_900_jar_7", "fare") in named and ("gsc_300_jar_7", "fare") not in named
    labelled = significance.with_significance(significance.tnc_ttests(stats, base_suffix="_nr"))
    assert one(significance.discount_percent(labelled))["value_significance"] == "25.0% "
    with pytest.raises(ValueError):
        significance.tnc_ttests(stats)


def test_shift_against_the_baseline_case(frame):
    combo = frame(
        "folder string, City string, `Fleet Size` string, Strategy string, Iteration string, `Bus AVO` double, `Bus Mass` double, `Bus Pool` double, `Bus Solo` double, `Bus Empty` double, "
        "`Bus Total` double, `Rideshare Pool` double, `Rideshare Solo` double, `Rideshare Empty` double, `Rideshare Total` double, SOV double, RAIL bigint, BICYCLE double, WALK double, "
        "Positive double, Neutral double, Negative double, `Vehicular Trips` double, `Rideshare Replaceable Bus Trips` double, `Total Trips` double, `Bus Mass Share` double, "
        "`Rideshare Replaceable Bus Share` double, `SOV Share` double, `Rideshare Share` double",
        *[(f"gsc_300_{s}_7", "gsc", "300", name, "7", *[1.0] * 10, *[1.0], 1, 1.0, 1.0, pos, 2.0, neg, 4.0, 1.0, 9.0, 0.5, 0.1, share, 0.2)
          for s, name, pos, neg, share in (("heur", "Heuristic", 10.0, 0.0, 0.4), ("pro", "Proactive", 12.0, 5.0, 0.3))],
    )
    got = {r.folder: r.asDict() for r in modes.mode_combo_shift(combo, "cnt").collect()}
    new, base = got["gsc_300_pro_7"], got["gsc_300_heur_7"]
    assert new["Positive Shift Heur"] == pytest.approx(0.2) and new["Negative Shift Heur"] is None and new["SOV Share Increase"] == pytest.approx(-0.1)
    assert base["Positive Shift Heur"] is None and base["Positive Shift Avg"] == 0.0 and base["heuristic SOV Share"] is None
    reg = modes.positive_shift_reg(modes.mode_combo_shift(combo, "cnt")).collect()
    assert {r["Fleet Size"] for r in reg} == {300.0}


def test_registry_accepts_functions_and_sql(tables, params):
    t = tables(tnc_request=[request(1), request(2)], tnc_trip=[move(1, 1, 2)])
    registry = default_registry()
    registry.register_sql("doubled", "SELECT folder, sum(n) * 2 AS n FROM {counted} GROUP BY folder", ["counted"])
    registry.register_sql("counted", "SELECT folder, count(*) AS n FROM {tnc_request} GROUP BY folder", ["tnc_request"], helper=True)
    registry.register("mine", lambda t, p: t["tnc_trip"].groupBy("folder").count())
    out = registry.build(t, params("f"), ["doubled", "counted", "mine", "pr_avo"])
    assert one(out["doubled"])["n"] == 4 and one(out["mine"])["count"] == 1 and set(out) == {"doubled", "counted", "mine", "pr_avo"}
    assert len(registry.names()) == 26


def test_case_columns_survive_into_dashboard_tables(frame):
    elder = naming.add_city_fleet_weight(frame(
        "folder string, zone bigint, mode string, type string, age_class int, vehicles bigint, trip_count bigint, household_count bigint, total_travel_distance_miles double, total_ttime_mins double, hh_inc_total double",
        ("gsc_300_nr_7", 1, "SOV", "WORK", 2, 1, 2, 2, 10.0, 20.0, 200000.0), ("gsc_300_nr_7", 1, "FAIL_REROUTE", "WORK", 2, 1, 1, 2, 1.0, 2.0, 100000.0),
        ("gsc_300_nr_7", 1, "BUS", "WORK", 1, 1, 2, 2, 10.0, 20.0, 9.0), ("gsc_300_nr_7", None, "SOV", "WORK", 2, 1, 2, 2, 10.0, 20.0, 9.0)))
    assert one(demographics.zone_income_check(elder))["avg_hh_inc"] == pytest.approx(75000.0)
    assert one(demographics.mode_data(elder))["avg_hh_inc"] == pytest.approx(75000.0)  # failed trips count for income only
    assert one(demographics.hh_inc_map(elder))["HH Inc Quartile"] == "4- >75%"
    wide = one(demographics.zone_mode_proportions(elder))
    assert wide["SOV_Travel Time"] == 20.0 and wide["BUS_Trips"] is None
    activity = naming.add_city_fleet_weight(frame("folder string, activity_type string, age_class int, zone bigint, activity_duration double", ("gsc_300_nr_7", "WORK", 2, 1, 100.0), ("gsc_300_nr_7", "HOME", 2, 1, 100.0)))
    usage = one(demographics.demo_activity_time_usage(activity, elder))
    assert usage["SOV Time Budget"] == pytest.approx(0.8) and usage["SOV Time Budget Level"] == "2" and usage["Bus Time Budget Level"] == "No Data"


def test_reports_read_reports_in_any_order(tables, params, spark):
    t = tables() | {"tnc_request": spark.createDataFrame([("f", 1), ("f", 2), ("g", 3)], "folder string, tnc_request_id long")}
    registry = Registry()
    registry.register_sql("third", "SELECT folder, n + 1 AS n FROM {second}")
    registry.register_sql("second", "SELECT folder, n * 10 AS n, '{{x}}' AS x FROM {first} JOIN {case_params} USING (folder)")
    built = []
    registry.register("first", lambda t, p: built.append(1) or t["tnc_request"].groupBy("folder").agg(F.count("*").alias("n")))
    registry.register("also", lambda t, p: t["first"].select("folder"), needs=["first"])
    assert registry.ordered() == ["first", "second", "third", "also"] and registry.helpers_of("third") == ["second"]
    out = registry.build(t, params("f", "g"))
    assert sorted((r.folder, r.n) for r in out["third"].collect()) == [("f", 21), ("g", 11)] and len(built) == 1
    assert out["second"].first().x == "{x}"
    # a report that isn't chosen is built for the one that reads it, a stored one is read
    assert sorted(r.n for r in registry.build(t, params("f", "g"), ["third"])["third"].collect()) == [11, 21]
    stored = ChainMap({"second": spark.createDataFrame([("f", 7)], "folder string, n long")}, t)
    assert [r.n for r in registry.build(stored, params("f"), ["third"])["third"].collect()] == [8]


def test_reports_that_depend_on_each_other_raise(tables, params):
    registry = Registry()
    registry.register_sql("a", "SELECT * FROM {b}")
    registry.register_sql("b", "SELECT * FROM {c}")
    registry.register_sql("c", "SELECT * FROM {a}")
    with pytest.raises(ValueError, match="a -> b -> c -> a"):
        registry.ordered()
    hidden = Registry()
    hidden.register("x", lambda t, p: t["y"])
    hidden.register("y", lambda t, p: t["x"])
    with pytest.raises(ValueError, match="depend on each other"):
        hidden.build(tables(), params("f"), ["x"])
    with pytest.raises(ValueError, match="no name"):
        registry.register_sql("bad", "SELECT {0}")


def test_a_run_recomputes_changed_cases_only_and_leaves_out_bad_ones(tables, params, spark, tmp_path, monkeypatch):
    store, calls = ReportStore(spark, str(tmp_path)), []

    def counted(t, p):
        trips = t["tnc_trip"].groupBy("folder").agg(F.sum("passengers").alias("n"))
        return trips.join(t["base"], "folder")

    def base(t, p):
        calls.append(sorted(r.folder for r in p.collect()))
        return t["trip"].groupBy("folder").agg(F.count("*").alias("trips"))

    registry = Registry([Report("counted", counted, needs=("base",)), Report("base", base)])

    def run(extra=(), **options):
        t = tables(
            tnc_request=[request(1), request(2, kind=99), request(3, folder="g")],
            tnc_trip=[move(1, 1, 2), move(2, 2, 3), move(3, 3, 4, folder="g")])
        t["trip"] = spark.createDataFrame([("f", 1), ("g", 2), *extra], "folder string, trip_id long")
        calls.clear()
        out = run_reports(t, params("f", "g"), store, ["counted"], registry, **options)
        return sorted((r.folder, r.n, r.trips) for r in out["counted"].collect())

    assert run() == [("f", 2, 1), ("g", 4, 1)] and sorted(store.read("base").columns) == ["folder", "trips"]
    run()
    assert all(c == ["f", "g"] for c in calls)  # looked at for what it reads, not computed
    before = store.versions("base"), store.versions("counted")
    assert run() == [("f", 2, 1), ("g", 4, 1)] and (store.versions("base"), store.versions("counted")) == before
    assert run([("g", 3)]) == [("f", 2, 1), ("g", 4, 2)] and ["g"] in calls and store.versions("counted") != before[1]

    # a repair that misses a row of one case
    from mobspark import analysis

    def flawed(t):
        return repair.flagged_trips(t).withColumn(repair.LEFT_OVER, F.col("folder") == "g")

    monkeypatch.setattr(analysis, "flagged_trips", flawed)
    with pytest.raises(ValueError, match="1 cases, of which the first is g"):
        run([("f", 9), ("g", 4)], force=True)
    assert run([("f", 8), ("f", 9)], force=True, skip_bad=True) == [("f", 2, 3), ("g", 4, 2)]


def test_homes_without_a_stop_in_reach_stay_in_the_counts(tables):
    homes = dict(
        person=[("f", 1, 1, 70, None, 10.0, 0, 0, 0, False, 0), ("g", 2, 2, 30, None, 20.0, 0, 0, 0, False, 0), ("f", 3, 3, 70, None, 5.0, 0, 0, 0, False, 0)],
        household=[("f", 1, 1, 10.0, 1, 1, 1), ("g", 2, 2, 20.0, 1, 1, 1), ("f", 3, 3, 5.0, 1, 1, 1)],
        location=[("f", 1, 9, 0.0, 0.0), ("g", 2, 9, 0.0, 0.0), ("f", 3, 9, None, None)])
    t = tables(**homes, transit_stops=[("f", 1, 0.0, 100.0)])
    got = sorted((r.folder, r.walkable, r["count"], r.total_income) for r in demographics.closest_stops(t).collect())
    assert got == [("f", 0, 1, 5.0), ("f", 1, 1, 10.0), ("g", 0, 1, 20.0)]
    none = tables(**homes)
    assert {r.walkable for r in demographics.closest_stops(none).collect()} == {0}


GROWING = {"person", "household", "trip_id", "_key", "x", "cx", "pcx"}  # keys of tables that grow with the data


def broadcast_keys(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    joined = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    return {key.split("#")[0] for line in joined for key in line.split("[", 1)[1].split("]", 1)[0].split(", ")}


def test_tables_that_grow_with_the_data_are_not_broadcast(spark, tables, params, tmp_path):
    """However small their estimates are, as those of these files."""
    for name, df in tables().items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}")
    t, p = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in SCHEMAS}, params("f")
    reports = {
        "elder_demo": demographics.elder_demo(t), "activity_times": demographics.activity_times(t),
        "household_rollup": demographics.household_rollup(t), "closest_stops": demographics.closest_stops(t),
        "requests": ridehail.requests_report(t, p), "tnc_skim_demo": ridehail.tnc_skim_demo(t, p),
        "vehicle_ownership": ridehail.vehicle_ownership_stats(t), "demographic_tnc_stats": ridehail.demographic_tnc_stats(t, p),
        "distance": modes.mode_distribution_distance(t, p), "counts": modes.mode_distribution_counts(t, p),
        "zones": modes.mode_distribution_zones(t, p), "finance": finance.demo_financial_case_data(t, p),
    }
    assert {name: keys for name, df in reports.items() if (keys := broadcast_keys(df) & GROWING)} == {}
