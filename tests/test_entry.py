"""The driver contract, side by side with the oracle on the smallest data, and cross-report invariants."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import compare, connect
from mobspark.analysis import run_dashboard, run_reports
from mobspark.plans import repositioning, ridehail, transit
from mobspark.sources.catalog import zone_master
from mobspark.sources.driver_tables import DriverTables
from mobspark.sources.store import ReportStore

SF = "/root/testdata/sf0.001"
CHECKED = [
    "latest_iteration", "case_params", "strategy_params", "parse_case_name_b", "nearest_stop", "skim_lookup", "next_service_trip",
    "sub_tours", "capped_histogram", "ttest_from_stats", "conditional_update", "dq_guard", "transit_trip_max_load",
    "mode_Distribution_ADULT_Distance", "bus_avo", "fare_sensitivity_results", "fare_sensitivity_results_zonal", "tnc_results_discount",
    "tnc_stat_summary", "closest_stops", "tnc_skim_demo", "tours", "repositioning_success_rate", "tnc_ttests_w_significance",
    "trip_avo_histogram_vals", "mode_cnt_combo_proactive", "demo_activity_time_usage_df", "vehicle_ownership_df",
    "combined_financial_cases_df", "demo_financial_case_data_df",
]


@pytest.fixture(scope="module")
def oracles():
    return entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle(oracles):
    # operators of training-data preparation, where installed, bring SQL where it can express them and tests elsewhere
    own = {name for name in entry.queries() if not re.match(r"op\d+_|pipeline$", name)}
    assert own <= set(oracles) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 4


@pytest.mark.parametrize("name", CHECKED)
def test_matches_oracle(spark, oracles, duck, name):
    df = entry.queries()[name](spark, SF)
    cursor = duck.execute(oracles[name])
    assert compare(df.collect(), df.columns, cursor.fetchall(), [d[0] for d in cursor.description]) == []


def test_no_cartesian_products(spark):
    for name in ("nearest_stop", "requests", "repositioning_success_rate", "demo_zone_summary_tnc"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_scans_read_only_needed_columns(spark):
    plan = entry.queries()["bus_avo"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double>" in plan


def test_invariants(spark):
    t = DriverTables(spark, SF)
    params = t["case_params"]
    m = {r.folder: r.trip_multiplier for r in params.collect()}
    trips = {r.folder: r["count"] for r in t["tnc_trip"].groupBy("folder").count().collect()}
    for r in ridehail.pr_avo(t, params).collect():
        assert r.cnt_pool + r.cnt_solo + r.cnt_empt == trips[r.folder] * m[r.folder]
    links = {r.folder: r["count"] for r in t["transit_vehicle_links"].groupBy("folder").count().collect()}
    for r in transit.bus_avo(t, params).collect():  # loads are whole numbers, so the classes are complete
        assert r.cnt_mass + r.cnt_pool + r.cnt_solo + r.cnt_empt == links[r.folder]
    hourly = repositioning.repositioning_by_hour(t).groupBy("folder").agg(F.sum("num_repositioned").alias("n"), F.sum("num_successful").alias("s"))
    daily = {r.folder: (r.num_repositioned, r.num_successful) for r in repositioning.repositioning_success_rate(t, params).collect()}
    assert {r.folder: (r.n, r.s) for r in hourly.collect()}.items() <= daily.items()
    legs = repositioning.tours(t).agg(F.sum("requests_served")).first()[0]
    assert legs == t["tnc_trip"].count() == repositioning.tour_requests(t).count()


def test_reports_and_dashboard_end_to_end(spark, tmp_path):
    t = DriverTables(spark, SF)
    store = ReportStore(spark, str(tmp_path))
    names = [
        "transit_trip_max_load_helper", "bus_avo", "pr_avo", "mode_Distribution_ADULT_Distance", "mode_Distribution_ADULT_Counts", "elder_demo",
        "tnc_skim_demo", "closest_stops", "tnc_stat_summary", "activity_times", "fare_sensitivity_results_vo", "demo_financial_case_data",
        "fare_sensitivity_demograpic_tnc_stats", "requests_sum", "tnc_results_discount", "fare_sensitivity_results",
    ]
    reports = run_reports(t, t["case_params"], store, names)
    assert set(reports) == set(names) and reports["pr_avo"].count() == 4
    tables = run_dashboard(reports, zone_master(t["zone"]), store, baseline=["nr_0"], treatment=None, base_suffix="_nr")
    assert len(tables) == 30
    assert {r.folder for r in tables["mode_dist_combo_proactive"].select("folder").collect()} == {r.folder for r in t["case_params"].collect()}
    assert tables["tnc_ttests_w_significance"].count() == 32 and tables["trip_avo_histogram_vals"].count() > 0
