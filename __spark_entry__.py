
from __future__ import annotations

import os
import sys
from collections import ChainMap
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from mobspark.functions import exprs, naming, stats  # noqa: E402
from mobspark.operators import asof, compare, joins, moments, nearest, shape, skim_tiles, tours  # noqa: E402
from mobspark.plans import demographics as demo  # noqa: E402
from mobspark.plans import finance, modes, repair, repositioning, ridehail, significance, transit  # noqa: E402
from mobspark.sources import catalog, scenario  # noqa: E402
from mobspark.sources.driver_tables import DriverTables  # noqa: E402

BASE_SUFFIX = "_nr"
BASELINE_STRATEGY = "nr"
BASELINE = ["nr_0"]  # strategy label of the base cases under the fleet-weight naming scheme


class _Run:
    """Tables, parameters and shared report frames for one query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.t = DriverTables(spark, sf_dir)
        self.params = self.t["case_params"]

    def cased(self, report: DataFrame) -> DataFrame:
        return naming.add_city_fleet_weight(report)

    # reports with case columns, as the dashboard tables read them
    def loads(self) -> DataFrame:
        return self.cased(transit.transit_trip_max_load_helper(self.t, self.params))

    def elder(self) -> DataFrame:
        return self.cased(demo.elder_demo(self.t))

    def skim_demo(self) -> DataFrame:
        return self.cased(ridehail.tnc_skim_demo(self.t, self.params))

    def stops(self) -> DataFrame:
        return self.cased(demo.closest_stops(self.t))

    def zones(self) -> DataFrame:
        return catalog.zone_master(self.t["zone"])

    def finance(self) -> DataFrame:
        return self.cased(finance.demo_financial_case_data(self.t, self.params))

    def combo(self, measure: str) -> DataFrame:
        source = {"dist": modes.mode_distribution_distance, "cnt": modes.mode_distribution_counts}[measure]
        return self.cased(modes.mode_combo(
            transit.bus_avo(self.t, self.params), ridehail.pr_avo(self.t, self.params), source(self.t, self.params), measure
        ))

    def shifted(self, measure: str) -> DataFrame:
        return modes.mode_combo_shift(self.combo(measure), measure, BASELINE, None)

    def summary(self) -> DataFrame:
        return ridehail.tnc_stat_summary(self.t, self.params)

    def labelled(self) -> DataFrame:
        return significance.with_significance(significance.tnc_ttests(self.summary(), base_suffix=BASE_SUFFIX))


def _nearest_stop(r: _Run) -> DataFrame:
    places = r.t["location"]
    hits = nearest.nearest_stop(places, r.t["transit_stops"])
    return joins.join_by_shuffle(places, hits, ["folder", "x", "y"]).select("folder", "location", "stop_id", "distance")


def _skim_lookup(r: _Run) -> DataFrame:
    requests = r.t["tnc_request"].select("folder", "tnc_request_id", "request_time", "origin_zone", "destination_zone")
    return asof.skim_lookup(requests, r.t["skim"]).drop("request_time")


def _skim_lookup_tiled(r: _Run) -> DataFrame:
    requests = r.t["tnc_request"].select("folder", "tnc_request_id", "request_time", "origin_zone", "destination_zone")
    return skim_tiles.tiled_lookup(requests, skim_tiles.tile_skim(r.t["skim"], 16), side=16).drop("request_time")


def _requests_tiled(r: _Run) -> DataFrame:
    tiled = ChainMap({"skim_tiles": skim_tiles.tile_skim(r.t["skim"])}, r.t)
    return ridehail.requests_report(tiled, r.params)


def _dq_guard(r: _Run) -> DataFrame:
    """The guard on the tables as they come, and on the repaired ones."""
    raw, repaired = repair.repair_check(r.t), repair.repair_check(repair.repaired_tables(r.t))
    return raw.withColumn("tables", F.lit("raw")).unionByName(repaired.withColumn("tables", F.lit("repaired")))


def _sub_tours(r: _Run) -> DataFrame:
    return tours.add_sub_tours(r.t["tnc_trip"]).select("folder", "tnc_trip_id_int", "vehicle", "tour", "sub_tour")


def _describe_long(r: _Run) -> DataFrame:
    requests = r.t["tnc_request"].withColumn("wait", F.col("pickup_time") - F.col("request_time"))
    return shape.describe_long(
        requests, ["folder", "service_type"], ["wait", "fare", "party_size"], F.col("assigned_vehicle").isNotNull(),
        {"rows": F.count(F.lit(1))},
    )


def _describe_merged(r: _Run) -> DataFrame:
    """``describe_long`` by way of states for each hour and vehicle class, merged in two steps."""
    requests = r.t["tnc_request"].withColumns({
        "wait": F.col("pickup_time") - F.col("request_time"), "hour": F.floor(F.col("request_time") / 3600),
        "class": F.col("tnc_request_id") % 7})
    states = moments.moment_states(
        requests, ["folder", "service_type", "hour", "class"], ["wait", "fare", "party_size"], F.col("assigned_vehicle").isNotNull())
    hourly = moments.merge_states(states, ["folder", "service_type", "hour"])
    return moments.describe_states(moments.merge_states(hourly, ["folder", "service_type"]))


def _mode_names_all(r: _Run) -> DataFrame:
    """Orders by every mode code there is, and some that are none."""
    code = F.expr("CASE o_orderkey % 5 WHEN 0 THEN o_orderkey % 43 WHEN 4 THEN 9990 + o_orderkey % 13 ELSE 990 + o_orderkey % 37 END")
    return r.t.raw("orders").select(code.alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n")).select(
        "code", exprs.mode_name("code").alias("mode_name"), "n")


def _capped_histogram(r: _Run) -> DataFrame:
    requests = r.t["tnc_request"].withColumn("distance", F.col("distance") / 5)
    return shape.capped_histogram(requests, ["folder", "service_type"], "distance")


def _pivot_expected(r: _Run) -> DataFrame:
    return shape.pivot_expected(
        r.t["activity"], ["folder", "type"], "mode", ["SOV", "BUS", "RAIL", "TAXI", "WALK", "HOVERCRAFT"], "duration"
    )


def _melt_pivot(r: _Run) -> DataFrame:
    trips = r.t["tnc_trip"].groupBy("folder", "init_status").agg(
        F.sum("travel_distance").alias("metres"), F.sum("routed_travel_time").alias("routed"), F.count("passengers").alias("legs")
    )
    return shape.melt(trips, ["folder", "init_status"], ["metres", "routed", "legs"])


def _baseline_shift(r: _Run) -> DataFrame:
    totals = r.cased(r.t["trip"].groupBy("folder").agg(F.sum("travel_distance").alias("metres"), F.count(F.lit(1)).alias("trips")))
    pairs = compare.with_baseline(totals, ["City", "Fleet Size"], "Strategy", BASELINE, ["metres", "trips"], prefix="base ")
    return pairs.where(~F.col("Strategy").isin(*BASELINE)).select(
        "folder", "City", "Fleet Size", "Strategy", compare.shift("metres", "base metres").alias("metres shift"),
        compare.shift("trips", "base trips").alias("trips shift"))


def _ttest_from_stats(r: _Run) -> DataFrame:
    """t statistic and p-value of each nation's order prices per status against status 'F'."""
    orders = r.t.raw("orders").join(
        r.t.raw("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey"
    )
    s = orders.groupBy("c_nationkey", "o_orderstatus").agg(
        F.avg("o_totalprice").alias("m"), F.stddev_samp("o_totalprice").alias("sd"), F.count(F.lit(1)).alias("n")
    )
    base = s.where("o_orderstatus = 'F'").select("c_nationkey", *[F.col(c).alias(f"b_{c}") for c in ("m", "sd", "n")])
    t, df = stats.pooled_t(F.col("b_m"), F.col("b_sd"), F.col("b_n"), F.col("m"), F.col("sd"), F.col("n"))
    pairs = s.where("o_orderstatus <> 'F'").join(base, "c_nationkey").select(
        "c_nationkey", "o_orderstatus", t.alias("t_statistic"), df.alias("df")
    )
    return pairs.withColumn("p_value", stats.t_p_value("t_statistic", "df"))


def _missing_cases(r: _Run) -> DataFrame:
    """Cases discovered among the run directories without a stored result from a finished run."""
    latest = catalog.latest_iteration(r.t["run_dirs"])
    stored = latest.select(F.concat_ws("_", "case_name", F.col("iteration").cast("string")).alias("folder"))
    return catalog.missing_cases(r.t["run_dirs"], stored)


def _pending_cases(r: _Run) -> DataFrame:
    """Case labels of customers without a completed order."""
    all_cases = r.t.raw("customer").select(F.concat(F.lit("case_"), "c_custkey").alias("folder"))
    stored = r.t.raw("orders").where("o_orderstatus = 'F'").select(F.concat(F.lit("case_"), "o_custkey").alias("folder"))
    return catalog.pending_cases(all_cases, stored)


_QUERIES: dict[str, Callable[[_Run], DataFrame]] = {
    # sources and catalogue
    "latest_iteration": lambda r: catalog.latest_iteration(r.t["run_dirs"]),
    "latest_iteration_any": lambda r: catalog.latest_iteration(r.t["run_dirs"], finished_only=False),
    "case_folders": lambda r: scenario.case_folders(catalog.latest_iteration(r.t["run_dirs"])),
    "missing_cases": _missing_cases,
    "pending_cases": _pending_cases,
    "case_params": lambda r: scenario.case_params(r.t["model_files"]),
    "pricing_params": lambda r: scenario.pricing_params(r.t["model_files"]),
    "strategy_params": lambda r: scenario.strategy_params(r.t["model_files"]),
    "pooling_discount": lambda r: scenario.pooling_discount(r.t["model_files"]),
    "repositioning_interval": lambda r: scenario.repositioning_interval(r.t["model_files"]),
    "config_audit": lambda r: scenario.config_audit(
        r.t["model_files"], ["Operator_1", "Fleet_Base", "Operator_1_TNC_FLEET_SIZE"], scenario.FLEET_FILES),
    "config_differences": lambda r: scenario.config_differences(r.t["model_files"]),
    "skim_periods": lambda r: asof.skim_periods(r.t["skim"]).select(
        "folder", F.posexplode("periods").alias("position", "period")),
    "mode_names": lambda r: modes.trips_by_mode_name(r.t),
    "mode_names_all": _mode_names_all,
    "zone_master": lambda r: r.zones(),
    "parse_case_name_a": lambda r: naming.add_city_case_iteration(r.t["case_labels"]),
    "parse_case_name_b": lambda r: naming.add_city_fleet_weight(r.t["case_labels"]),
    "parse_case_name_c": lambda r: naming.add_city_fleet_strategy(r.t["case_labels"]),
    # operators
    "nearest_stop": _nearest_stop,
    "skim_lookup": _skim_lookup,
    "skim_lookup_tiled": _skim_lookup_tiled,
    "requests_tiled": _requests_tiled,
    "next_service_trip": lambda r: repositioning.next_service_trips(r.t),
    "sub_tours": _sub_tours,
    "describe_long": _describe_long,
    "describe_merged": _describe_merged,
    "capped_histogram": _capped_histogram,
    "pivot_expected": _pivot_expected,
    "melt_pivot": _melt_pivot,
    "baseline_shift": _baseline_shift,
    "ttest_from_stats": _ttest_from_stats,
    "conditional_update": lambda r: repair.repaired_trips(r.t).select(
        "folder", "tnc_trip_id_int", "request", "vehicle", "passengers"),
    "conditional_update_requests": lambda r: repair.repaired_requests(r.t).select(
        "folder", "tnc_request_id", "service_type", "party_size"),
    "dq_guard": lambda r: _dq_guard(r),
    # per-case reports
    "transit_trip_max_load_helper": lambda r: transit.transit_trip_max_load_helper(r.t, r.params),
    "transit_trip_max_load": lambda r: transit.transit_trip_max_load(r.t, r.params),
    "mode_Distribution_ADULT_Counts": lambda r: modes.mode_distribution_counts(r.t, r.params),
    "mode_Distribution_ADULT_Distance": lambda r: modes.mode_distribution_distance(r.t, r.params),
    "mode_Distribution_ADULT": lambda r: modes.mode_distribution_zones(r.t, r.params),
    "bus_avo": lambda r: transit.bus_avo(r.t, r.params),
    "pr_avo": lambda r: ridehail.pr_avo(r.t, r.params),
    "fare_sensitivity_results": lambda r: ridehail.fare_sensitivity_results(r.t, r.params),
    "distance_tnc_dist": lambda r: ridehail.distance_tnc_dist(r.t, r.params),
    "fare_sensitivity_results_zonal": lambda r: ridehail.fare_sensitivity_results_zonal(r.t, r.params),
    "fare_sensitivity_demograpic_tnc_stats": lambda r: ridehail.demographic_tnc_stats(r.t, r.params),
    "fare_sensitivity_results_vo": lambda r: ridehail.vehicle_ownership_stats(r.t),
    "tnc_results_discount": lambda r: ridehail.tnc_results_discount(r.t, r.params),
    "elder_demo": lambda r: demo.elder_demo(r.t),
    "tnc_stat_summary_helper": lambda r: ridehail.tnc_stat_summary_helper(r.t, r.params),
    "activity_times": lambda r: demo.activity_times(r.t),
    "closest_stops": lambda r: demo.closest_stops(r.t),
    "requests": lambda r: ridehail.requests_report(r.t, r.params),
    "requests_last_period": lambda r: ridehail.requests_sum(r.t, r.params, mode="last"),
    "requests_sum": lambda r: ridehail.requests_sum(r.t, r.params),
    "tnc_skim_demo": lambda r: ridehail.tnc_skim_demo(r.t, r.params),
    "tnc_stat_summary": lambda r: r.summary(),
    "demo_financial_case_data": lambda r: finance.demo_financial_case_data(r.t, r.params),
    "tours": lambda r: repositioning.tours(r.t),
    "tour_requests": lambda r: repositioning.tour_requests(r.t),
    "repositioning_by_hour": lambda r: repositioning.repositioning_by_hour(r.t),
    "repositioning_success_rate": lambda r: repositioning.repositioning_success_rate(r.t, r.params),
    "request_summary": lambda r: ridehail.request_summary(r.t, r.params),
    "household_rollup": lambda r: demo.household_rollup(r.t),
    # cross-case tables
    "tnc_ttests": lambda r: significance.tnc_ttests(r.summary(), base_suffix=BASE_SUFFIX),
    "tnc_ttests_base_cases": lambda r: significance.tnc_ttests(r.summary(), base_cases=["gsc_300_jar_7", "atx_500_nr_3"]),
    "strategy_summary": lambda r: significance.strategy_summary(r.summary()),
    "strategy_ttests": lambda r: significance.strategy_ttests(r.summary(), BASELINE_STRATEGY),
    "pattern_avg_avo": lambda r: transit.avg_avo(r.loads(), "pattern"),
    "trip_avg_avo": lambda r: transit.avg_avo(r.loads(), "trip"),
    "pattern_replaceable_cases": lambda r: transit.replaceable_cases(r.loads(), "pattern"),
    "trip_replaceable_cases": lambda r: transit.replaceable_cases(r.loads(), "trip"),
    "transit_pattern_avo_cases_vals": lambda r: transit.avo_cases(r.loads(), "pattern"),
    "transit_trip_avo_cases_vals": lambda r: transit.avo_cases(r.loads(), "trip"),
    "pattern_avo_histogram_vals": lambda r: transit.avo_histogram(r.loads(), "pattern"),
    "trip_avo_histogram_vals": lambda r: transit.avo_histogram(r.loads(), "trip"),
    "mode_pivot": lambda r: modes.mode_pivot(modes.mode_distribution_counts(r.t, r.params)),
    "mode_dist_combo": lambda r: r.combo("dist"),
    "mode_cnt_combo": lambda r: r.combo("cnt"),
    "mode_dist_combo_proactive": lambda r: r.shifted("dist"),
    "mode_cnt_combo_proactive": lambda r: r.shifted("cnt"),
    "positive_shift_reg": lambda r: modes.positive_shift_reg(r.shifted("dist")),
    "zone_data": lambda r: demo.zone_data(r.elder()),
    "zone_income_check": lambda r: demo.zone_income_check(r.elder()),
    "mode_data": lambda r: demo.mode_data(r.elder()),
    "hh_inc_map_df": lambda r: demo.hh_inc_map(r.elder()),
    "hh_inc_map_gsc": lambda r: demo.hh_inc_map(r.elder()).where("City = 'gsc'"),
    "hh_inc_map_atx": lambda r: demo.hh_inc_map(r.elder()).where("City = 'atx'"),
    "demo_agg_mode_data_df": lambda r: demo.demo_agg_mode_data(r.elder()),
    "tnc_request_demo": lambda r: demo.tnc_request_demo(r.skim_demo()),
    "tnc_request_demo_agg": lambda r: demo.tnc_request_demo_agg(r.skim_demo()),
    "demo_zone_summary_tnc": lambda r: demo.demo_zone_summary_tnc(r.zones(), r.elder(), r.skim_demo()),
    "demo_agg_tnc_case_df": lambda r: demo.demo_agg_tnc_case(r.zones(), r.elder(), r.skim_demo()),
    "zone_mode_proportions": lambda r: demo.zone_mode_proportions(r.elder()),
    "demo_activity_time_usage_df": lambda r: demo.demo_activity_time_usage(r.cased(demo.activity_times(r.t)), r.elder()),
    "closest_stops_by_zone": lambda r: demo.closest_stops_by_zone(r.stops()),
    "closest_stops_helper": lambda r: demo.closest_stops_helper(r.stops()),
    "hh_inc_hist_df": lambda r: demo.hh_inc_hist(r.elder(), r.stops()),
    "hh_inc_pivot": lambda r: demo.hh_inc_pivot(r.elder()),
    "vehicle_ownership_df": lambda r: demo.vehicle_ownership(r.cased(ridehail.vehicle_ownership_stats(r.t)), r.elder()),
    "financial_case_data_df": lambda r: finance.financial_case_data(r.finance()),
    "case_1_a": lambda r: finance.case_1_a(finance.financial_case_data(r.finance())),
    "case_1_b": lambda r: finance.case_1_b(finance.financial_case_data(r.finance())),
    "case_2": lambda r: finance.case_2(finance.financial_case_data(r.finance())),
    "case_3": lambda r: finance.case_3(finance.financial_case_data(r.finance())),
    "combined_financial_cases_df": lambda r: finance.combined_financial_cases(finance.financial_case_data(r.finance())),
    "demo_financial_case_data_df": lambda r: finance.senior_cost_by_zone(
        r.cased(ridehail.demographic_tnc_stats(r.t, r.params)), r.finance()),
    "tnc_ttests_w_significance": lambda r: r.labelled(),
    "discount_perc_unit_fix": lambda r: significance.discount_percent(r.labelled()),
    "rejected_request_rate_unit_fix": lambda r: significance.rejected_request_rate(r.labelled()),
    "pooling_rate_unit_fix": lambda r: significance.pooling_rate(r.labelled()),
    "evmt_unit_fix": lambda r: significance.empty_mileage_share(r.labelled()),
}

def _comparable(c: Column) -> Column:
    """Round away the last bits, in which sums and means of two engines differ.

    Six decimals up to 1e5, fewer beyond (a double has 15 to 16 digits). The small offset keeps exact
    ties, which means of decimal amounts often are, on one side. The oracle SQL does the same.
    """
    return (
        F.when(F.abs(c) < 1e5, F.round(c + 3e-8, 6)).when(F.abs(c) < 1e9, F.round(c + 3e-4, 2)).otherwise(F.round(c + 0.03, 0))
    )


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[_comparable(F.col(f"`{c}`")).alias(c) if kind == "double" else F.col(f"`{c}`") for c, kind in df.dtypes])


def entry(spark: SparkSession) -> DataFrame:
    """Pooled, solo and empty ride-hail trips and miles per case."""
    return queries()["pr_avo"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[_Run], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: _rounded(build(_Run(spark, sf_dir)))

    return {name: bind(build) for name, build in _QUERIES.items()} | _llm()[0]


def oracle_sql() -> dict[str, str]:
    from checks.oracle import statements

    return statements() | _llm()[1]


def _llm() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the training-data operators and their pipeline, where those are installed."""
    try:
        import corpus_pipeline
        from mobspark.llm import registered
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "mobspark.llm"):
            raise
        return {}, {}
    pipeline_sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return registered.queries() | {"pipeline": corpus_pipeline.run}, registered.oracle_sql() | pipeline_sql
