"""All cross-case tables from the stored per-case reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobspark.functions.naming import add_city_fleet_weight
from mobspark.plans import demographics, finance, modes, significance, transit


def dashboard_tables(
    reports: Mapping[str, DataFrame], zones: DataFrame, *, parser: Callable[[DataFrame], DataFrame] = add_city_fleet_weight,
    baseline: Sequence[str] = ("Heuristic",), treatment: Sequence[str] | None = ("Proactive",),
    base_cases: Sequence[str] | None = None, base_suffix: str | None = None, cities: Sequence[str] = ("gsc", "atx"),
) -> dict[str, DataFrame]:
    """The published tables by name.

    ``reports`` are read back from the store, so no table repeats the work of another. ``parser`` adds
    the case columns of the naming scheme in use; ``baseline`` and ``treatment`` are strategy labels
    under that scheme (``treatment=None``: every other strategy); ``zones`` is the zone master.
    """
    def cased(name: str) -> DataFrame:
        return parser(reports[name])

    loads, elder, skim, stops = (
        cased(n) for n in ("transit_trip_max_load_helper", "elder_demo", "tnc_skim_demo", "closest_stops"))
    bus, ridehail = reports["bus_avo"], reports["pr_avo"]
    combos = {
        "dist": parser(modes.mode_combo(bus, ridehail, reports["mode_Distribution_ADULT_Distance"], "dist")),
        "cnt": parser(modes.mode_combo(bus, ridehail, reports["mode_Distribution_ADULT_Counts"], "cnt")),
    }
    shifts = {m: modes.mode_combo_shift(c, m, baseline, treatment) for m, c in combos.items()}
    income = demographics.hh_inc_map(elder)
    money = cased("demo_financial_case_data")
    case_money = finance.financial_case_data(money)
    labelled = significance.with_significance(
        significance.tnc_ttests(reports["tnc_stat_summary"], base_cases, base_suffix))
    demographic = cased("fare_sensitivity_demograpic_tnc_stats")
    return {
        "trip_avo_histogram_vals": transit.avo_histogram(loads, "trip"),
        "pattern_avo_histogram_vals": transit.avo_histogram(loads, "pattern"),
        "transit_pattern_avo_cases_vals": transit.avo_cases(loads, "pattern"),
        "transit_trip_avo_cases_vals": transit.avo_cases(loads, "trip"),
        "mode_dist_combo": combos["dist"], "mode_cnt_combo": combos["cnt"],
        "mode_dist_combo_proactive": shifts["dist"], "mode_cnt_combo_proactive": shifts["cnt"],
        "positive_shift_reg": modes.positive_shift_reg(shifts["dist"]),
        "demographic_df": demographic, "hh_inc_map_df": income,
        **{f"hh_inc_map_{city}": income.where(F.col("City") == city) for city in cities},
        "hh_inc_hist_df": demographics.hh_inc_hist(elder, stops),
        "demo_activity_time_usage_df": demographics.demo_activity_time_usage(cased("activity_times"), elder),
        "demo_agg_tnc_case_df": demographics.demo_agg_tnc_case(zones, elder, skim),
        "demo_agg_mode_data_df": demographics.demo_agg_mode_data(elder),
        "vehicle_ownership_df": demographics.vehicle_ownership(cased("fare_sensitivity_results_vo"), elder),
        "closest_stops_by_zone_df": stops,
        "combined_financial_cases_df": finance.combined_financial_cases(case_money),
        "financial_case_data_df": case_money,
        "demo_financial_case_data_df": finance.senior_cost_by_zone(demographic, money),
        "financial_data_df": cased("requests_sum"), "pooling_rate_df": cased("tnc_results_discount"),
        "tnc_summary_df": cased("fare_sensitivity_results"),
        "tnc_ttests_w_significance": labelled,
        "discount_perc_unit_fix": significance.discount_percent(labelled),
        "rejected_request_rate_unit_fix": significance.rejected_request_rate(labelled),
        "pooling_rate_unit_fix": significance.pooling_rate(labelled),
        "evmt_unit_fix": significance.empty_mileage_share(labelled),
    }
