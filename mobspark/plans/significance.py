"""t-tests of cases against base cases and their presentation tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mobspark.functions.exprs import ratio, relabel, starred, starred_percent, stars
from mobspark.functions.stats import t_p_value
from mobspark.operators.compare import ttest_from_stats
from mobspark.operators.moments import describe_states, merge_states, states_of

# fixed values: published names of the metrics and their readable labels
MEAN_METRICS = ["eVMT_perc", "wait_min", "ttime", "pooled", "mileage_AVO", "mileage_rAVO", "trip_AVO", "trip_rAVO"]
SUM_METRICS = ["occupied_VMT", "VMT", "discount", "fare", "operating_cost", "revenue"]
COUNT_METRICS = ["assigned_requests", "requests"]
VALUE_FROM = {m: "Mean" for m in MEAN_METRICS} | {m: "Sum" for m in (*SUM_METRICS, *COUNT_METRICS)}
METRIC_LABELS = {
    "wait_min": "Wait Time", "ttime": "Travel Time", "discount": "Discount", "fare": "Fare", "pooled": "Pooling %",
    "occupied_VMT": "rVMT", "mileage_AVO": "Mileage AVO", "mileage_rAVO": "Mileage rAVO", "trip_AVO": "Trip AVO",
    "trip_rAVO": "Trip rAVO", "operating_cost": "Operating Cost", "revenue": "Revenue",
    "assigned_requests": "Assigned Requests", "requests": "Total Requests",
}


def ttest_pairs(summary: DataFrame, base_cases: Sequence[str] | None = None, base_suffix: str | None = None) -> DataFrame:
    """t statistic of every case against its city's base case (same fleet size too with a suffix).

    If a group has several base cases the first by name counts.
    """
    if (base_cases is None) == (base_suffix is None):
        raise ValueError("give either base_cases or base_suffix")
    rows = summary.withColumns({"city": F.substring("folder", 1, 3), "fleet_size": F.get(F.split("folder", "_"), 1)})
    on = ["city"] if base_cases is not None else ["city", "fleet_size"]
    is_base = F.col("folder").isin(*base_cases) if base_cases is not None else F.col("folder").rlike(base_suffix)
    pairs = ttest_from_stats(rows, is_base, on, VALUE_FROM)
    # with a suffix every base case is a reference only; named base cases are compared with each other
    return pairs if base_cases is not None else pairs.where(~F.col("folder").rlike(base_suffix))


def tnc_ttests(summary: DataFrame, base_cases: Sequence[str] | None = None, base_suffix: str | None = None) -> DataFrame:
    """t statistic, two-sided p-value and value per city, base case, case and metric."""
    pairs = ttest_pairs(summary, base_cases, base_suffix)
    return pairs.withColumn("p-value", t_p_value("t-statistic", "df")).select(
        "city", "base_case", "folder", "metric", "t-statistic", "p-value", "value"
    )


def strategy_summary(summary: DataFrame) -> DataFrame:
    """The summary of all cases of a city and strategy taken together, from the stored summaries of the cases alone."""
    parts = F.split("folder", "_")
    named = summary.where(F.col("Metric").isin(*MEAN_METRICS, *SUM_METRICS)).select(
        F.get(parts, 0).alias("city"), F.get(parts, 2).alias("strategy"), "Metric", "Sum", "Mean", "StdDev", "SampleSize")
    return describe_states(merge_states(states_of(named), ["city", "strategy"]))


def strategy_ttests(summary: DataFrame, base: str) -> DataFrame:
    """t statistic and two-sided p-value of each strategy's requests against those of the city's base strategy, over all
    fleet sizes and iterations; cities without the base strategy are left out."""
    pooled = strategy_summary(summary).withColumnRenamed("strategy", "folder")
    pairs = ttest_from_stats(pooled, F.col("folder") == base, ["city"], {m: "Mean" for m in (*MEAN_METRICS, *SUM_METRICS)})
    return pairs.withColumn("p-value", t_p_value("t-statistic", "df")).select(
        "city", F.col("folder").alias("strategy"), "metric", "t-statistic", "p-value", "value")


def with_significance(ttests: DataFrame) -> DataFrame:
    """Readable metric names, significance stars and formatted values."""
    return ttests.where("value IS NOT NULL").withColumns({
        "significance level": stars("p-value"), "metric": relabel("metric", METRIC_LABELS),
    }).withColumn("value_significance", starred("value", "significance level"))


def _with_other(labelled: DataFrame, metric: str, other: str, alias: str) -> DataFrame:
    """Rows of one metric with another metric's value of the same case beside them."""
    same_case = Window.partitionBy("base_case", "folder")
    value = F.max(F.when(F.col("metric") == other, F.col("value"))).over(same_case)
    return labelled.where(F.col("metric").isin(metric, other)).withColumn(alias, value).where(F.col("metric") == metric)


def discount_percent(labelled: DataFrame) -> DataFrame:
    """Discount as a share of the fares of the same case."""
    share = _with_other(labelled, "Discount", "Fare", "value_fare").withColumn("Discount %", ratio("value", "value_fare"))
    return share.withColumn("value_significance", starred_percent("Discount %", "significance level"))


def rejected_request_rate(labelled: DataFrame) -> DataFrame:
    """(requests - assigned) / assigned: unserved requests per served one."""
    both = _with_other(labelled, "Total Requests", "Assigned Requests", "value_assigned")
    return both.withColumn("Rejected Request Rate", ratio(F.col("value") - F.col("value_assigned"), "value_assigned"))


def percent_of(labelled: DataFrame, metric: str) -> DataFrame:
    """One metric with its value shown as a percentage."""
    value: Column = starred_percent("value", "significance level")
    return labelled.where(F.col("metric") == metric).withColumn("value_significance", value)


def pooling_rate(labelled: DataFrame) -> DataFrame:
    return percent_of(labelled, "Pooling %")


def empty_mileage_share(labelled: DataFrame) -> DataFrame:
    return percent_of(labelled, "eVMT_perc")
