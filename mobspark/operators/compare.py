"""Comparison of treatment cases with baseline cases.

Inputs are report tables with a few rows per case that are expensive to compute, so the baseline's
values are brought beside each row with a window over one evaluation of the input, not a self-join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mobspark.functions.exprs import col, ratio
from mobspark.functions.stats import pooled_t


def first_match(where: Column, on: Sequence[str], columns: Sequence[str], order: str = "folder") -> Column:
    """The given columns of the group's first row (by ``order``) that satisfies ``where``, as a struct."""
    row = F.struct(F.col(order).alias("_order"), *[F.col(f"`{c}`").alias(c) for c in columns])
    return F.min(F.when(where, row)).over(Window.partitionBy(*on))


def with_baseline(df: DataFrame, on: Sequence[str], strategy: str, baseline: Sequence[str], columns: Sequence[str],
                  treatment: Sequence[str] | None = None, prefix: str = "heuristic ") -> DataFrame:
    """Treatment and baseline rows; the former carry their group's baseline ``columns`` (prefixed).

    ``treatment=None`` takes every strategy that is not the baseline. A group with several baseline
    cases uses the first by name.
    """
    label = F.col(strategy)
    is_base = label.isin(*baseline)
    chosen = label.isin(*baseline, *treatment) if treatment else label.isNotNull()
    paired = df.where(chosen).withColumn("_base", first_match(is_base, on, columns))
    return paired.withColumns(
        {prefix + c: F.when(~is_base, F.col("_base").getField(c)) for c in columns}
    ).drop("_base")


def shift(new: str | Column, old: str | Column) -> Column:
    """Relative change (new - old) / old."""
    return ratio(col(new) - col(old), old)


def ttest_from_stats(stats: DataFrame, is_base: Column, on: Sequence[str], value_from: Mapping[str, str]) -> DataFrame:
    """Pair each case's metric row with its group's base row: base_case, folder, metric, t-statistic, df, value.

    ``value_from`` names the column reported as ``value`` per metric (Mean or Sum). Metrics that carry
    no mean keep a NULL statistic. Groups without a base row are left out.
    """
    base = first_match(is_base, [*on, "Metric"], ["Mean", "StdDev", "SampleSize"])
    pairs = stats.where(F.col("Metric").isin(*value_from)).withColumn("_b", base).where("_b IS NOT NULL AND folder <> _b._order")
    t, dof = pooled_t(F.col("_b.Mean"), F.col("_b.StdDev"), F.col("_b.SampleSize"),
                      F.col("Mean"), F.col("StdDev"), F.col("SampleSize"))
    means = [m for m, c in value_from.items() if c == "Mean"]
    value = F.when(F.col("Metric").isin(*means), F.col("Mean")).otherwise(F.col("Sum"))
    return pairs.select(
        *on, F.col("_b._order").alias("base_case"), "folder", F.col("Metric").alias("metric"),
        t.alias("t-statistic"), dof.alias("df"), value.alias("value"),
    )
