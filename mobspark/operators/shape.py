"""Describe, histogram, pivot and unpivot operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def describe_long(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], where: Column | None = None,
                  extra_sums: dict[str, Column] | None = None) -> DataFrame:
    """Sum, mean, sample standard deviation and non-NULL count per metric, one row per key and metric.

    One aggregate pass over the data; only its result (one row per key) is turned into long form.
    ``extra_sums`` adds rows that carry a Sum only.
    """
    def pick(m: str) -> Column:
        return F.col(m).cast("double") if where is None else F.when(where, F.col(m).cast("double"))

    def stats(m: str) -> Column:
        v = pick(m)
        return F.struct(
            F.lit(m).alias("Metric"), F.coalesce(F.sum(v), F.lit(0.0)).alias("Sum"), F.avg(v).alias("Mean"),
            F.stddev_samp(v).alias("StdDev"), F.count(v).cast("double").alias("SampleSize"),
        )

    nothing = F.lit(None).cast("double")
    rows = [stats(m) for m in metrics]
    for name, total in (extra_sums or {}).items():
        rows.append(F.struct(
            F.lit(name).alias("Metric"), total.cast("double").alias("Sum"), nothing.alias("Mean"),
            nothing.alias("StdDev"), nothing.alias("SampleSize"),
        ))
    aggregated = df.groupBy(*keys).agg(*[r.alias(f"_{i}") for i, r in enumerate(rows)])
    packed = aggregated.select(*keys, F.explode(F.array(*[f"_{i}" for i in range(len(rows))])).alias("_row"))
    return packed.select(*keys, "_row.*")


def capped_histogram(df: DataFrame, keys: Sequence[str], value: str, cap: int = 5, steps: int = 10) -> DataFrame:
    """Counts per bin of width 1/steps, zero-filled from 0 to ``cap``; larger values fall in ``<cap>.0+``, and values below
    0 in bins of their own."""
    over = cap * steps + 1  # number of the overflow bin
    step = F.when(F.col(value) > cap, F.lit(over)).otherwise(F.rint(F.col(value) * steps).cast("int"))
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, step.alias("_step")).agg(F.count(F.lit(1)).alias("n"))
    # from 0 up every bin gets a row for each key, counted or not; bins below 0 only come from the data
    expected = counted.select(*keys).distinct().withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(over - 1))))
    every = counted.unionByName(expected.withColumn("n", F.lit(0).cast("bigint")))
    return (
        every.groupBy(*keys, "_step").agg(F.sum("n").alias("Count"))
        .withColumn(value, F.expr(
            f"CASE WHEN _step = {over} THEN '{cap}.0+' ELSE concat(CASE WHEN _step < 0 THEN '-' ELSE '' END, abs(_step) div {steps}, '.', abs(_step) % {steps}) END"))
        .select(*keys, value, "Count")
    )


def pivot_expected(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], amount: str,
                   fill: float | None = 0.0) -> DataFrame:
    """Pivot-sum with a fixed list of output columns, so the schema never depends on the data."""
    wide = df.groupBy(*keys).pivot(column, list(values)).agg(F.sum(amount))
    return wide if fill is None else wide.fillna(fill, subset=list(values))


def melt(df: DataFrame, keys: Sequence[str], values: Sequence[str], name: str = "Attribute", value: str = "Value") -> DataFrame:
    return df.select(*keys, *[F.col(v).cast("double").alias(v) for v in values]).unpivot(list(keys), list(values), name, value)
