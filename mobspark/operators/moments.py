"""Stored moments that merge: count, mean and centred square sum of a metric, one row for each key and metric.

States of parts (a day, a case, a batch of cases) are merged without going back to the rows they came from. The centred
squares of a whole are those of its parts plus n * (part's mean - whole mean)**2, so nothing large cancels, however far the
mean lies from zero; sums of squares of the values themselves would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def moment_states(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], where: Column | None = None) -> DataFrame:
    """(keys, Metric, n, mean, m2) of the metrics' values that are known, in one aggregate. Without any, n and m2 are 0 and
    the mean is NULL."""
    def pick(m: str) -> Column:
        return F.col(m).cast("double") if where is None else F.when(where, F.col(m).cast("double"))

    states = [F.struct(
        F.lit(m).alias("Metric"), F.count(pick(m)).alias("n"), F.avg(pick(m)).alias("mean"),
        F.coalesce(F.var_pop(pick(m)) * F.count(pick(m)), F.lit(0.0)).alias("m2"),
    ).alias(f"_{i}") for i, m in enumerate(metrics)]
    rows = df.groupBy(*keys).agg(*states)
    return rows.select(*keys, F.explode(F.array(*[f"_{i}" for i in range(len(metrics))])).alias("_s")).select(*keys, "_s.*")


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of larger groups, from the states of any parts of them, merged ones included."""
    whole = Window.partitionBy(*keys, "Metric")
    known = F.col("n") > 0
    mean = F.try_divide(F.sum(F.when(known, F.col("n") * F.col("mean"))).over(whole), F.sum("n").over(whole))
    away = F.when(known, F.col("n") * (F.col("mean") - F.col("_mean")) * (F.col("mean") - F.col("_mean")))
    return states.withColumn("_mean", mean).groupBy(*keys, "Metric").agg(
        F.sum("n").alias("n"), F.max("_mean").alias("mean"), (F.sum("m2") + F.coalesce(F.sum(away), F.lit(0.0))).alias("m2"))


def describe_states(states: DataFrame) -> DataFrame:
    """Sum, Mean, StdDev (of a sample) and SampleSize, as ``describe_long`` gives them from rows."""
    n = F.col("n").cast("double")
    return states.select(
        *[c for c in states.columns if c not in ("n", "mean", "m2")],
        F.coalesce(n * F.col("mean"), F.lit(0.0)).alias("Sum"), F.col("mean").alias("Mean"),
        F.sqrt(F.try_divide(F.when(n > 1, F.col("m2")), n - 1)).alias("StdDev"), n.alias("SampleSize"))


def states_of(described: DataFrame) -> DataFrame:
    """The states behind rows of ``describe_long``, such as a stored summary; rows that carry a Sum only have none."""
    n = F.col("SampleSize")
    return described.where("SampleSize IS NOT NULL").select(
        *[c for c in described.columns if c not in ("Sum", "Mean", "StdDev", "SampleSize")], n.cast("long").alias("n"),
        F.col("Mean").alias("mean"), F.coalesce(F.col("StdDev") * F.col("StdDev") * (n - 1), F.lit(0.0)).alias("m2"))
