"""Parts of about equal size by rank, within groups of any size and without a group in one task."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobspark.operators.joins import attach_case_rows

CLASSES = 255  # split points of a group, at most


def split_points(df: DataFrame, keys: Mapping[str, Column], group: str = "folder", classes: int = CLASSES) -> DataFrame:
    """Sorted keys of a group at which its rows fall into parts of about equal size: a row for each group, and an array for
    each of ``keys`` (new name -> key; all of one type).

    Keys are dealt into classes by hash, and of each class the one with the least other hash is taken: a random sample of
    the distinct keys, of bounded size, spread as they are. It depends on nothing but the keys, so it is the same whenever
    it is computed.
    """
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("axis"), key.alias("k")) for name, key in keys.items()]))
    rows = df.select(group, each.alias("e")).select(group, "e.axis", "e.k")
    drawn = rows.groupBy(group, "axis", F.pmod(F.xxhash64("k"), F.lit(classes)).alias("class")).agg(
        F.min(F.struct(F.xxhash64("k", F.lit(1)).alias("h"), "k")).alias("m"))
    return drawn.groupBy(group).agg(*[
        F.sort_array(F.collect_list(F.when(F.col("axis") == name, F.col("m.k")))).alias(name) for name in keys])


def split_keys(parts: Mapping[str, str], tie: str) -> dict[str, Column]:
    """The keys by which ``add_parts`` cuts: a value, and the column ``tie`` where values are equal."""
    return {name: F.struct(F.col(c).cast("double").alias("v"), F.col(tie).alias("t")) for name, c in parts.items()}


def add_reached(df: DataFrame, parts: Mapping[str, tuple[str, Callable[[Column], Column]]]) -> DataFrame:
    """``df`` with the number of elements that a condition holds for, which are the first ones of a sorted array of CLASSES at
    most (new name -> column of the array, condition); by bisection."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(CLASSES.bit_length()))])

    def bisected(cuts: str, reached: Callable[[Column], Column]) -> Column:
        return F.aggregate(steps, F.lit(0), lambda n, step: n + F.when(reached(F.get(cuts, n + step - 1)), step).otherwise(0))

    return df.withColumns({name: bisected(*part) for name, part in parts.items()})


def add_parts(df: DataFrame, parts: Mapping[str, str], tie: str, group: str = "folder") -> DataFrame:
    """``df`` with the number, from 0 to CLASSES, of the part of its group in which a row falls by each column of ``parts``
    (new name -> column of numbers, without NULL).

    Parts are ranges of the value, and of the column ``tie`` where values are equal, so one value of very many rows is cut,
    too. All that is gathered for a group is a row with its split points.
    """
    keys = split_keys(parts, tie)
    cuts = split_points(df, {f"_cuts_{name}": k for name, k in keys.items()}, group)
    placed = attach_case_rows(df, cuts, "inner")
    placed = add_reached(placed, {name: (f"_cuts_{name}", lambda cut, k=k: cut <= k) for name, k in keys.items()})
    return placed.drop(*[f"_cuts_{name}" for name in parts])
