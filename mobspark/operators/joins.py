"""Join helpers that hold up when one key dominates or a key is missing for many rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_by_shuffle(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join with a table that grows with the data: both sides are dealt out by key and sorted, neither is broadcast.

    The planner broadcasts a table whose estimate is small, and estimates from the size of files: packed, before rows are
    multiplied by ``explode``, and for columns read in part only. A table of some MB there can be a GB of rows in the driver and
    in every executor. Sorted partitions spill, and the adaptive execution still splits skewed ones.
    """
    return left.join(right.hint("merge"), list(on), how)


def left_join_spreading_nulls(left: DataFrame, right: DataFrame, left_key: str, right_key: str, row_id: str) -> DataFrame:
    """Left join on (folder, key) that spreads left rows without a key over many partitions.

    A NULL key never matches but would hash every such row of a case to one task. The salt is 0
    for real keys on both sides, so matches are unchanged; NULL rows get a salt from ``row_id``.
    Dominant real keys are left to the adaptive skew join, which splits the left side. Neither side is broadcast.
    """
    spread = max(2, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salt = F.when(F.col(left_key).isNull(), F.pmod(F.xxhash64(row_id), F.lit(spread))).otherwise(F.lit(0)).cast("int")
    # pmod(.., 1) is always 0 but is not folded, so the salt stays part of the shuffle key
    salted_right = right.withColumnRenamed(right_key, "_key").withColumn("_salt", F.pmod(F.hash("_key"), F.lit(1)))
    salted_left = left.withColumn("_key", F.col(left_key)).withColumn("_salt", salt)
    return join_by_shuffle(salted_left, salted_right, ["folder", "_key", "_salt"], "left").drop("_key", "_salt")


def attach_case_rows(fact: DataFrame, case_rows: DataFrame, how: str = "left") -> DataFrame:
    """Join one-row-per-case constants onto a fact table by ``folder``.

    A plain join: nothing runs while the plan is made, the adaptive execution broadcasts the constants if they turn out
    small, and splits the fact rows of a dominant case otherwise.
    """
    return fact.join(case_rows, "folder", how)


def one_row_per_case(frames: Sequence[DataFrame]) -> DataFrame:
    """Merge frames that hold at most one row per case into one wide row per case.

    Union and a single aggregate instead of a chain of joins: each column comes from one frame,
    so ``max`` just picks its only non-NULL value.
    """
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    values = [c for c in merged.columns if c != "folder"]
    return merged.groupBy("folder").agg(*[F.max(c).alias(c) for c in values])
