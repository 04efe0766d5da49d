"""Case dimensions taken from the case name (``folder``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _part(folder: Column, n: int) -> Column:
    return F.get(F.split(folder, "_"), n)


def _rest(folder: Column, n: int) -> Column:
    """Everything from the n-th ``_`` part on, still joined; NULL if there is none."""
    return F.get(F.split(folder, "_", n + 1), n)


def _heuristic(code: Column) -> Column:
    return F.when(code == "heur", "Heuristic").otherwise("Proactive")


def add_city_case_iteration(df: DataFrame, folder: str = "folder") -> DataFrame:
    """``city_case_iteration``: City, Strategy, WTP_Type, Iteration."""
    f = F.col(folder)
    code = _part(f, 1)
    return df.withColumns({
        "City": _part(f, 0),
        "Iteration": _rest(f, 2),
        "Strategy": _heuristic(code),
        "WTP_Type": F.when(code == "heur", "N/A").otherwise(code),
    })


def add_city_fleet_weight(df: DataFrame, folder: str = "folder") -> DataFrame:
    """``city_size_strategy_iteration`` where a numeric third part is a weight of strategy jar."""
    f = F.col(folder)
    third = _part(f, 2)
    weight = F.when(third.rlike(NUMBER), F.expr("try_cast(_third AS double)"))
    return (
        df.withColumn("_third", third)
        .withColumn("_weight", weight)
        .withColumns({
            "City": _part(f, 0),
            "Fleet Size": _part(f, 1),
            "Iteration": _rest(f, 3),
            "Strat_Raw": F.when(F.col("_weight").isNull(), F.coalesce(F.col("_third"), F.lit("jar")))
            .otherwise(F.lit("jar")),
            "Repo_Weight": F.coalesce(F.col("_weight").cast("string"), F.lit("0")),
        })
        .withColumn("Strategy", F.concat_ws("_", "Strat_Raw", "Repo_Weight"))
        .drop("_third", "_weight")
    )


def add_city_fleet_strategy(df: DataFrame, folder: str = "folder") -> DataFrame:
    """``city_size_strategy[_iteration]``: the third part doubles as iteration if there is no fourth."""
    f = F.col(folder)
    return df.withColumns({
        "City": _part(f, 0),
        "Fleet Size": _part(f, 1),
        "Strategy": _heuristic(F.coalesce(_part(f, 2), F.lit(""))),
        "Iteration": F.coalesce(_rest(f, 3), _part(f, 2)),
    })


def strip_last_part(folder: str | Column) -> Column:
    """Case label without its last ``_`` part (the iteration)."""
    c = F.col(folder) if isinstance(folder, str) else folder
    return F.regexp_replace(c, "_[^_]*$", "")
