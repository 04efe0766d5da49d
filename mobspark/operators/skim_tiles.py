"""The skim matrix as tiles: one row for a square of zone pairs instead of one for each pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobspark.functions.exprs import METRES_PER_MILE
from mobspark.operators.asof import with_skim_period

SIDE = 64


def _tile(zone: str, side: int) -> Column:
    return F.floor(F.col(zone) / F.lit(side))


def _cell(side: int) -> Column:
    """Place of a zone pair in its tile."""
    return (F.pmod("origin_zone", F.lit(side)) * side + F.pmod("destination_zone", F.lit(side))).cast("int")


def tile_skim(skim: DataFrame, side: int = SIDE) -> DataFrame:
    """(folder, period, origin_tile, destination_tile, full, cells, times, dists): squares of ``side`` by ``side`` zones.

    Arrays are in the order of the places within the tile. ``full`` tiles hold every place, so a place is its own index;
    others (at the edge, or of sparse zone numbers) name theirs in ``cells``, which is empty where it isn't needed. Of rows
    that repeat a zone pair the one with the least time and distance counts.
    """
    cell = F.struct(_cell(side).alias("cell"), "time_min", "dist_m")
    rows = skim.where("origin_zone IS NOT NULL AND destination_zone IS NOT NULL").groupBy(
        "folder", "period", _tile("origin_zone", side).alias("origin_tile"), _tile("destination_zone", side).alias("destination_tile")
    ).agg(F.array_sort(F.collect_list(cell)).alias("sorted"))  # a square of the matrix
    places = F.transform("sorted", lambda c: c["cell"])
    full = (F.size("sorted") == side * side) & (places == F.sequence(F.lit(0), F.lit(side * side - 1)))
    return rows.withColumn("full", full).select(
        "folder", "period", "origin_tile", "destination_tile", "full", F.when(~F.col("full"), places).otherwise(F.array().cast("array<int>")).alias("cells"),
        F.transform("sorted", lambda c: c["time_min"]).alias("times"), F.transform("sorted", lambda c: c["dist_m"]).alias("dists"))


def tiled_lookup(requests: DataFrame, tiles: DataFrame, mode: str = "first", periods: DataFrame | None = None, side: int = SIDE) -> DataFrame:
    """``skim_lookup`` in tiles of ``tile_skim`` with the same ``side``: a request meets one tile row, so what is shuffled and
    sorted of the matrix are its tiles, not its zone pairs."""
    asked = with_skim_period(requests, tiles, mode, periods).withColumns({
        "_origin_tile": _tile("origin_zone", side), "_destination_tile": _tile("destination_zone", side), "_cell": _cell(side)})
    held = tiles.select(
        "folder", F.col("period").alias("skim_period"), F.col("origin_tile").alias("_origin_tile"),
        F.col("destination_tile").alias("_destination_tile"), F.col("full").alias("_full"), F.col("cells").alias("_cells"),
        F.col("times").alias("_times"), F.col("dists").alias("_dists"))
    joined = asked.join(held, ["folder", "skim_period", "_origin_tile", "_destination_tile"], "left")
    # array_position is 0 for what isn't there, and get() NULL for what is outside
    at = F.when(F.col("_full"), F.col("_cell")).otherwise((F.array_position("_cells", F.col("_cell")) - 1).cast("int"))
    found = joined.withColumn("_at", at)
    return found.withColumns({
        "skim_time": F.get("_times", F.col("_at")), "skim_dist": F.get("_dists", F.col("_at")) / METRES_PER_MILE,
    }).select(*[c for c in requests.columns], "skim_period", "skim_time", "skim_dist")
