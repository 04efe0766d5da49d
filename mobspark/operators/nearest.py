"""Exact nearest-neighbour join (k = 1, Euclidean) as a top-down grid search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobspark.operators.joins import attach_case_rows, join_by_shuffle
from mobspark.operators.rank import add_parts, add_reached, split_keys, split_points

COARSE = 16  # fine cells along each side of a coarse one; as many coarse ones along the side of a case
MIDDLE = 4  # fine cells along each side of a middle one

MANY = 16  # boxes from which on their farthest corners are looked at

# Squared distance of a position to the farthest and the nearest point of a box k, and whether a strip t
# or box k can be within reach. SLACK keeps ties and zero distances alive against rounding.
_FAR = "(pow(greatest(abs(x - k.x0), abs(x - k.x1)), 2) + pow(greatest(abs(y - k.y0), abs(y - k.y1)), 2))"
_NEAR = "(pow(greatest(k.x0 - x, x - k.x1, 0D), 2) + pow(greatest(k.y0 - y, y - k.y1, 0D), 2))"
_IN_X = "t.x0 - x <= reach AND x - t.x1 <= reach"
_IN_Y = "k.y0 - y <= reach AND y - k.y1 <= reach"
_SLACK = "* 1.000000001D + 0.000001D"
_D2 = "(x - s.sx) * (x - s.sx) + (y - s.sy) * (y - s.sy)"


def nearest_stop(homes: DataFrame, stops: DataFrame) -> DataFrame:
    """Nearest stop of every distinct home position: folder, x, y, stop_id, distance.

    Stops are put into a grid of 256 by 256 cells that are cut at the ranks of their coordinates, so cells are as fine as
    the stops are dense and a stray stop takes up no room; 16 by 16 of them make a coarse cell, 4 by 4 a middle one. A home
    is put into the same grid, and a stop of each cell within its middle cell gives a first bound. It starts with the whole
    case, keeps the coarse cells that can still hold the nearest stop, then the cells within those: one is dropped when its
    box (in true coordinates) is farther than the bound, or than the farthest corner of some other candidate box. The boxes
    within a parent, at most 256, travel as one array of strips with the stops in them, so a home is a row for each of the
    few coarse cells near it, and looks only at boxes in strips near it. Neither a dense district nor a home far outside
    meets all stops. Homes, and stops, at the same place are compared once; equal distances go to the lowest stop id. Stops
    without finite coordinates are left out.
    """
    points = homes.where("x IS NOT NULL AND y IS NOT NULL").select("folder", "x", "y").distinct()
    places = (
        stops.where("abs(x) < double('infinity') AND abs(y) < double('infinity')")
        .groupBy("folder", F.col("x").alias("sx"), F.col("y").alias("sy"))
        .agg(F.min("stop_id").alias("stop_id"))
    )
    axes = {"cx": "sx", "cy": "sy"}
    placed = add_parts(places, axes, "stop_id").withColumns(
        {f"p{c}": F.floor(F.col(c) / COARSE).cast("int") for c in axes})
    # all that is gathered within a coarse cell stays where its stops are
    cells = placed.repartition("folder", "pcx", "pcy").groupBy("folder", "pcx", "pcy", "cx", "cy").agg(
        F.min("sx").alias("x0"), F.max("sx").alias("x1"), F.min("sy").alias("y0"), F.max("sy").alias("y1"),
        F.collect_list(F.struct("sx", "sy", "stop_id")).alias("stops"))
    tiles = _strips(cells, ["folder", "pcx", "pcy"], "cx", ["stops"])
    coarse = cells.groupBy("folder", "pcx", "pcy").agg(
        F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    middle = cells.select("folder", *_middle("cx", "cy"), F.col("stops")[0].alias("stop")).groupBy("folder", "mx", "my").agg(
        F.collect_list("stop").alias("some"))

    # the search is heavy on computation and light on bytes: keep the configured parallelism
    partitions = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = split_points(places, split_keys(axes, "stop_id")).select(
        "folder", *[F.transform(c, lambda cut: cut["v"]).alias(f"_cuts_{c}") for c in axes])
    search = attach_case_rows(points.repartition(partitions, "x", "y"), _sized(cuts), "inner")
    search = add_reached(search, {c: (f"_cuts_{c}", lambda cut, at=at: cut <= F.col(at)) for c, at in (("cx", "x"), ("cy", "y"))})
    search = search.select("folder", "x", "y", *_middle("cx", "cy"))
    bound = f"least(double('infinity'), array_min(transform(some, s -> CAST({_D2} AS DOUBLE))) {_SLACK})"
    search = join_by_shuffle(search, middle, ["folder", "mx", "my"], "left").select("folder", "x", "y", F.expr(bound).alias("best"))
    search = _nearer(attach_case_rows(search, _sized(_strips(coarse, ["folder"], "pcx", ["pcx", "pcy"])), "inner"))
    # outer, and no filter on what is computed here: Spark would compute it again for the filter
    search = search.select("folder", "x", "y", "best", F.inline_outer("kids")).select("folder", "x", "y", "best", "pcx", "pcy")
    search = _nearer(join_by_shuffle(search, tiles, ["folder", "pcx", "pcy"]))
    hit = f"array_min(transform(flatten(transform(kids, k -> k.stops)), s -> named_struct('d2', {_D2}, 'stop_id', s.stop_id)))"
    return (
        search.select("folder", "x", "y", F.expr(hit).alias("hit"))
        .groupBy("folder", "x", "y")
        .agg(F.min("hit").alias("hit"))
        .where("hit IS NOT NULL")
        .select("folder", "x", "y", F.col("hit.stop_id").alias("stop_id"), F.sqrt("hit.d2").alias("distance"))
    )


def _middle(cx: str, cy: str) -> list:
    return [F.floor(F.col(c) / MIDDLE).cast("int").alias(name) for c, name in ((cx, "mx"), (cy, "my"))]


def _sized(case_rows: DataFrame) -> DataFrame:
    """Rows of cases dealt out once more: their size is known then, so the adaptive execution can see that they are few."""
    return case_rows.repartition("folder")


def _strips(boxes: DataFrame, parent: list[str], column: str, own: list[str]) -> DataFrame:
    """Boxes by their parent, in strips that have ``column`` in common, each with its range of x."""
    strips = boxes.groupBy(*parent, column).agg(
        F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.collect_list(F.struct("x0", "x1", "y0", "y1", *own)).alias("kids"))
    return strips.groupBy(*parent).agg(F.collect_list(F.struct("x0", "x1", "kids")).alias("strips"))


def _nearer(joined: DataFrame) -> DataFrame:
    """The boxes (``kids``) of each home's strips within its bound and, if they are many, within what their farthest corners
    leave of it."""
    near = f"flatten(transform(filter(strips, t -> {_IN_X}), t -> filter(t.kids, k -> {_IN_Y})))"
    found = joined.withColumn("reach", F.sqrt("best")).select("folder", "x", "y", "best", F.expr(near).alias("kids"))
    many = f"size(kids) > {MANY}"
    tighter = f"CASE WHEN {many} THEN least(best, array_min(transform(kids, k -> {_FAR})) {_SLACK}) ELSE best END"
    found = found.withColumn("best", F.expr(tighter))
    return found.withColumn("kids", F.expr(f"CASE WHEN {many} THEN filter(kids, k -> {_NEAR} <= best) ELSE kids END"))
