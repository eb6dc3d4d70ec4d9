"""Joins by distance and by area, as equi-joins on grid cells with an exact test after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / size)


def within(a: DataFrame, b: DataFrame, radius: float, a_id: str = "a_id", b_id: str = "b_id") -> DataFrame:
    """a_id, b_id and dist of all points (id, x, y) of two tables at most `radius` apart.

    A cell is as wide as the radius; the side that goes to its nine cells should be the smaller one, `a`.
    """
    near = F.explode(F.array(*[F.struct((_cell(F.col("x"), radius) + i).alias("i"), (_cell(F.col("y"), radius) + j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    left = a.select(F.col("id").alias(a_id), F.col("x").alias("_ax"), F.col("y").alias("_ay"), near.alias("_c")).select(a_id, "_ax", "_ay", "_c.*")
    right = b.select(F.col("id").alias(b_id), F.col("x").alias("_bx"), F.col("y").alias("_by"), _cell(F.col("x"), radius).alias("i"), _cell(F.col("y"), radius).alias("j"))
    dist = geometry.distance(F.col("_ax"), F.col("_ay"), F.col("_bx"), F.col("_by"))
    return left.join(right, ["i", "j"]).withColumn("dist", dist).where(F.col("dist") <= radius).select(a_id, b_id, "dist")


def nearest(a: DataFrame, b: DataFrame, most: float, a_id: str = "a_id", b_id: str = "b_id") -> DataFrame:
    """The nearest point of b to each of a, ties to the smaller id; null beyond `most`."""
    best = within(a, b, most, a_id, b_id).groupBy(a_id).agg(F.min(F.struct("dist", b_id)).alias("_m")).select(a_id, f"_m.{b_id}", "_m.dist")
    return a.select(F.col("id").alias(a_id)).join(best, a_id, "left")


def candidates(a: DataFrame, b: DataFrame, most: float, penalty: Column | None = None, k: int = 3, a_id: str = "a_id", b_id: str = "b_id") -> DataFrame:
    """The k best of each point's neighbours by distance plus a penalty (a column of b's id), with rank and score."""
    scored = within(a, b, most, a_id, b_id).withColumn("score", F.col("dist") + (penalty if penalty is not None else F.lit(0.0)))
    rank = F.row_number().over(Window.partitionBy(a_id).orderBy("score", b_id))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


def containing(points: DataFrame, areas: DataFrame, cell: float, point_id: str = "point_id", area_id: str = "area_id") -> DataFrame:
    """The first area (id, ring) that holds each point, by id; null outside all.

    Areas go to the cells of their bounding box, points to one cell.
    """
    x, y = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])

    def span(v: Column) -> Column:
        return F.sequence(_cell(F.array_min(v), cell), _cell(F.array_max(v), cell))

    boxed = areas.select(F.col("id").alias(area_id), "ring", F.explode(span(x)).alias("i"), span(y).alias("_j")).select(area_id, "ring", "i", F.explode("_j").alias("j"))
    own = points.select(F.col("id").alias(point_id), "x", "y", _cell(F.col("x"), cell).alias("i"), _cell(F.col("y"), cell).alias("j"))
    met = own.join(boxed, ["i", "j"]).where(geometry.inside(F.col("x"), F.col("y"), F.col("ring"))).groupBy(point_id).agg(F.min(area_id).alias(area_id))
    return points.select(F.col("id").alias(point_id)).join(met, point_id, "left")


def raster_values(points: DataFrame, raster: DataFrame, size: float) -> DataFrame:
    """Points with the value of the raster cell (row, col, value) they fall in; null where there is none."""
    own = points.withColumns({"col": F.floor(F.col("x") / size), "row": F.floor(F.col("y") / size)})
    return own.join(raster, ["row", "col"], "left")


def focal_mean(raster: DataFrame, window: int = 3) -> DataFrame:
    """Mean of each cell's window (an odd number of cells wide), over cells that have a value."""
    r = window // 2
    shift = F.explode(F.array(*[F.struct((F.col("row") + i).alias("row"), (F.col("col") + j).alias("col")) for i in range(-r, r + 1) for j in range(-r, r + 1)]))
    spread = raster.select(shift.alias("_c"), "value").select("_c.row", "_c.col", "value").groupBy("row", "col").agg(F.avg("value").alias("mean_value"))
    return raster.join(spread, ["row", "col"]).select("row", "col", "mean_value")


def close_pairs(points: DataFrame, radius: float) -> DataFrame:
    """Pairs of points nearer than the radius, once each."""
    return within(points, points, radius).where((F.col("a_id") < F.col("b_id")) & (F.col("dist") < radius))


def fold_neighbours(points: DataFrame, radius: float) -> DataFrame:
    """Of each fold, points of other folds that are nearer than the radius to one of its own: they may not train for it.

    Points have id, x, y and fold. Distances are between spots, however many points are at one.
    """
    spot = F.struct("x", "y").alias("spot")
    at = points.select(spot, "x", "y", "fold", F.col("id").alias("neighbour"))
    spots = at.select(F.col("spot").alias("id"), "x", "y").distinct()
    near = within(spots, spots, radius, "spot", "other").where(F.col("dist") < radius)
    folds = at.select("spot", "fold").distinct()
    reached = near.join(folds, "spot").select(F.col("other").alias("spot"), F.col("fold").alias("_near")).distinct()
    met = at.join(reached, "spot").where(F.col("fold") != F.col("_near"))
    return met.select(F.col("_near").alias("fold"), "neighbour").distinct()


def tiles(spark, xmin: float, ymin: float, width: int, height: int, res: float, most: int) -> DataFrame:
    """Pieces of a raster extent of at most `most` pixels each way: offsets, sizes and corner."""
    rows = F.explode(F.sequence(F.lit(0), F.lit(height - 1), F.lit(most)))
    grid = spark.range(0, width, most).select(F.col("id").cast("int").alias("x_off"), rows.alias("y_off"))
    w, h = F.least(F.lit(most), F.lit(width) - F.col("x_off")), F.least(F.lit(most), F.lit(height) - F.col("y_off"))
    return grid.select("x_off", "y_off", w.alias("width"), h.alias("height"), (xmin + F.col("x_off") * res).alias("x"), (ymin + F.col("y_off") * res).alias("y"))


def mosaic(cells: DataFrame, tiles: DataFrame) -> DataFrame:
    """One raster (row, col, value) of tiles' cells (tile, row, col, value), laid at their offsets (tile, x_off, y_off); where tiles overlap, the first with a value counts."""
    laid = cells.where("value is not null").join(tiles.select("tile", "x_off", "y_off"), "tile")
    place = laid.select((F.col("row") + F.col("y_off")).alias("row"), (F.col("col") + F.col("x_off")).alias("col"), F.struct("tile", "value").alias("held"))
    return place.groupBy("row", "col").agg(F.min("held").alias("held")).select("row", "col", "held.value")


def new_openings(jumps: DataFrame, sites: DataFrame, sensors: DataFrame, radius: float) -> DataFrame:
    """Sites with the sensors in reach, nearest first."""
    met = within(sites, sensors, radius, "property", "sensor")
    lists = met.groupBy("property").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("dist", "sensor"))), lambda s: s["sensor"].cast("string")), ",").alias("sensors"), F.count("*").alias("n_sensors"))
    return jumps.join(lists, "property", "left").withColumn("feasible", F.coalesce(F.col("n_sensors") > 0, F.lit(False)))
