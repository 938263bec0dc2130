"""Points in areas: tiles for an equality join, bounding boxes, then the exact test. lon and lat in degrees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRID, EPSILON = 5.0, 1e-9


def tile(v: Column, grid: float = GRID) -> Column:
    return F.floor(v / grid).cast("int")


def tiled(areas: DataFrame, grid: float = GRID) -> DataFrame:
    """Areas (code, x1, y1, x2, y2, ...) once for each tile that their box meets."""
    steps = lambda a, b: F.explode(F.sequence(tile(F.col(a) - EPSILON, grid), tile(F.col(b) + EPSILON, grid)))
    return areas.withColumn("tx", steps("x1", "x2")).withColumn("ty", steps("y1", "y2"))


def boxes(areas: DataFrame) -> DataFrame:
    """Adds the box of the outer rings. areas: (code, polygons: array of polygons of rings of [lon, lat])."""
    points = lambda i: F.flatten(F.transform("polygons", lambda p: F.transform(p[0], lambda xy: xy[i])))
    return areas.withColumns({"x1": F.array_min(points(0)), "y1": F.array_min(points(1)), "x2": F.array_max(points(0)), "y2": F.array_max(points(1))})


def covering_box(areas: DataFrame) -> DataFrame:
    return areas.agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))


def _in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Crossings by even and odd; a point on an edge is inside."""
    pairs = F.arrays_zip(F.slice(ring, 1, F.size(ring) - 1).alias("a"), F.slice(ring, 2, F.size(ring) - 1).alias("b"))

    def step(s):
        x1, y1, x2, y2 = s["a"][0], s["a"][1], s["b"][0], s["b"][1]
        cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
        on = (F.abs(cross) <= EPSILON) & x.between(F.least(x1, x2) - EPSILON, F.greatest(x1, x2) + EPSILON) & y.between(F.least(y1, y2) - EPSILON, F.greatest(y1, y2) + EPSILON)
        crosses = ((y1 > y) != (y2 > y)) & (x < F.try_divide((x2 - x1) * (y - y1), y2 - y1) + x1)
        return F.struct(on.alias("on"), F.coalesce(crosses, F.lit(False)).alias("cross"))

    found = F.transform(pairs, step)
    return F.exists(found, lambda r: r["on"]) | (F.size(F.filter(found, lambda r: r["cross"])) % 2 == 1)


def inside(x: Column, y: Column, polygons: Column) -> Column:
    """In the outer ring of a polygon and in none of its holes; a hole's edge counts as the hole."""
    return F.exists(polygons, lambda p: _in_ring(x, y, p[0]) & ~F.exists(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda h: _in_ring(x, y, h)))


def located(points: DataFrame, areas: DataFrame, grid: float = GRID, exact: bool = True) -> DataFrame:
    """points (id, lon, lat) with the smallest code of the areas that hold them, or null."""
    hit = points.withColumns({"tx": tile(F.col("lon"), grid), "ty": tile(F.col("lat"), grid)}).join(tiled(areas, grid), ["tx", "ty"])
    hit = hit.filter(F.col("lon").between(F.col("x1") - EPSILON, F.col("x2") + EPSILON) & F.col("lat").between(F.col("y1") - EPSILON, F.col("y2") + EPSILON))
    if exact:
        hit = hit.filter(inside(F.col("lon"), F.col("lat"), F.col("polygons")))
    return points.join(hit.groupBy("id").agg(F.min("code").alias("code")), "id", "left")


def neighbours(areas: DataFrame, grid: float = GRID) -> DataFrame:
    """(code, neighbours): the codes whose boxes meet. Compared within tiles."""
    t = tiled(areas.select("code", "x1", "y1", "x2", "y2"), grid)
    u = t.select("tx", "ty", F.col("code").alias("other"), *[F.col(c).alias(f"o{c}") for c in ("x1", "y1", "x2", "y2")])
    met = t.join(u, ["tx", "ty"]).filter("code <> other and x1 <= ox2 and ox1 <= x2 and y1 <= oy2 and oy1 <= y2")
    return met.select("code", "other").distinct().groupBy("code").agg(F.array_join(F.array_sort(F.collect_list("other")), ",").alias("neighbours"))


def found_places(points: DataFrame, areas: DataFrame, grid: float = GRID) -> DataFrame:
    """points (id, lon, lat) with code and name of the area that holds them and how it was found: tile (an area listed for
    the point's own tile), neighbour_tile (only one listed for a tile beside it, whose ring touches the point), no_match,
    or invalid_coordinate. areas: (code, name, polygons, and tx, ty of the tiles that list them, as an index gives them).
    Of several areas the smallest code counts. The look at neighbours is made for points without an area alone."""
    valid = F.coalesce(F.col("lon").between(-180, 180) & F.col("lat").between(-90, 90), F.lit(False))
    there = points.filter(valid).withColumns({"tx": tile(F.col("lon"), grid), "ty": tile(F.col("lat"), grid)})

    def hits(rows):
        met = rows.join(areas, ["tx", "ty"]).filter(inside(F.col("lon"), F.col("lat"), F.col("polygons")))
        return met.groupBy("id").agg(F.min(F.struct("code", "name")).alias("a"))

    own = hits(there)
    rest = there.join(own, "id", "left_anti")
    steps = [F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in (-1, 0, 1) for y in (-1, 0, 1) if x or y]
    around = rest.withColumn("d", F.explode(F.array(*steps))).withColumns({"tx": F.col("tx") + F.col("d.x"), "ty": F.col("ty") + F.col("d.y")}).drop("d")
    found = own.withColumn("how", F.lit("tile")).unionByName(hits(around).withColumn("how", F.lit("neighbour_tile")))
    how = F.when(~valid, "invalid_coordinate").otherwise(F.coalesce("how", F.lit("no_match")))
    return points.join(found, "id", "left").select(*points.columns, F.col("a.code").alias("code"), F.col("a.name").alias("name"), how.alias("how"))
