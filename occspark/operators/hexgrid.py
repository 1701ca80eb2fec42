"""A hexagonal grid in the equal-area plane with pointy tops and axial coordinates (q, r).

Hexagonal cells touch only along edges, so the six neighbours are all cells that share an edge or
a corner. Every point has exactly one cell, worked out by arithmetic: assignment is no spatial join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import bbox, edges, laea, polygons_intersect, project_rings

SQRT3 = math.sqrt(3.0)
NEIGHBOURS = [(1, 0), (-1, 0), (0, 1), (0, -1), (1, -1), (-1, 1)]
# Mean cell areas, in square kilometres, of the common hexagonal hierarchy by resolution.
MEAN_AREA_KM2 = {0: 4357449.416, 1: 609788.442, 2: 86801.780, 3: 12393.435, 4: 1770.348, 5: 252.904, 6: 36.129, 7: 5.161, 8: 0.737328, 9: 0.105333, 10: 0.015048}


def edge_length(resolution: int) -> float:
    """Edge, in metres, of a hexagon with the mean area of a resolution."""
    return math.sqrt(MEAN_AREA_KM2[resolution] * 1e6 * 2 / (3 * SQRT3))


def axial(x: Column, y: Column, a: float) -> Column:
    """struct(q, r) of the cell that holds a place of the plane."""
    q = (x * F.lit(SQRT3 / 3) - y / F.lit(3.0)) / F.lit(a)
    r = y * F.lit(2.0 / 3) / F.lit(a)
    s = -q - r
    near = lambda v: F.floor(v + F.lit(0.5)).cast("double")
    nq, nr, ns = near(q), near(r), near(s)
    dq, dr, ds = F.abs(nq - q), F.abs(nr - r), F.abs(ns - s)
    rq = F.when((dq > dr) & (dq > ds), -nr - ns).otherwise(nq)
    rr = F.when((dq > dr) & (dq > ds), nr).when(dr > ds, -nq - ns).otherwise(nr)
    return F.struct(rq.cast("long").alias("q"), rr.cast("long").alias("r"))


def cell_name(q: Column, r: Column, label: str) -> Column:
    return F.concat_ws(":", F.lit(label), q.cast("string"), r.cast("string"))


def centre(q: Column, r: Column, a: float) -> Column:
    return F.struct((F.lit(a * SQRT3) * (q + r / F.lit(2.0))).alias("x"), (F.lit(a * 1.5) * r).alias("y"))


def corners(q: Column, r: Column, a: float) -> Column:
    """The closed ring of a cell, from the top corner on."""
    c = centre(q, r, a)
    w = a * SQRT3 / 2
    steps = [(0.0, a), (-w, a / 2), (-w, -a / 2), (0.0, -a), (w, -a / 2), (w, a / 2), (0.0, a)]
    return F.array(*(F.struct((c["x"] + F.lit(dx)).alias("x"), (c["y"] + F.lit(dy)).alias("y")) for dx, dy in steps))


def assign_cells(points: DataFrame, a: float, label: str = "hex") -> DataFrame:
    """``points`` with ``q``, ``r`` and ``cell_id``; those without coordinates are dropped."""
    kept = points.filter("decimalLongitude is not null and decimalLatitude is not null")
    m = kept.withColumn("__m", laea(F.col("decimalLongitude"), F.col("decimalLatitude")))
    m = m.withColumn("__c", axial(F.col("__m.x"), F.col("__m.y"), a))
    return m.withColumns({"q": F.col("__c.q"), "r": F.col("__c.r")}).withColumn("cell_id", cell_name(F.col("q"), F.col("r"), label)).drop("__m", "__c")


def hex_grid(area: DataFrame, a: float, label: str = "hex", pad_rings: int = 1) -> DataFrame:
    """(cell_id, q, r): the cells that intersect any polygon of the area (column ``rings``), once each.

    Candidates come from each polygon's own bounding box, so the polygons of a large area spread over
    tasks. ``pad_rings`` widens the box by that many cells, so that none with its centre outside is
    missed; 0 leaves those out. Polygon edges are straight in the plane between projected corners.
    """
    shapes = area.select(project_rings(F.col("rings")).alias("m")).select(edges(F.col("m")).alias("es"), bbox(F.col("m")).alias("b"))
    row = lambda y: F.floor(y * F.lit(2.0 / 3 / a) + F.lit(0.5)).cast("long")
    rows = shapes.withColumn("r", F.explode(F.sequence(row(F.col("b.min_y")) - pad_rings, row(F.col("b.max_y")) + pad_rings)))
    col = lambda x: F.floor(x / F.lit(a * SQRT3) - F.col("r") / F.lit(2.0) + F.lit(0.5)).cast("long")
    cells = rows.withColumn("q", F.explode(F.sequence(col(F.col("b.min_x")) - pad_rings, col(F.col("b.max_x")) + pad_rings)))
    if not pad_rings:
        c = centre(F.col("q"), F.col("r"), a)
        cells = cells.filter(c["x"].between(F.col("b.min_x"), F.col("b.max_x")) & c["y"].between(F.col("b.min_y"), F.col("b.max_y")))
    ring = edges(F.array(corners(F.col("q"), F.col("r"), a)))
    hit = cells.withColumn("cs", ring).filter(polygons_intersect(F.col("es"), F.col("cs"))).select("q", "r").distinct()
    return hit.select(cell_name(F.col("q"), F.col("r"), label).alias("cell_id"), "q", "r")


def neighbours(cells: DataFrame) -> DataFrame:
    """(cell_id, nbr_id, w) between cells of the table, ``w`` being one over the number of the cell's neighbours."""
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in NEIGHBOURS))
    around = cells.select("cell_id", "q", "r", F.explode(steps).alias("s")).select("cell_id", (F.col("q") + F.col("s.i")).alias("q"), (F.col("r") + F.col("s.j")).alias("r"))
    found = around.join(cells.select(F.col("cell_id").alias("nbr_id"), "q", "r"), ["q", "r"]).select("cell_id", "nbr_id")
    degree = found.groupBy("cell_id").agg(F.count(F.lit(1)).alias("d"))
    return found.join(degree, "cell_id").select("cell_id", "nbr_id", (F.lit(1.0) / F.col("d")).alias("w"))
