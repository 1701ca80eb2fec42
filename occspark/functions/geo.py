"""Planar geometry and map projections as column expressions.

A ring is an array of (x, y) with the first point repeated at the end; an edge is a struct of
doubles (x1, y1, x2, y2). Everything is evaluated in the JVM, but for ``metres`` and ``with_metric_edges``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

# GRS80 and the parameters of EPSG:3035, and the sphere of EPSG:3857.
A, E2 = 6378137.0, 0.006694380022900788
LAT0, LON0, FE, FN = math.radians(52.0), math.radians(10.0), 4321000.0, 3210000.0
_E = math.sqrt(E2)


def _q(sin_phi: float) -> float:
    return (1 - E2) * (sin_phi / (1 - E2 * sin_phi**2) - math.log((1 - _E * sin_phi) / (1 + _E * sin_phi)) / (2 * _E))


QP = _q(1.0)
RQ = A * math.sqrt(QP / 2)
BETA0 = math.asin(_q(math.sin(LAT0)) / QP)
D = A * math.cos(LAT0) / math.sqrt(1 - E2 * math.sin(LAT0) ** 2) / (RQ * math.cos(BETA0))
SIN_B0, COS_B0 = math.sin(BETA0), math.cos(BETA0)


def laea(lon: Column, lat: Column) -> Column:
    """EPSG:4326 degrees to EPSG:3035 metres (Lambert azimuthal equal area), as struct(x, y)."""
    s = F.sin(F.radians(lat))
    q = F.lit(1 - E2) * (s / (F.lit(1.0) - F.lit(E2) * s * s) - F.lit(1 / (2 * _E)) * F.ln((F.lit(1.0) - F.lit(_E) * s) / (F.lit(1.0) + F.lit(_E) * s)))
    sin_b = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), q / F.lit(QP)))
    cos_b = F.sqrt(F.lit(1.0) - sin_b * sin_b)
    dl = F.radians(lon) - F.lit(LON0)
    b = F.lit(RQ) * F.sqrt(F.lit(2.0) / (F.lit(1.0) + F.lit(SIN_B0) * sin_b + F.lit(COS_B0) * cos_b * F.cos(dl)))
    x = F.lit(FE) + b * F.lit(D) * cos_b * F.sin(dl)
    y = F.lit(FN) + b / F.lit(D) * (F.lit(COS_B0) * sin_b - F.lit(SIN_B0) * cos_b * F.cos(dl))
    return F.struct(x.alias("x"), y.alias("y"))


def _each(f, values: np.ndarray) -> np.ndarray:
    return np.fromiter(map(f, values.tolist()), np.float64, len(values))


def project(lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``laea`` by the sines and logarithms of the C library, as SQL engines have them; NaN where a coordinate is not finite.

    The JVM's are often the double beside, which moves a place by some nanometres and a distance over a rounding.
    """
    known = np.isfinite(lon) & np.isfinite(lat)
    x, y = np.full(len(lon), np.nan), np.full(len(lon), np.nan)
    s, dl = _each(math.sin, lat[known] * (math.pi / 180)), lon[known] * (math.pi / 180) - LON0
    with np.errstate(divide="ignore", invalid="ignore"):
        q = (1 - E2) * (s / (1 - E2 * s * s) - 1 / (2 * _E) * _each(math.log, (1 - _E * s) / (1 + _E * s)))
        sin_b = np.clip(q / QP, -1, 1)
        cos_b, cos_dl = np.sqrt(1 - sin_b * sin_b), _each(math.cos, dl)
        b = RQ * np.sqrt(2 / (1 + SIN_B0 * sin_b + COS_B0 * cos_b * cos_dl))
        x[known] = FE + b * D * cos_b * _each(math.sin, dl)
        y[known] = FN + b / D * (COS_B0 * sin_b - SIN_B0 * cos_b * cos_dl)
    return x, y


def _doubles(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)


def _projected(lon: pa.Array, lat: pa.Array) -> list[pa.Array]:
    """x and y, null where a coordinate is."""
    missing = lon.is_null().to_numpy(zero_copy_only=False) | lat.is_null().to_numpy(zero_copy_only=False)
    return [pa.array(v, mask=missing) for v in project(_doubles(lon), _doubles(lat))]


def metres(lon: Column, lat: Column) -> Column:
    """``project`` as a column, struct(x, y)."""

    def run(lon: pa.Array, lat: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(_projected(lon, lat), names=["x", "y"])

    return F.arrow_udf(run, "struct<x: double, y: double>").asNondeterministic()(lon.cast("double"), lat.cast("double"))


def with_metric_edges(shapes: DataFrame) -> DataFrame:
    """``shapes`` with ``metric_edges``: the edges of ``edges`` in metres, by ``project``.

    Not a function of a column: Spark cannot evaluate one whose argument, once projections are collapsed, has a lambda in it.
    """
    kind = "array<struct<x1: double, y1: double, x2: double, y2: double>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["edges"]
            flat, sizes = lists.flatten(), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = [v for k in "12" for v in _projected(flat.field(f"x{k}"), flat.field(f"y{k}"))]
            found = pa.StructArray.from_arrays(ends, names=["x1", "y1", "x2", "y2"])
            starts = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(starts, found, mask=lists.is_null())], names=[*batch.schema.names, "metric_edges"])

    return shapes.mapInArrow(run, StructType([*shapes.schema.fields, StructField("metric_edges", DataType.fromDDL(kind))]))


def inverse_laea(x: Column, y: Column) -> Column:
    """EPSG:3035 metres to degrees, as struct(x = lon, y = lat); the series for latitude is good to a millimetre."""
    dx, dy = (x - F.lit(FE)) / F.lit(D), (y - F.lit(FN)) * F.lit(D)
    rho = F.sqrt(dx * dx + dy * dy)
    c = F.lit(2.0) * F.asin(rho / F.lit(2 * RQ))
    ratio = F.when(rho == 0, F.lit(0.0)).otherwise(dy * F.sin(c) / F.when(rho == 0, F.lit(1.0)).otherwise(rho))
    beta = F.asin(F.cos(c) * F.lit(SIN_B0) + ratio * F.lit(COS_B0))
    lon = F.lit(LON0) + F.atan2(dx * F.sin(c), rho * F.lit(COS_B0) * F.cos(c) - dy * F.lit(SIN_B0) * F.sin(c))
    k2 = E2 / 3 + 31 * E2**2 / 180 + 517 * E2**3 / 5040
    k4, k6 = 23 * E2**2 / 360 + 251 * E2**3 / 3780, 761 * E2**3 / 45360
    lat = beta + F.lit(k2) * F.sin(F.lit(2.0) * beta) + F.lit(k4) * F.sin(F.lit(4.0) * beta) + F.lit(k6) * F.sin(F.lit(6.0) * beta)
    return F.struct(F.degrees(lon).alias("x"), F.degrees(lat).alias("y"))


def mercator(lon: Column, lat: Column) -> Column:
    """EPSG:4326 degrees to EPSG:3857 metres, as struct(x, y)."""
    return F.struct((F.lit(A) * F.radians(lon)).alias("x"), (F.lit(A) * F.ln(F.tan(F.lit(math.pi / 4) + F.radians(lat) / F.lit(2.0)))).alias("y"))


def inverse_mercator(x: Column, y: Column) -> Column:
    lat = F.lit(2.0) * F.atan(F.exp(y / F.lit(A))) - F.lit(math.pi / 2)
    return F.struct(F.degrees(x / F.lit(A)).alias("x"), F.degrees(lat).alias("y"))


def to_degrees(x: Column, y: Column, srid: int) -> Column:
    """Coordinates of a known reference system in EPSG:4326."""
    if srid == 4326:
        return F.struct(x.alias("x"), y.alias("y"))
    if srid == 3035:
        return inverse_laea(x, y)
    if srid == 3857:
        return inverse_mercator(x, y)
    raise ValueError(f"EPSG:{srid} is not supported; use 4326, 3035 or 3857")


def edges(rings: Column) -> Column:
    """All edges of all rings."""

    def of(ring: Column) -> Column:
        return F.transform(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), lambda p, i: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), F.get(ring, i + 1)["x"].alias("x2"), F.get(ring, i + 1)["y"].alias("y2")))

    return F.flatten(F.transform(rings, of))


def wound(rings: Column) -> Column:
    """The rings, all wound to the left: what rounding makes of a place on an edge depends on which end the edge begins at."""

    def leftward(ring: Column) -> Column:
        x, y = F.get(ring, F.lit(0))["x"], F.get(ring, F.lit(0))["y"]
        return F.aggregate(edges(F.array(ring)), F.lit(0.0), lambda a, e: a + ((e["x1"] - x) * (e["y2"] - y) - (e["x2"] - x) * (e["y1"] - y)))

    return F.transform(rings, lambda ring: F.when(leftward(ring) < 0, F.reverse(ring)).otherwise(ring))


def project_rings(rings: Column, how=laea) -> Column:
    return F.transform(rings, lambda ring: F.transform(ring, lambda p: how(p["x"], p["y"])))


def crosses_ray(x: Column, y: Column, e: Column) -> Column:
    """A ray from the point to larger x crosses the edge; edges are half open, so a vertex counts once."""
    at = (e["x2"] - e["x1"]) * (y - e["y1"]) / F.when(e["y2"] != e["y1"], e["y2"] - e["y1"]) + e["x1"]
    return ((e["y1"] > y) != (e["y2"] > y)) & F.coalesce(x < at, F.lit(False))


def on_edge(x: Column, y: Column, e: Column) -> Column:
    cross = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
    return (cross == 0) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))


def parity(x: Column, y: Column, es: Column) -> Column:
    return F.aggregate(es, F.lit(False), lambda odd, e: odd != crosses_ray(x, y, e))


def within(x: Column, y: Column, es: Column) -> Column:
    """Inside, boundary excluded. ``es`` are the edges of all rings, holes included."""
    return parity(x, y, es) & ~F.exists(es, lambda e: on_edge(x, y, e))


def intersects(x: Column, y: Column, es: Column) -> Column:
    """Inside or on the boundary."""
    return parity(x, y, es) | F.exists(es, lambda e: on_edge(x, y, e))


def segment_distance(x: Column, y: Column, e: Column) -> Column:
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    norm = dx * dx + dy * dy
    t = F.when(norm > 0, ((x - e["x1"]) * dx + (y - e["y1"]) * dy) / F.when(norm > 0, norm)).otherwise(F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    ex, ey = x - (e["x1"] + t * dx), y - (e["y1"] + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def boundary_distance(x: Column, y: Column, es: Column) -> Column:
    return F.array_min(F.transform(es, lambda e: segment_distance(x, y, e)))


def polygon_distance(x: Column, y: Column, es: Column) -> Column:
    """Zero inside, else the distance to the boundary."""
    return F.when(parity(x, y, es), F.lit(0.0)).otherwise(boundary_distance(x, y, es))


def ring_area(ring: Column) -> Column:
    """Signed shoelace area."""
    return F.aggregate(edges(F.array(ring)), F.lit(0.0), lambda a, e: a + (e["x1"] * e["y2"] - e["x2"] * e["y1"])) / F.lit(2.0)


def area(rings: Column, parts: Column | None = None) -> Column:
    """Area of what is inside by parity: outer rings less their holes, whatever way rings are wound.

    ``parts`` has the number of each ring's part, whose first ring is the outer one. Without it a ring is a hole if it
    lies within an odd number of the others, which is told by the middle of its first edge.
    """
    size = lambda ring: F.abs(ring_area(ring))
    if parts is not None:
        sign = lambda i: F.when((i > 0) & (F.get(parts, i) == F.get(parts, F.greatest(i - 1, F.lit(0)))), F.lit(-1.0)).otherwise(F.lit(1.0))
        signed = F.transform(rings, lambda r, i: sign(i) * size(r))
    else:
        middle = lambda r, k: (F.get(r, F.lit(0))[k] + F.get(r, F.lit(1))[k]) / F.lit(2.0)
        holds = lambda other, r: parity(middle(r, "x"), middle(r, "y"), edges(F.array(other)))
        around = lambda r, i: F.size(F.filter(rings, lambda o, j: (j != i) & F.coalesce(holds(o, r), F.lit(False))))
        signed = F.transform(rings, lambda r, i: F.when(around(r, i) % 2 == 1, -size(r)).otherwise(size(r)))
    return F.aggregate(signed, F.lit(0.0), lambda a, x: a + x)


def bbox(rings: Column) -> Column:
    xs, ys = (F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p[k]))) for k in ("x", "y"))
    return F.struct(F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"), F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y"))


def _turn(ax, ay, bx, by, cx, cy) -> Column:
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def edges_cross(e: Column, f: Column) -> Column:
    """The two segments have a point in common."""
    a = _turn(e["x1"], e["y1"], e["x2"], e["y2"], f["x1"], f["y1"])
    b = _turn(e["x1"], e["y1"], e["x2"], e["y2"], f["x2"], f["y2"])
    c = _turn(f["x1"], f["y1"], f["x2"], f["y2"], e["x1"], e["y1"])
    d = _turn(f["x1"], f["y1"], f["x2"], f["y2"], e["x2"], e["y2"])
    proper = ((a > 0) != (b > 0)) & ((c > 0) != (d > 0)) & (a != 0) & (b != 0) & (c != 0) & (d != 0)
    return proper | on_edge(f["x1"], f["y1"], e) | on_edge(f["x2"], f["y2"], e) | on_edge(e["x1"], e["y1"], f) | on_edge(e["x2"], e["y2"], f)


def polygons_intersect(es: Column, fs: Column) -> Column:
    """Some edges that meet, or some vertex of one within the other: parts and holes may each lie wholly inside or outside."""
    meet = F.exists(es, lambda e: F.exists(fs, lambda f: edges_cross(e, f)))
    inside = lambda xs, ys: F.exists(xs, lambda e: intersects(e["x1"], e["y1"], ys))
    return inside(es, fs) | meet | inside(fs, es)
