"""Spatial joins without an index: tiles give an equi-join, exact predicates refine it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import bbox, intersects, metres, parity, project, within
from ..functions.geo import boundary_distance as to_boundary
from ..plans.shared import BROADCAST_BYTES, checked, cut
from .siteindex import SiteIndex

POINT_ID = "gbifID"
#: Side of a tile in degrees.
TILE = 0.5
#: Side of the first tiles of a nearest search, in metres.
NEAR_TILE = 100_000.0
#: A tile this large has every place on Earth in its neighbours.
_WHOLE = 5e7
#: Bytes of an edge.
_EDGE = 40


def _cover(box: Column, side: float) -> tuple[Column, Column]:
    """Tile columns and rows that a box touches."""
    span = lambda lo, hi: F.sequence(F.floor(box[lo] / F.lit(side)).cast("long"), F.floor(box[hi] / F.lit(side)).cast("long"))
    return span("min_x", "max_x"), span("min_y", "max_y")


def _tiles(sites: DataFrame, box: str, side: float) -> DataFrame:
    across, up = _cover(F.col(box), side)
    return sites.select("index_right", F.col(box).alias("box"), F.explode(across).alias("tx"), up.alias("up")).select("index_right", "box", "tx", F.explode("up").alias("ty"))


def _site_tiles(sites: DataFrame, side: float, carry: Sequence[str]) -> DataFrame:
    """(__tx, __ty, __box, __edges, index_right, carried columns): each site once per tile, with the edges that decide there.

    These are the ones that a ray from a place in the tile to larger x can meet: not wholly above, below or left of the tile.
    """
    across, up = _cover(F.col("bbox"), side)
    low, high = (F.col("__ty") * F.lit(side) - F.lit(1e-9), (F.col("__ty") + 1) * F.lit(side) + F.lit(1e-9))
    band = F.filter("edges", lambda e: (F.greatest(e["y1"], e["y2"]) >= low) & (F.least(e["y1"], e["y2"]) <= high))
    right = F.filter("__band", lambda e: F.greatest(e["x1"], e["x2"]) >= F.col("__tx") * F.lit(side) - F.lit(1e-9))
    rows = sites.select("index_right", *carry, "bbox", "edges", across.alias("__across"), F.explode(up).alias("__ty"))
    rows = rows.select("index_right", *carry, "bbox", "__ty", band.alias("__band"), F.explode("__across").alias("__tx"))
    return rows.select("index_right", *carry, F.col("bbox").alias("__box"), "__tx", "__ty", right.alias("__edges"))


def _few_edges(sites: DataFrame, column: str, limit: int = BROADCAST_BYTES) -> bool:
    """Whether all shapes together have few bytes: their size is in their edges, not in their number."""
    return (sites.agg(F.sum(F.size(column) * _EDGE + 200)).first()[0] or 0) <= limit


def _index(sites: DataFrame, side: float, limit: int) -> tuple[SiteIndex, np.ndarray, pa.Table] | None:
    """The index of sites of few bytes, their numbers and their shapes; none for more, or where numbers are no key."""
    if sites.schema["index_right"].dataType.simpleString() != "bigint" or not _few_edges(sites, "edges", limit):
        return None
    table = sites.select("index_right", "bbox", "edges", "metric_edges").toArrow()
    ids = table["index_right"]
    index = SiteIndex.of(table, side) if ids.null_count == 0 and len(ids.unique()) == len(ids) else None
    return None if index is None else (index, ids.to_numpy(), table)


def _arrays(place: np.ndarray, n: int, values: pa.Array) -> pa.Array:
    """The values of each of ``n`` places as an array; they are sorted by place."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(place, np.arange(n + 1)).astype(np.int32)), values)


def _doubles(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)


def _with_sites(points: DataFrame, index: SiteIndex, ids: np.ndarray, boundary: bool) -> DataFrame:
    """``points`` with ``__at``, the numbers of the sites that hold each: only coordinates go to Python and only numbers come back."""
    sent = points.sparkSession.sparkContext.broadcast((index, ids))

    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        index, ids = sent.value
        place, site = index.holding(_doubles(x), _doubles(y), boundary)
        return _arrays(place, len(x), pa.array(ids[site], pa.int64()))

    # As if it were not deterministic, so that no filter above makes Spark work it out twice.
    at = F.arrow_udf(run, "array<long>").asNondeterministic()
    return points.withColumn("__at", at(F.col("decimalLongitude").cast("double"), F.col("decimalLatitude").cast("double")))


def _with_attributes(rows: DataFrame, sites: DataFrame, carry: Sequence[str]) -> DataFrame:
    """``index_right`` and the columns ``carry`` of the site whose number is in ``__at``."""
    if carry:
        of = sites.select(F.col("index_right").alias("__site"), *carry)
        rows = rows.join(F.broadcast(of), F.col("__at") == F.col("__site"), "left").drop("__site")
    kept = [c for c in rows.columns if c not in ("__at", *carry)]
    return rows.select(*kept, F.col("__at").alias("index_right"), *carry)


def _probe(points: DataFrame, sites: DataFrame, test, side: float, limit: int, how: str, carry: Sequence[str]) -> DataFrame:
    """``points`` joined to the sites that hold them, row by row: points need no id, and rows that repeat stay apart.

    Sites of few bytes are broadcast as an index, which gives each point its sites; their attributes join by number. Others
    join by tile: a point meets a site only in the tile that both share, so there is one row for each pair, and the whole
    test is the join's condition. With few edges the points are not shuffled at all, and else once, by tile, where Spark splits large keys.
    """
    found = _index(sites, side, limit) if test in (within, intersects) else None
    if found is not None:
        at = _with_sites(points, *found[:2], test is intersects)
        if how == "left_semi":
            return at.filter(F.size("__at") > 0).drop("__at")
        explode = F.explode_outer if how == "left" else F.explode
        return _with_attributes(at.select(*points.columns, explode("__at").alias("__at")), sites, carry)
    tiles = cut(_site_tiles(sites, side, carry))
    lon, lat = points["decimalLongitude"], points["decimalLatitude"]
    at = points.withColumns({"__x": lon, "__y": lat, "__px": F.floor(lon / F.lit(side)).cast("long"), "__py": F.floor(lat / F.lit(side)).cast("long")})
    x, y, box = F.col("__x"), F.col("__y"), F.col("__box")
    on = (F.col("__px") == F.col("__tx")) & (F.col("__py") == F.col("__ty"))
    on = on & x.between(box["min_x"], box["max_x"]) & y.between(box["min_y"], box["max_y"]) & test(x, y, F.col("__edges"))
    found = at.join(checked(tiles, _few_edges(tiles, "__edges", limit)), on, how)
    return found.drop("__x", "__y", "__px", "__py", "__tx", "__ty", "__box", "__edges")


def containing_pairs(points: DataFrame, sites: DataFrame, test=within, side: float = TILE, limit: int = BROADCAST_BYTES, carry: Sequence[str] = ()) -> DataFrame:
    """(gbifID, index_right) of each point and each site that holds it, with the site's columns ``carry``; a row per pair of rows.

    ``points``: gbifID, decimalLongitude, decimalLatitude. ``sites``: as prepared.
    """
    return _probe(points.select(POINT_ID, "decimalLongitude", "decimalLatitude"), sites, test, side, limit, "inner", carry).select(POINT_ID, "index_right", *carry)


def join_sites(points: DataFrame, sites: DataFrame, side: float = TILE, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Left join: each row of points once per site that it lies within, or once with null site columns.

    Rows are joined as they are, whether or not their ids repeat or are null. Site columns replace those of their names.
    """
    kept = [c for c in sites.columns if c not in ("index_right", "rings", "ring_parts", "edges", "metric_edges", "bbox")]
    return _probe(points.drop("index_right", *kept), sites, within, side, limit, "left", kept)


def join_with_distances(points: DataFrame, sites: DataFrame, max_distance: float | None = None, side: float = TILE, limit: int = BROADCAST_BYTES) -> DataFrame | None:
    """``join_sites`` with ``dist_to_boundary_m`` of inside rows and ``dist_to_polygon_m`` of the others, in one pass; none if sites have too many bytes.

    As ``add_inside_distances`` and ``add_nearest_distances`` measure them.
    """
    found = _index(sites, side, limit)
    if found is None:
        return None
    kept = [c for c in sites.columns if c not in ("index_right", "rings", "ring_parts", "edges", "metric_edges", "bbox")]
    points = points.drop("index_right", *kept)
    index, ids, table = found
    tree = SiteTree.of(table) if len(index.metric) else None
    sent = points.sparkSession.sparkContext.broadcast((index, ids, tree))

    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        index, ids, tree = sent.value
        x, y = _doubles(x), _doubles(y)
        mx, my = project(x, y)
        place, site = index.holding(x, y, False)
        out = np.flatnonzero(np.bincount(place, minlength=len(x)) == 0)
        order = np.argsort(np.r_[place, out], kind="stable")
        inside = np.r_[np.ones(len(place), dtype=bool), np.zeros(len(out), dtype=bool)][order]
        number, near, far = np.zeros(len(order), np.int64), np.zeros(len(order)), np.full(len(order), np.nan)
        number[inside], near[inside] = ids[site], index.to_boundary(mx[place], my[place], site)
        known = np.isfinite(x[out]) & np.isfinite(y[out]) & np.isfinite(mx[out]) & np.isfinite(my[out])
        measured = np.full(len(out), np.nan)
        if tree is not None and known.any():
            measured[known] = tree.distances(mx[out[known]], my[out[known]])
        if max_distance is not None:
            measured[measured > max_distance] = np.nan
        far[~inside] = measured
        columns = [pa.array(number, mask=~inside), pa.array(near, mask=~inside), pa.array(far, mask=np.isnan(far))]
        return _arrays(np.r_[place, out][order], len(x), pa.StructArray.from_arrays(columns, names=["site", "near", "far"]))

    at = F.arrow_udf(run, "array<struct<site: long, near: double, far: double>>").asNondeterministic()
    lon, lat = F.col("decimalLongitude").cast("double"), F.col("decimalLatitude").cast("double")
    rows = points.withColumn("__hits", at(lon, lat))
    rows = rows.select(*points.columns, F.explode("__hits").alias("__hit"))
    rows = rows.select(*points.columns, F.col("__hit.near").alias("dist_to_boundary_m"), F.col("__hit.far").alias("dist_to_polygon_m"), F.col("__hit.site").alias("__at"))
    return _with_attributes(rows, sites, kept)


def points_in_area(points: DataFrame, area: DataFrame, name: str, side: float = TILE, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Points that lie within or on any polygon of a study area, each row once, with ``study_area_name``.

    The polygons act as their union, which need not be formed. A point without coordinates is dropped.
    """
    return _probe(points, area, intersects, side, limit, "left_semi", ()).withColumn("study_area_name", F.lit(name))


def _box_bounds() -> tuple[Column, Column]:
    """The least and the greatest distance from (x, y) to any place of ``box``."""
    x, y, b = F.col("x"), F.col("y"), F.col("box")
    out = lambda v, lo, hi: F.greatest(lo - v, v - hi, F.lit(0.0))
    far = lambda v, lo, hi: F.greatest(F.abs(v - lo), F.abs(v - hi))
    of = lambda f: F.hypot(f(x, b["min_x"], b["max_x"]), f(y, b["min_y"], b["max_y"]))
    return of(out).alias("nearest"), of(far).alias("farthest")


def _metric(points: DataFrame) -> DataFrame:
    """The distinct places of points, with x and y in metres."""
    places = points.select("decimalLongitude", "decimalLatitude").filter("decimalLongitude is not null and decimalLatitude is not null").distinct()
    at = places.withColumn("m", metres(F.col("decimalLongitude"), F.col("decimalLatitude")))
    return at.select("decimalLongitude", "decimalLatitude", F.col("m.x").alias("x"), F.col("m.y").alias("y"))


def add_inside_distances(joined: DataFrame, sites: DataFrame) -> DataFrame:
    """Inside rows of ``joined`` with ``dist_to_boundary_m``: metres from each row's point to the boundary of the row's own site."""
    shapes = sites.select(F.col("index_right").alias("__site"), F.col("metric_edges").alias("__metric"))
    few = _few_edges(shapes, "__metric")
    m = joined.filter("index_right is not null").withColumn("__m", metres(F.col("decimalLongitude"), F.col("decimalLatitude")))
    out = m.join(checked(shapes, few), F.col("index_right") == F.col("__site"), "left")
    return out.withColumn("dist_to_boundary_m", to_boundary(F.col("__m.x"), F.col("__m.y"), F.col("__metric"))).drop("__m", "__site", "__metric")


def inside_distances(joined: DataFrame, sites: DataFrame) -> DataFrame:
    """(gbifID, index_right, dist_to_boundary_m) of inside rows, as ``add_inside_distances``."""
    return add_inside_distances(joined, sites).select(POINT_ID, "index_right", "dist_to_boundary_m")


@dataclass(frozen=True)
class SiteTree:
    """Boxes of sites packed into groups of neighbours, and their edges in metres."""

    groups: np.ndarray  # (groups, 4): boxes around the boxes
    firsts: np.ndarray
    boxes: np.ndarray  # (sites, 4), in the order of groups
    starts: np.ndarray  # of each site's edges
    edges: np.ndarray  # (edges, 4)

    @classmethod
    def of(cls, sites: pa.Table) -> SiteTree:
        lists = sites["metric_edges"].combine_chunks()
        flat = lists.flatten()
        edges = np.stack([flat.field(k).to_numpy(zero_copy_only=False) for k in ("x1", "y1", "x2", "y2")], axis=1)
        sizes = np.diff(lists.offsets.to_numpy())
        at, edges = lists.offsets.to_numpy()[:-1][sizes > 0] - lists.offsets.to_numpy()[0], edges
        sizes = sizes[sizes > 0]
        ends = np.stack([np.minimum(edges[:, 0], edges[:, 2]), np.minimum(edges[:, 1], edges[:, 3]), -np.maximum(edges[:, 0], edges[:, 2]), -np.maximum(edges[:, 1], edges[:, 3])], axis=1)
        boxes = np.minimum.reduceat(ends, at, axis=0) * np.array([1, 1, -1, -1])
        # Sorted into columns by x, and within a column by y; a group is a run of neighbours of one column.
        per = max(1, round(len(boxes) ** 0.5))
        x, y = boxes[:, 0] + boxes[:, 2], boxes[:, 1] + boxes[:, 3]
        column = np.empty(len(boxes), dtype=np.int64)
        column[np.argsort(x, kind="stable")] = np.arange(len(boxes)) // max(1, round(per**1.5))
        order = np.lexsort((y, column))
        firsts = np.arange(0, len(boxes), per)
        around = np.minimum.reduceat(boxes[order] * np.array([1, 1, -1, -1]), firsts, axis=0) * np.array([1, 1, -1, -1])
        taken = np.concatenate([np.arange(at[i], at[i] + sizes[i]) for i in order])
        return cls(around, np.r_[firsts, len(boxes)], boxes[order], np.r_[0, np.cumsum(sizes[order])], edges[taken])

    def distances(self, x: np.ndarray, y: np.ndarray, block: int = 256) -> np.ndarray:
        """From each place to the nearest site, 0 inside one."""
        return np.concatenate([np.empty(0), *(self._block(x[i : i + block], y[i : i + block]) for i in range(0, len(x), block))])

    def _block(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        near, far = _box_distances(x[:, None], y[:, None], self.groups[None])
        p, g = np.nonzero(near <= far.min(axis=1)[:, None])
        sizes = np.diff(self.firsts)[g]
        p, s = np.repeat(p, sizes), np.repeat(self.firsts[g] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        near, far = _box_distances(x[p], y[p], self.boxes[s])
        least = np.full(len(x), np.inf)
        np.minimum.at(least, p, far)
        kept = near <= least[p]
        p, s, out = p[kept], s[kept], np.full(len(x), np.inf)
        n = np.diff(self.starts)[s]
        cuts = np.searchsorted(np.cumsum(n), np.arange(0, n.sum(), 500_000), side="left")
        for i, j in zip(np.unique(cuts), np.r_[np.unique(cuts)[1:], len(n)], strict=True):
            np.minimum.at(out, p[i:j], self._polygon_distances(x[p[i:j]], y[p[i:j]], s[i:j], n[i:j]))
        return out

    def _polygon_distances(self, x: np.ndarray, y: np.ndarray, s: np.ndarray, n: np.ndarray) -> np.ndarray:
        first = np.r_[0, np.cumsum(n)[:-1]]
        e = self.edges[np.repeat(self.starts[s] - first, n) + np.arange(n.sum())]
        x1, y1, x2, y2 = e.T
        px, py = np.repeat(x, n), np.repeat(y, n)
        dx, dy = x2 - x1, y2 - y1
        norm = dx * dx + dy * dy
        t = np.clip(((px - x1) * dx + (py - y1) * dy) / np.where(norm > 0, norm, 1), 0, 1) * (norm > 0)
        ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
        away = np.sqrt(np.minimum.reduceat(ex * ex + ey * ey, first))
        meets = ((y1 > py) != (y2 > py)) & (px < dx * (py - y1) / np.where(dy != 0, dy, 1) + x1)
        return np.where(np.add.reduceat(meets.astype(np.int64), first) % 2 == 1, 0.0, away)


def _box_distances(x: np.ndarray, y: np.ndarray, boxes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest distance from places to any place of boxes."""
    x0, y0, x1, y1 = np.moveaxis(boxes, -1, 0)
    near = np.hypot(np.maximum(np.maximum(x0 - x, x - x1), 0), np.maximum(np.maximum(y0 - y, y - y1), 0))
    return near, np.hypot(np.maximum(np.abs(x - x0), np.abs(x - x1)), np.maximum(np.abs(y - y0), np.abs(y - y1)))


def _by_tree(places: DataFrame, sites: DataFrame) -> DataFrame:
    tree = places.sparkSession.sparkContext.broadcast(SiteTree.of(sites.select("metric_edges").toArrow()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = tree.value.distances(batch["x"].to_numpy(), batch["y"].to_numpy())
            yield pa.RecordBatch.from_arrays([batch["decimalLongitude"], batch["decimalLatitude"], pa.array(found)], names=["decimalLongitude", "decimalLatitude", "dist_to_polygon_m"])

    return places.mapInArrow(run, "decimalLongitude double, decimalLatitude double, dist_to_polygon_m double")


def _by_tiles(places: DataFrame, boxes: DataFrame, side: float, max_distance: float | None) -> DataFrame:
    """By rounds of growing tiles, where the sites are too large to be broadcast.

    In each round a place meets the sites of its tile and the eight around it. No site nearer than one
    tile side is missed, so places whose least distance is within it are done; the others go on
    with tiles twice the side. Before it meets sites a place meets the boxes around all sites of each tile, and goes only to tiles that begin no
    farther than another ends.
    """
    key = ["decimalLongitude", "decimalLatitude"]
    pending, done = cut(places), None
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    by_place = Window.partitionBy(*key)
    while True:
        tiles = cut(_tiles(boxes, "mbox", side))
        low, high = (F.struct(*(f(F.col(f"box.{k}_{c}")).alias(f"{k}_{c}") for c in "xy")) for k, f in (("min", F.min), ("max", F.max)))
        around = tiles.groupBy("tx", "ty").agg(low.alias("low"), high.alias("high"))
        around = around.select("tx", "ty", F.struct("low.min_x", "low.min_y", "high.max_x", "high.max_y").alias("box"))
        at = pending.withColumn("s", F.explode(steps))
        at = at.select(*key, "x", "y", (F.floor(F.col("x") / F.lit(side)) + F.col("s.i")).cast("long").alias("tx"), (F.floor(F.col("y") / F.lit(side)) + F.col("s.j")).cast("long").alias("ty"))
        at = at.join(checked(cut(around)), ["tx", "ty"]).select(*key, "x", "y", "tx", "ty", *_box_bounds())
        at = at.withColumn("least", F.min("farthest").over(by_place)).filter("nearest <= least").select(*key, "x", "y", "tx", "ty")
        pairs = at.join(checked(tiles), ["tx", "ty"]).select(*key, "x", "y", "index_right", *_box_bounds())
        # Only sites whose box begins nearer than another's ends can be the nearest; edges are measured for these.
        pairs = pairs.withColumn("least", F.min("farthest").over(by_place)).filter("nearest <= least").select(*key, "x", "y", "nearest", "index_right")
        measured = pairs.join(boxes.select("index_right", "metric_edges").hint("merge"), "index_right")
        x, y, es = F.col("x"), F.col("y"), F.col("metric_edges")
        distance = F.when((F.col("nearest") == 0) & parity(x, y, es), F.lit(0.0)).otherwise(to_boundary(x, y, es))
        measured = measured.groupBy(*key).agg(F.min(distance).alias("dist_to_polygon_m"))
        last = side >= _WHOLE or (max_distance is not None and side >= max_distance)
        found = cut(measured if last else measured.filter(F.col("dist_to_polygon_m") <= F.lit(side)))
        done = found if done is None else done.unionByName(found)
        pending = cut(pending.join(found.select(*key), key, "left_anti"))
        if last or not pending.limit(1).count():
            return done
        side *= 2


def place_distances(points: DataFrame, sites: DataFrame, side: float = NEAR_TILE, max_distance: float | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(decimalLongitude, decimalLatitude, dist_to_polygon_m): metres to the nearest site of each distinct place.

    Sites of few bytes are broadcast as a packed tree, in which a place meets few of them; others are searched by rounds of
    growing tiles. Beyond ``max_distance``, and without sites, the distance is null.
    """
    boxes = cut(sites.select("index_right", "metric_edges", bbox(F.array(F.transform("metric_edges", lambda e: F.struct(e["x1"].alias("x"), e["y1"].alias("y"))))).alias("mbox")).filter("size(metric_edges) > 0"))
    places = _metric(points)
    if not boxes.limit(1).count():
        return places.select("decimalLongitude", "decimalLatitude", F.lit(None).cast("double").alias("dist_to_polygon_m"))
    found = _by_tree(places, boxes) if _few_edges(boxes, "metric_edges", limit) else _by_tiles(places, boxes, side, max_distance)
    return found if max_distance is None else found.filter(F.col("dist_to_polygon_m") <= F.lit(max_distance))


def add_nearest_distances(points: DataFrame, sites: DataFrame, side: float = NEAR_TILE, max_distance: float | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``points`` with ``dist_to_polygon_m``, row by row; null where there are no coordinates or no site is near enough."""
    found = cut(place_distances(points, sites, side, max_distance, limit)).withColumnsRenamed({"decimalLongitude": "__lon", "decimalLatitude": "__lat"})
    on = (points["decimalLongitude"] == F.col("__lon")) & (points["decimalLatitude"] == F.col("__lat"))
    return points.join(found, on, "left").drop("__lon", "__lat")


def nearest_distances(points: DataFrame, sites: DataFrame, side: float = NEAR_TILE, max_distance: float | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(gbifID, dist_to_polygon_m) of each row, as ``add_nearest_distances``."""
    return add_nearest_distances(points.select(POINT_ID, "decimalLongitude", "decimalLatitude"), sites, side, max_distance, limit).select(POINT_ID, "dist_to_polygon_m")
