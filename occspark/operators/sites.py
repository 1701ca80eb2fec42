"""Site polygons: preparation, selection, areas and health."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import area, bbox, edges, parity, project_rings, to_degrees, with_metric_edges, wound
from .profile import describe
from ..schemas import SITE_COLUMNS


def prepare_sites(layer: DataFrame, srid: int | None = 4326) -> DataFrame:
    """A polygon layer (``index_right``, ``rings``, ``ring_parts`` if it has them, attributes) in degrees with all that joins need.

    Attributes that the layer lacks are left out. Edges in degrees and in metres and the bounding
    box are worked out once, to be stored with the sites. Edges go around every ring the same way, so that a ring
    holds the same places whichever way it was wound; ``rings`` stay as they are.
    """
    if srid is None:
        raise ValueError("the site layer has no reference system")
    kept = [c for c in [*SITE_COLUMNS, "INSPIRE_ID", "ring_parts"] if c in layer.columns]
    rings = F.col("rings") if srid == 4326 else F.transform("rings", lambda r: F.transform(r, lambda p: to_degrees(p["x"], p["y"], srid)))
    # Other columns go only after the last step, so that a filter on one of them still finds it.
    out = layer.drop("edges", "bbox", "metric_edges").withColumn("rings", rings)
    out = with_metric_edges(out.withColumns({"edges": edges(wound(F.col("rings"))), "bbox": bbox(F.col("rings"))}))
    return out.select("index_right", *kept, "rings", "edges", "bbox", "metric_edges")


def select_sites(sites: DataFrame, mode: str, value) -> DataFrame:
    """Sites by ``site_code``, ``site_code_list`` or ``member_state``."""
    if mode == "site_code":
        return sites.filter(F.col("SITECODE") == value)
    if mode == "site_code_list":
        if not value:
            raise ValueError("the list of site codes is empty")
        return sites.filter(F.col("SITECODE").isin(*value))
    if mode == "member_state":
        return sites.filter(F.col("MS") == value)
    raise ValueError(f"unknown selection mode {mode}")


def site_areas(sites: DataFrame) -> DataFrame:
    """Area in square kilometres, in the equal-area plane: parts less their holes, however rings are wound."""
    parts = F.col("ring_parts") if "ring_parts" in sites.columns else None
    return sites.withColumn("area_km2", area(project_rings(F.col("rings")), parts) / F.lit(1e6))


def area_statistics(sites: DataFrame) -> DataFrame:
    """(count, mean, std, min, q25, q50, q75, max) of site areas in square kilometres."""
    return describe(site_areas(sites), "area_km2").drop("field")


def geometry_types(sites: DataFrame) -> DataFrame:
    """(geometry_type, n): how many sites have each type, a null geometry's being null.

    As read from a file (``geometry_type``), and else by their parts: several outer rings make a MULTIPOLYGON.
    """
    kind = F.col("geometry_type") if "geometry_type" in sites.columns else F.when(F.col("rings").isNotNull(), F.when(_outer_rings(sites) > 1, "MULTIPOLYGON").otherwise("POLYGON"))
    return sites.groupBy(kind.alias("geometry_type")).agg(F.count(F.lit(1)).alias("n"))


def _outer_rings(sites: DataFrame):
    if "ring_parts" in sites.columns:
        return F.size(F.array_distinct("ring_parts"))
    middle = lambda r, k: (F.get(r, F.lit(0))[k] + F.get(r, F.lit(1))[k]) / F.lit(2.0)
    holds = lambda o, r: F.coalesce(parity(middle(r, "x"), middle(r, "y"), edges(F.array(o))), F.lit(False))
    around = lambda r, i: F.size(F.filter("rings", lambda o, j: (j != i) & holds(o, r)))
    return F.size(F.filter("rings", lambda r, i: around(r, i) % 2 == 0))


def _turn(e: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """On which side of edges (x1, y1, x2, y2) places are: positive left, zero in line."""
    return (e[:, 2] - e[:, 0]) * (y - e[:, 1]) - (e[:, 3] - e[:, 1]) * (x - e[:, 0])


def _close_pairs(e: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of edges whose boxes meet, some at a time: in the order of their least x, those that begin before the first one ends."""
    low, high = np.minimum(e[:, :2], e[:, 2:]), np.maximum(e[:, :2], e[:, 2:])
    order = np.argsort(low[:, 0], kind="stable")
    n = np.searchsorted(low[order, 0], high[order, 0], side="right") - np.arange(1, len(order) + 1)
    cuts = np.unique(np.searchsorted(np.cumsum(n), np.arange(0, n.sum() + 1, most)))
    for at, to in zip(cuts, np.r_[cuts[1:], len(order)], strict=True):
        i = np.repeat(np.arange(at, to), n[at:to])
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n[at:to]) - n[at:to], n[at:to])
        i, j = order[i], order[j]
        near = (low[i, 1] <= high[j, 1]) & (low[j, 1] <= high[i, 1])
        yield i[near], j[near]


def _rings_are_valid(rings: list[np.ndarray]) -> bool:
    """Closed rings of four points at least that neither cross or touch themselves nor cross or overlap one another.

    Neighbours in a ring may share their common corner alone; edges of different rings may touch at a corner. Repeated
    points are no edges.
    """
    rings = [r[np.r_[True, (r[1:] != r[:-1]).any(axis=1)]] if len(r) else r for r in rings]
    if any(len(r) < 4 or (r[0] != r[-1]).any() for r in rings):
        return False
    e = np.concatenate([np.hstack([r[:-1], r[1:]]) for r in rings])
    sizes = [len(r) - 1 for r in rings]
    ring, size, nth = np.repeat(np.arange(len(rings)), sizes), np.repeat(sizes, sizes), np.concatenate([np.arange(n) for n in sizes])
    for i, j in _close_pairs(e):
        a, b = e[i], e[j]
        at_a, at_b = (_turn(a, b[:, 0], b[:, 1]), _turn(a, b[:, 2], b[:, 3])), (_turn(b, a[:, 0], a[:, 1]), _turn(b, a[:, 2], a[:, 3]))
        through = (at_a[0] * at_a[1] < 0) & (at_b[0] * at_b[1] < 0)
        # Boxes that meet and an end in line with the other edge: the end lies on it, if it lies in its box.
        inside = lambda x, y, f: (np.minimum(f[:, 0], f[:, 2]) <= x) & (x <= np.maximum(f[:, 0], f[:, 2])) & (np.minimum(f[:, 1], f[:, 3]) <= y) & (y <= np.maximum(f[:, 1], f[:, 3]))
        ends = [(at_a[k] == 0) & inside(b[:, 2 * k], b[:, 2 * k + 1], a) for k in (0, 1)] + [(at_b[k] == 0) & inside(a[:, 2 * k], a[:, 2 * k + 1], b) for k in (0, 1)]
        touch = np.logical_or.reduce(ends)
        shared = np.minimum(np.maximum(a[:, :2], a[:, 2:]), np.maximum(b[:, :2], b[:, 2:])) - np.maximum(np.minimum(a[:, :2], a[:, 2:]), np.minimum(b[:, :2], b[:, 2:]))
        along = touch & (at_a[0] == 0) & (at_a[1] == 0) & (shared.max(axis=1) > 0)  # in one line, with more than a point in common
        same, gap = ring[i] == ring[j], np.abs(nth[i] - nth[j])
        beside = same & ((gap == 1) | (gap == size[i] - 1))
        if (through | along | (same & ~beside & touch)).any():
            return False
    return True


def geometry_validity(sites: DataFrame) -> DataFrame:
    """``sites`` with ``is_valid``: null for a null geometry, true for an empty one."""
    kept = [c for c in sites.columns if c != "is_valid"]
    shape = sites.select(*kept).schema.add("is_valid", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = []
            for rings in batch["rings"].to_pylist():
                said.append(None if rings is None else _rings_are_valid([np.array([(p["x"], p["y"]) for p in r], dtype=float).reshape(-1, 2) for r in rings]) if rings else True)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(said, pa.bool_())], names=[*kept, "is_valid"])

    return sites.select(*kept).mapInArrow(run, shape)


def largest_sites(sites: DataFrame, k: int = 10) -> DataFrame:
    return site_areas(sites).orderBy(F.desc("area_km2"), "SITECODE").limit(k).select(*(c for c in SITE_COLUMNS if c in sites.columns), "area_km2")


def site_health(sites: DataFrame) -> DataFrame:
    """Counters of a layer: missing, empty and invalid geometries, short or open rings, repeated codes, extent."""
    sites = geometry_validity(sites.select("SITECODE", "rings"))
    r = F.col("rings")
    has = lambda test: F.coalesce(F.exists(r, test), F.lit(False))
    box = bbox(r)
    n = lambda cond: F.coalesce(F.sum(cond.cast("long")), F.lit(0))
    codes = F.count_distinct("SITECODE") + F.coalesce(F.max(F.when(F.col("SITECODE").isNull(), 1)), F.lit(0))
    return sites.agg(
        F.count(F.lit(1)).alias("n_sites"),
        n(r.isNull()).alias("n_missing"),
        n(F.coalesce(F.size(r) == 0, F.lit(False))).alias("n_empty"),
        n(has(lambda x: F.size(x) < 4)).alias("n_short_rings"),
        n(has(lambda x: (F.size(x) > 0) & (F.get(x, F.lit(0)) != F.get(x, F.size(x) - 1)))).alias("n_open_rings"),
        n(F.coalesce(F.size(r) > 1, F.lit(False))).alias("n_multi_ring"),
        n(F.coalesce(~F.col("is_valid"), F.lit(False))).alias("n_invalid"),
        (F.count(F.lit(1)) - codes).cast("long").alias("n_duplicate_codes"),
        F.min(box["min_x"]).alias("min_lon"),
        F.min(box["min_y"]).alias("min_lat"),
        F.max(box["max_x"]).alias("max_lon"),
        F.max(box["max_y"]).alias("max_lat"),
    )
