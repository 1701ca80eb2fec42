import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from occspark.functions.common import rounded
from occspark.functions.geo import area, intersects, inverse_laea, inverse_mercator, laea, mercator, project, project_rings, within
from occspark.operators import autocorr, figures, hexgrid, metrics, siteindex, sites, spatial, surface, uncertainty

POINT = "gbifID long, decimalLongitude double, decimalLatitude double"
LAYER = "index_right long, SITECODE string, MS string, rings array<array<struct<x double, y double>>>"


def square(x, y, w, h=None):
    h = w if h is None else h
    return [(x, y), (x, y + h), (x + w, y + h), (x + w, y), (x, y)]


@pytest.fixture(scope="module")
def layer(spark):
    rows = [
        (0, "A", "X", [square(0.0, 0.0, 4.0), square(1.0, 1.0, 1.0)]),  # with a hole
        (1, "B", "X", [square(3.0, 3.0, 4.0)]),  # overlaps A
        (2, "C", "Y", [square(20.0, 20.0, 1.0), square(22.0, 20.0, 1.0)]),  # two parts
        (3, "D", "Y", [[(30.0, 30.0), (30.0, 34.0), (32.0, 31.0), (34.0, 34.0), (34.0, 30.0), (30.0, 30.0)]]),  # concave
    ]
    return sites.prepare_sites(spark.createDataFrame(rows, LAYER))


def points(spark, *xy):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)], POINT)


def test_containment(spark, layer):
    xy = [(0.5, 0.5), (1.5, 1.5), (3.5, 3.5), (0, 2), (0, 0), (20.5, 20.5), (22.5, 20.5), (21.5, 20.5), (32, 33), (32, 30.5), (50, 50), (1, 1.5)]
    inside = {tuple(r) for r in spatial.containing_pairs(points(spark, *xy), layer, within).collect()}
    touching = {tuple(r) for r in spatial.containing_pairs(points(spark, *xy), layer, intersects).collect()}
    assert inside == {(0, 0), (2, 0), (2, 1), (5, 2), (6, 2), (9, 3)}
    assert touching - inside == {(3, 0), (4, 0), (11, 0)}
    shuffled = {tuple(r) for r in spatial.containing_pairs(points(spark, *xy), layer, within, limit=0).collect()}
    assert shuffled == inside


def test_left_join_keeps_points(spark, layer):
    rows = spatial.join_sites(points(spark, (3.5, 3.5), (50, 50), (0.5, 0.5)), layer).collect()
    assert sorted((r["gbifID"], r["SITECODE"] or "-") for r in rows) == [(0, "A"), (0, "B"), (1, "-"), (2, "A")]
    assert spatial.join_sites(points(spark, (3.5, 3.5)), layer.limit(0)).first()["index_right"] is None


def test_projections(spark):
    df = spark.createDataFrame([(5.0, 50.0)], "lon double, lat double")
    x, y = df.select(laea(F.col("lon"), F.col("lat")).alias("m")).first()["m"]
    assert (round(x, 2), round(y, 2)) == (3962799.45, 2999718.85)
    for there, back in ((laea, inverse_laea), (mercator, inverse_mercator)):
        m = df.select(there(F.col("lon"), F.col("lat")).alias("m")).select(back(F.col("m.x"), F.col("m.y")).alias("d")).first()["d"]
        assert abs(m["x"] - 5) < 1e-8 and abs(m["y"] - 50) < 1e-8


def test_area_with_hole(spark, layer):
    got = {r["index_right"]: r["a"] for r in layer.select("index_right", area(F.col("rings")).alias("a")).collect()}
    assert got[1] == 16.0 and got[2] == 2.0


def _metric_distance(p, ring):
    best = math.inf
    for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
        n = (x2 - x1) ** 2 + (y2 - y1) ** 2
        t = max(0.0, min(1.0, ((p[0] - x1) * (x2 - x1) + (p[1] - y1) * (y2 - y1)) / n)) if n else 0.0
        best = min(best, math.hypot(p[0] - x1 - t * (x2 - x1), p[1] - y1 - t * (y2 - y1)))
    return best


def test_nearest_against_brute_force(spark, layer):
    rng = random.Random(4)
    pts = points(spark, *[(rng.uniform(-30, 60), rng.uniform(-20, 70)) for _ in range(60)], (0.5, 0.5))
    got = {r["gbifID"]: r["dist_to_polygon_m"] for r in spatial.nearest_distances(pts, layer).collect()}
    rings = [[(p["x"], p["y"]) for p in ring] for r in layer.select(project_rings(F.col("rings")).alias("m")).collect() for ring in r["m"]]
    at = {r["gbifID"]: r["m"] for r in pts.select("gbifID", laea(F.col("decimalLongitude"), F.col("decimalLatitude")).alias("m")).collect()}
    inside = {r["gbifID"] for r in spatial.containing_pairs(pts, layer).collect()}
    for k, m in at.items():
        want = 0.0 if k in inside else min(_metric_distance((m["x"], m["y"]), r) for r in rings)
        assert abs(got[k] - want) < 1e-3, k
    near = {r["gbifID"]: r["dist_to_polygon_m"] for r in spatial.nearest_distances(pts, layer, max_distance=500_000.0).collect()}
    assert near == {k: v if v <= 500_000 else None for k, v in got.items()}
    assert spatial.nearest_distances(pts, layer.limit(0)).filter("dist_to_polygon_m is not null").count() == 0


def test_rows_join_as_they_are(spark, layer):
    """Repeated and null ids: three points in one site are three rows, each with its own distance and class."""
    rows = [(1, 0.5, 0.5, 10.0), (1, 0.6, 0.5, 1e9), (None, 0.5, 0.5, None), (None, 3.5, 3.5, 5.0), (1, 50.0, 50.0, 5.0), (None, 50.0, 50.0, 1e9), (7, None, 1.0, 5.0), (1, 0.5, 0.5, 10.0)]
    df = spark.createDataFrame(rows, "gbifID long, decimalLongitude double, decimalLatitude double, coordinateUncertaintyInMeters double").withColumn("MS", F.lit("clash"))
    for limit in (1 << 20, 0):
        joined = spatial.join_sites(df, layer, limit=limit)
        got = sorted((r["gbifID"] or 0, r["decimalLongitude"] or 0, r["SITECODE"] or "", r["MS"] or "") for r in joined.collect())
        assert got == sorted([(1, 0.5, "A", "X"), (1, 0.6, "A", "X"), (0, 0.5, "A", "X"), (0, 3.5, "A", "X"), (0, 3.5, "B", "X"), (1, 50.0, "", ""), (0, 50.0, "", ""), (7, 0, "", ""), (1, 0.5, "A", "X")])
        assert spatial.points_in_area(df, layer, "area", limit=limit).count() == 5
    classes = uncertainty.classify(joined, layer).collect()
    assert len(classes) == 9
    said = sorted((r["decimalLongitude"] or 0, r["coordinateUncertaintyInMeters"] or 0, r["uncertainty_class"]) for r in classes)
    assert said == [(0, 5.0, "Unclassified"), (0.5, 0, "Unclassified"), (0.5, 10.0, "Certainly Inside"), (0.5, 10.0, "Certainly Inside"), (0.6, 1e9, "Inside – Positional Uncertainty"), (3.5, 5.0, "Certainly Inside"), (3.5, 5.0, "Certainly Inside"), (50.0, 5.0, "Certainly Outside"), (50.0, 1e9, "Outside – Positional Uncertainty")]
    plan = spatial.join_sites(df, layer)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan  # the points are not shuffled


def test_parts_and_holes_of_any_winding(spark):
    ring = lambda *a, back=False: square(*map(float, a))[:: -1 if back else 1]
    shapes = [
        (0, [ring(0, 0, 1), ring(5, 0, 1, back=True)], [0, 1], 2.0),
        (1, [ring(0, 0, 4), ring(1, 1, 1)], [0, 0], 15.0),
        (2, [ring(0, 0, 4), ring(1, 1, 2, back=True), ring(1.5, 1.5, 0.5)], [0, 0, 1], 12.25),
        (3, [ring(0, 0, 4, back=True), ring(1, 1, 1, back=True), ring(9, 9, 2), ring(9.5, 9.5, 1, back=True)], [0, 0, 1, 1], 18.0),
    ]
    df = spark.createDataFrame([s[:3] for s in shapes], "k int, rings array<array<struct<x double, y double>>>, ring_parts array<int>")
    got = {r["k"]: (r["a"], r["b"]) for r in df.select("k", area(F.col("rings")).alias("a"), area(F.col("rings"), F.col("ring_parts")).alias("b")).collect()}
    assert got == {s[0]: (s[3], s[3]) for s in shapes}
    layer = df.withColumns({"index_right": F.col("k").cast("long"), "SITECODE": F.concat(F.lit("S"), "k"), "MS": F.lit("X")})
    assert {r["geometry_type"]: r["n"] for r in sites.geometry_types(layer).collect()} == {"MULTIPOLYGON": 3, "POLYGON": 1}
    assert {r["geometry_type"]: r["n"] for r in sites.geometry_types(layer.drop("ring_parts")).collect()} == {"MULTIPOLYGON": 3, "POLYGON": 1}
    prepared = sites.prepare_sites(layer)
    assert sites.area_statistics(prepared).first()["count"] == 4
    # A small part that lies wholly in a cell has that cell, wherever the first part is.
    two = prepared.filter("k = 0")
    cells = {tuple(r) for r in hexgrid.hex_grid(two, 300_000.0).collect()}
    apart = [sites.prepare_sites(spark.createDataFrame([(0, "A", "X", [r])], LAYER)) for r in shapes[0][1]]
    assert cells == {tuple(r) for a in apart for r in hexgrid.hex_grid(a, 300_000.0).collect()} and len(cells) >= 2


def test_places_on_edges_do_not_depend_on_winding(spark):
    x, y, r = 1.6749999999999998, 63.6, 0.875
    ring = [(x + r, y), (x, y + r), (x - r, y), (x, y - r), (x + r, y)]
    at = points(spark, (1.8000000000000007, 64.35), (2.4700000000000006, 63.68), (x, y), (x + r, y + r))  # two that rounding puts on either side of an edge
    found = []
    for way in (ring, ring[::-1]):
        prepared = sites.prepare_sites(spark.createDataFrame([(0, "A", "X", [way])], LAYER))
        assert [tuple(p) for p in prepared.first()["rings"][0]] == way
        found.append({row["gbifID"] for row in spatial.containing_pairs(at, prepared, within).collect()})
    assert found == [{1, 2}, {1, 2}]


def test_distances_round_as_those_of_the_sql(spark):
    """8910.2354999985 metres, which sines of the JVM make 8910.2355000005."""
    x, y, r = 12.100000000000001, 62.8, 1.25
    diamond = lambda x, y, r: [(x + r, y), (x, y + r), (x - r, y), (x, y - r), (x + r, y)]
    shape = [diamond(x, y, r), diamond(x, y, 0.5), diamond(15.225000000000001, y, 0.625)[::-1], diamond(x, 64.35, 0.05)]
    prepared = sites.prepare_sites(spark.createDataFrame([(612, "A", "X", shape), (613, "B", "X", None), (614, "C", "X", [])], LAYER))
    at = spark.createDataFrame([(1, 11.559999999999999, 63.33, 100300.0), (3, None, 63.33, 1.0)], f"{POINT}, coordinateUncertaintyInMeters double")
    for limit in (1 << 20, 0):
        got = {r["gbifID"]: r for r in uncertainty.classify_points(at, prepared, limit=limit).collect()}
        assert got[1]["dist_to_boundary_m"] == 8910.235499998473 and got[3]["uncertainty_class"] == "Unclassified"
        assert len(got) == 2


def test_distances_to_edges_against_all_of_them(spark):
    """Edges are compared in single precision first: the distance is that to the last bit, however near others are, and for edges without length."""
    rng = random.Random(11)
    ring = lambda n, x, y, r: [(x + r * math.cos(2 * math.pi * i / n), y + r * math.sin(2 * math.pi * i / n)) for i in [*range(n), 0]]
    shapes = [(i, f"S{i}", "X", [ring(4 + i % 5, 10.0, 50.0, 0.3 * i + 0.1), [(11.0, 51.0)] * 3, ring(4, 10.0, 50.0, 1e-6)]) for i in range(20)]
    table = sites.prepare_sites(spark.createDataFrame(shapes, LAYER)).select("index_right", "bbox", "edges", "metric_edges").toArrow()
    index = siteindex.SiteIndex.of(table, spatial.TILE)
    x, y = project(*(np.array([c + (rng.random() - 0.5) * s for s in (1e-5, 1.0, 30.0) for _ in range(300)] + [10.0, 11.0]) for c in (10.0, 50.0)))
    site = np.arange(len(x)) % 20
    at = table["metric_edges"].to_pylist()
    want = []
    for px, py, s in zip(x.tolist(), y.tolist(), site.tolist(), strict=True):
        away = []
        for e in at[s]:
            dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
            norm = dx * dx + dy * dy
            t = max(0.0, min(1.0, ((px - e["x1"]) * dx + (py - e["y1"]) * dy) / norm)) if norm > 0 else 0.0
            ex, ey = px - (e["x1"] + t * dx), py - (e["y1"] + t * dy)
            away.append(math.sqrt(ex * ex + ey * ey))
        want.append(min(away))
    assert index.to_boundary(x, y, site).tolist() == want
    assert index.rough.dtype == np.float32 and len(index.rough) == 5 * len(index.metric)


def test_rounding_is_that_of_the_sql(spark):
    rng = random.Random(2)
    values = [0.0, 0.0005, 0.0015, 0.0025, 1.0005, 2.6745, 0.49999999999999994, 1e12 + 0.0005, *(rng.random() * 10 ** rng.randrange(7) for _ in range(2000)), *(rng.randrange(10**7) / 2000 for _ in range(2000))]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    shown = df.select("v", rounded(F.col("v"), 3).alias("r"))
    rows = [(r["v"], r["r"]) for r in shown.collect()]
    assert "round(" not in _plan(shown)
    found = [duckdb.execute("SELECT round(CAST(? AS DOUBLE), 3)", [v]).fetchall()[0][0] for v, _ in rows]
    assert found == [r for _, r in rows]


def test_validity(spark):
    ring = lambda *a: square(*map(float, a))
    bow = [(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0), (0.0, 0.0)]
    spike = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (4.0, 6.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    touch = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 0.0), (0.0, 4.0), (0.0, 0.0)]
    doubled = [(0.0, 0.0), (0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 4.0), (4.0, 0.0), (0.0, 0.0)]
    wheel = [(math.cos(t * math.pi / 500), math.sin(t * math.pi / 500)) for t in range(1000)]
    cases = {"square": ([ring(0, 0, 4), ring(1, 1, 1)], True), "bow": ([bow], False), "spike": ([spike], False), "touch": ([touch], False), "doubled": ([doubled], True), "open": ([ring(0, 0, 4)[:-1]], False), "short": ([[(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]], False), "overlap": ([ring(0, 0, 4), ring(3, 3, 4)], False), "corner": ([ring(0, 0, 4), ring(4, 4, 4)], True), "shared": ([ring(0, 0, 4), ring(4, 0, 4)], False), "wheel": ([[*wheel, wheel[0]]], True), "empty": ([], True), "null": (None, None)}
    df = spark.createDataFrame([(k, r) for k, (r, _) in cases.items()], "SITECODE string, rings array<array<struct<x double, y double>>>")
    assert {r["SITECODE"]: r["is_valid"] for r in sites.geometry_validity(df).collect()} == {k: v for k, (_, v) in cases.items()}
    assert sites.site_health(df).first()["n_invalid"] == sum(v is False for _, v in cases.values())


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_nearest_of_many_sites_against_brute_force(spark, limit):
    rng = random.Random(6)
    rows = [(i, f"S{i}", "X", [square(rng.uniform(-10, 30), rng.uniform(36, 65), rng.uniform(0.01, 0.6)) for _ in range(rng.choice([1, 1, 3]))]) for i in range(150)]
    many = sites.prepare_sites(spark.createDataFrame(rows, LAYER))
    pts = points(spark, *[(rng.uniform(-10, 30), rng.uniform(36, 65)) for _ in range(60)], (-100.0, -50.0), *[(r[3][0][0][0] + 0.004, r[3][0][0][1] + 0.004) for r in rows[:5]])
    got = {r["gbifID"]: r["dist_to_polygon_m"] for r in spatial.nearest_distances(pts, many, limit=limit).collect()}
    rings = [[(p["x"], p["y"]) for p in ring] for r in many.select(project_rings(F.col("rings")).alias("m")).collect() for ring in r["m"]]
    inside = {r["gbifID"] for r in spatial.containing_pairs(pts, many).collect()}
    for r in pts.select("gbifID", laea(F.col("decimalLongitude"), F.col("decimalLatitude")).alias("m")).collect():
        want = 0.0 if r["gbifID"] in inside else min(_metric_distance((r["m"]["x"], r["m"]["y"]), g) for g in rings)
        assert abs(got[r["gbifID"]] - want) < 1e-3


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_points_are_classified_in_one_pass(spark):
    """The same rows as joining by tiles and measuring joined rows, without a shuffle and with one call of Python a point."""
    rng = random.Random(3)
    rings = [[(x + r, y), (x, y + r), (x - r, y), (x, y - r), (x + r, y)] for x, y, r in ((rng.randrange(400) / 10, 35 + rng.randrange(100) / 10, 0.25 + rng.randrange(7) / 4) for _ in range(60))]
    shapes = [(i, f"S{i}", "X", [ring, [(x + 6, y) for x, y in reversed(ring)]]) for i, ring in enumerate(rings)]
    many = sites.prepare_sites(spark.createDataFrame([*shapes, (60, "S60", "X", []), (61, "S61", "X", None)], LAYER))
    xy = [(rng.randrange(5000) / 100, 34 + rng.randrange(1300) / 100) for _ in range(400)] + [p for ring in rings for p in ring[:2]] + [(None, 40.0), (40.0, None), (-170.0, -80.0)]
    at = spark.createDataFrame([(i % 50, x, y, 1e3 * (i % 90)) for i, (x, y) in enumerate(xy)], f"{POINT}, coordinateUncertaintyInMeters double")
    names = ["gbifID", "decimalLongitude", "decimalLatitude", "index_right", "SITECODE", "dist_to_boundary_m", "dist_to_polygon_m", "uncertainty_class"]
    text = lambda df: sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.select(*names).collect())
    for farthest in (None, 50_000.0):
        once = uncertainty.classify_points(at, many, farthest)
        assert text(once) == text(uncertainty.classify(spatial.join_sites(at, many, limit=0), many, farthest))
    assert "Exchange hashpartitioning" not in _plan(once) and _plan(once).count("ArrowEvalPython") == 1
    apart = uncertainty.classify_points(at, many, limit=0)
    assert text(apart) == text(uncertainty.classify_points(at, many))
    inside = sorted(map(str, uncertainty.inside_distances(at, many).filter("dist_to_boundary_m >= 0").select("gbifID", "index_right").collect()))
    assert inside == sorted(map(str, spatial.containing_pairs(at, many, limit=0).select("gbifID", "index_right").collect()))
    for test in (within, intersects):
        one, two = (sorted(map(tuple, spatial.containing_pairs(at, many, test, limit=limit).collect())) for limit in (1 << 20, 0))
        assert one == two and len(one) > 100


def test_many_edges_are_indexed(spark, monkeypatch):
    """Sites whose edges in all tiles that their boxes touch are too many to look at: tiles are halved only where boundaries run."""
    rng = random.Random(5)
    ring = lambda x, y, r: [(x + r, y), (x, y + r), (x - r, y), (x, y - r), (x + r, y)]
    open_ring = [(2.0, 2.0), (9.0, 4.0), (3.0, 7.0)]  # what is inside changes beside its ends, too
    at = [(rng.randrange(200) / 10, 40 + rng.randrange(100) / 10, 1 + rng.randrange(7)) for _ in range(12)]
    shapes = [(i, f"S{i}", "X", [ring(x, y, float(r)), ring(x, y, 0.4 * r), ring(x + 2.5 * r, y, 0.5 * r)[::-1]]) for i, (x, y, r) in enumerate(at)]
    many = sites.prepare_sites(spark.createDataFrame([*shapes, (12, "S12", "X", [open_ring])], LAYER))
    xy = [(rng.randrange(-1000, 3500) / 100, 32 + rng.randrange(2500) / 100) for _ in range(1500)] + [(rng.randrange(1, 100) / 10, rng.randrange(10, 80) / 10) for _ in range(200)] + [p for s in shapes for r in s[3] for p in r]
    at = points(spark, *xy)
    monkeypatch.setattr(siteindex, "MOST_EDGES", 20_000)
    index = siteindex.SiteIndex.of(many.select("bbox", "edges", "metric_edges").toArrow(), spatial.TILE)
    assert index is not None and index.side <= spatial.TILE / 2 and len(index.whole) > 1000
    for test in (within, intersects):
        found = spatial.containing_pairs(at, many, test)
        assert "ArrowEvalPython" in _plan(found)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, spatial.containing_pairs(at, many, test, limit=0).collect()))


def test_sums_are_small(spark):
    """Rows are summed up by what a metric asks for, not by site and species at once."""
    rows = [("A", "s", "X", 2000, "in"), ("A", "t", "X", 2002, "in"), ("B", "s", "X", 2000, "in"), ("B", None, "X", None, "out"), (None, "u", "X", 2000, "out"), (None, "u", None, 2000, "out")]
    df = spark.createDataFrame(rows, "SITECODE string, scientificName string, MS string, year long, uncertainty_class string")
    gaps = metrics.site_temporal_gaps(df)
    assert not [line for line in _plan(gaps).splitlines() if "Aggregate" in line and "scientificName" in line]
    assert {r["SITECODE"]: (r["n_occurrences"], r["missing_years"]) for r in gaps.collect()} == {"A": (2, 1), "B": (2, 0)}
    found = metrics.class_metrics(df, "MS", "total", "share")
    assert "Expand" in _plan(found)
    assert {r["uncertainty_class"]: (r["n_occurrences"], r["n_sites"], r["n_species"], r["total"]) for r in found.collect()} == {"in": (3, 2, 2, 5), "out": (2, 1, 1, 5)}


def test_classes(spark, layer):
    pts = points(spark, (0.5, 0.5), (0.5, 0.5), (-0.001, 0.5), (-0.001, 0.5), (0.5, 0.5), (-9, -9))
    unc = F.when(F.col("gbifID").isin(0, 3), 1.0).when(F.col("gbifID").isin(1, 2), 1e6).when(F.col("gbifID") == 5, 10.0)
    joined = spatial.join_sites(pts.withColumn("coordinateUncertaintyInMeters", unc).withColumn("scientificName", F.lit("s")), layer)
    got = {r["gbifID"]: r for r in uncertainty.classify(joined, layer).collect()}
    assert [got[i]["uncertainty_class"] for i in range(6)] == ["Certainly Inside", "Inside – Positional Uncertainty", "Outside – Positional Uncertainty", "Certainly Outside", "Unclassified", "Certainly Outside"]
    for r in got.values():
        assert (r["dist_to_boundary_m"] is None) == (not r["baseline_within"]) and (r["dist_to_polygon_m"] is None) == r["baseline_within"]


def test_fanout(spark, layer):
    joined = spatial.join_sites(points(spark, (3.5, 3.5)).withColumn("coordinateUncertaintyInMeters", F.lit(1.0)), layer)
    mapped = uncertainty.mapping(uncertainty.classify(joined, layer))
    assert joined.count() == 2 and uncertainty.attach_by_id(joined, mapped).count() == 4


def test_fanout_by_id(spark, layer):
    """The same rows as joining by ids, which may repeat or be null, and no join of rows that are already one for each site."""
    rows = [(1, 3.5, 3.5, 1.0), (1, 0.5, 0.5, 1e9), (1, 50.0, 50.0, 5.0), (2, 3.5, 3.5, None), (None, 3.5, 3.5, 1.0), (None, 50.0, 50.0, 1.0), (3, None, 1.0, 1.0)]
    at = spark.createDataFrame(rows, f"{POINT}, coordinateUncertaintyInMeters double")
    joined = spatial.join_sites(at, layer)
    want = uncertainty.attach_by_id(joined, uncertainty.mapping(uncertainty.classify(joined, layer))).select("gbifID", "index_right", "uncertainty_class")
    want = sorted(map(str, want.collect()))
    assert len(want) == 16 + 4 + 3 + 1
    for run in (1, 2, 1000):
        got = uncertainty.fanout_by_id(at, layer, run=run)
        assert sorted(map(str, got.collect())) == want
    lines = _plan(got).splitlines()
    assert min(i for i, line in enumerate(lines) if "Generate" in line) < min(i for i, line in enumerate(lines) if "Join" in line)


def test_metrics_edges(spark):
    rows = [(1, "s", "A", "X", "t", 2000), (1, "s2", "A", "X", "t", None), (2, "u", "B", None, "t", None), (3, "v", None, None, None, 1990)]
    df = spark.createDataFrame([(k, n, c, "n", m, t, y) for k, n, c, m, t, y in rows], "taxonKey long, scientificName string, SITECODE string, SITENAME string, MS string, SITETYPE string, year long")
    by = {r["taxonKey"]: r for r in metrics.species_metrics(df).collect()}
    assert by[1]["temporal_span"] == 0 and by[1]["temporal_completeness"] == 1.0 and by[2]["temporal_completeness"] is None
    gaps = {r["SITECODE"]: r for r in metrics.site_temporal_gaps(df).collect()}
    assert gaps["A"]["gap_fraction"] == 0.0 and gaps["B"]["gap_fraction"] is None
    assert [r["MS"] for r in metrics.group_metrics(df, "MS").collect()] == ["X"]
    assert metrics.baseline_summary(df, "T").first()["n_occurrences_outside_natura"] == 1
    assert "n_years" not in metrics.site_metrics(df.drop("year")).columns
    assert metrics.baseline_summary(df.limit(0), "T").first()["pct_inside_natura"] == 0.0


def test_grid(spark, layer):
    a = 40_000.0
    grid = hexgrid.hex_grid(layer, a)
    rng = random.Random(1)
    pts = points(spark, *[(rng.uniform(0, 4), rng.uniform(0, 4)) for _ in range(300)]).withColumn("scientificName", (F.col("gbifID") % 7).cast("string"))
    inside = spatial.points_in_area(pts, layer, "area")
    cells = surface.aggregate_to_grid(grid, hexgrid.assign_cells(inside, a))
    assert cells.agg(F.sum("n_occurrences")).first()[0] == inside.count()  # no point is lost
    assert cells.count() == grid.count() == grid.select("cell_id").distinct().count()
    links = hexgrid.neighbours(grid)
    assert links.join(links.selectExpr("cell_id as nbr_id", "nbr_id as cell_id"), ["cell_id", "nbr_id"]).count() == links.count()
    assert abs(links.agg(F.sum("w")).first()[0] - links.select("cell_id").distinct().count()) < 1e-9
    assert hexgrid.hex_grid(layer, a, pad_rings=0).count() <= grid.count()


def test_moran(spark):
    cells = spark.createDataFrame([(f"hex:{q}:{r}", q, r) for q in range(6) for r in range(6)] + [("hex:90:90", 90, 90)], "cell_id string, q long, r long")
    links = hexgrid.neighbours(cells)
    y = cells.withColumn("y", F.when(F.col("q") < 3, 1.0).otherwise(0.0))
    one = autocorr.morans_i(y, links, "y").first()
    assert one["n"] == 37 and one["s0"] == 36 and one["I"] > 0.3 and abs(one["expected_I"] + 1 / 36) < 1e-12
    moved = autocorr.morans_i(y.withColumn("y", F.col("y") * 3 + 7), links, "y").first()
    assert abs(moved["I"] - one["I"]) < 1e-9
    assert autocorr.morans_i(y.withColumn("y", F.lit(1.0)), links, "y").first()["I"] is None
    p = [autocorr.morans_permutation(y.repartition(k), links, "y", 99, seed=3).first() for k in (1, 5)]
    assert p[0]["p_sim"] == p[1]["p_sim"] == 0.01 and abs(p[0]["I"] - one["I"]) < 1e-9 and "clustering" in p[0]["interpretation"]
    lisa = [autocorr.lisa(y.repartition(k), links, "y", 99, seed=3) for k in (1, 4)]
    assert sorted(map(tuple, lisa[0].select("cell_id", "p_sim", "cluster").collect())) == sorted(map(tuple, lisa[1].select("cell_id", "p_sim", "cluster").collect()))
    counts = {r["cluster"]: r["n"] for r in autocorr.cluster_counts(lisa[0]).collect()}
    assert list(counts) and sum(counts.values()) == 37 and counts["HH"] > 0 and counts["LL"] > 0


def test_histogram_and_hotspots(spark):
    cells = spark.createDataFrame([(str(i), i) for i in range(11)], "cell_id string, n_occurrences long")
    import numpy as np

    for values, n in ((list(range(11)), 3), ([0, 1, 1, 2, 5, 8, 13, 21, 300], 50), ([7, 7, 7], 10), ([0, 3, 3, 9, 27], 30)):
        df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "cell_id string, n_occurrences long")
        for nonzero in (False, True):
            counts, edges = np.histogram([v for v in values if v or not nonzero], bins=n)
            got = surface.histogram(df, "n_occurrences", n, nonzero).orderBy("bin").collect()
            assert [r["n"] for r in got] == counts.tolist()
            assert np.allclose([r["lower"] for r in got], edges[:-1]) and np.allclose([r["upper"] for r in got], edges[1:])
    assert surface.histogram(cells.limit(0), "n_occurrences", 3).count() == 0
    assert [r["n_occurrences"] for r in surface.hotspot_cells(cells, 0.95).collect()] == [10]
    a, b = (surface.grid_sample(cells.repartition(k), 4).select("cell_id").collect() for k in (1, 6))
    assert a == b and len(a) == 4


def _png(path):
    import struct
    import zlib

    import numpy as np

    data, at, parts = open(path, "rb").read(), 8, b""
    assert data[:8] == b"\x89PNG\r\n\x1a\n"
    while at < len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + size]
        assert struct.unpack_from(">I", data, at + 8 + size)[0] == zlib.crc32(kind + body)
        if kind == b"IHDR":
            width, height = struct.unpack_from(">II", body)
        parts, at = parts + (body if kind == b"IDAT" else b""), at + 12 + size
    lines = np.frombuffer(zlib.decompress(parts), dtype=np.uint8).reshape(height, 1 + 3 * width)
    assert not lines[:, 0].any()
    return lines[:, 1:].reshape(height, width, 3)


def test_figures(spark, tmp_path):
    cells = spark.createDataFrame([(q, r, float(q), None if q == 0 else q % 2) for q in range(6) for r in range(4)], "q long, r long, v double, f int")
    size = figures.map_image(cells, 100.0, str(tmp_path / "a" / "map.png"), "v", width=120)
    image = _png(tmp_path / "a" / "map.png")
    assert image.shape == (size[1], 120, 3)
    colours = {tuple(c) for c in image.reshape(-1, 3)}
    assert figures.WHITE in colours and figures.RAMP[0] in colours and figures.RAMP[-1] in colours and len(colours) == 7
    white = {}
    for kind, column, seen in (("flag", "f", {figures.COVERED, figures.EMPTY}), ("hotspot", "f", {figures.HOTSPOT, figures.EMPTY}), ("units", "f", {figures.UNIT, figures.BLACK})):
        figures.map_image(cells, 100.0, str(tmp_path / "m.png"), column, kind, width=120)
        image = _png(tmp_path / "m.png")
        assert {tuple(c) for c in image.reshape(-1, 3)} == seen | {figures.WHITE}
        white[kind] = (image == 255).all(axis=2).sum()
    assert white["flag"] == white["hotspot"] > white["units"]  # cells without a value are left white
    figures.map_image(cells.limit(0), 100.0, str(tmp_path / "none.png"), "v", width=10)
    assert (_png(tmp_path / "none.png") == 255).all()
    bars = spark.createDataFrame([(0, 10), (1, 0), (2, 5)], "bin long, n long")
    figures.histogram_image(bars, str(tmp_path / "h.png"), 120, 100)
    image = (_png(tmp_path / "h.png") == figures.BAR).all(axis=2)
    assert image[:, 20].sum() == 80 and image[:, 60].sum() == 0 and image[:, 100].sum() == 40


def test_sites(spark, layer):
    with pytest.raises(ValueError):
        sites.select_sites(layer, "site_code_list", [])
    with pytest.raises(ValueError):
        sites.select_sites(layer, "colour", "red")
    with pytest.raises(ValueError):
        sites.prepare_sites(layer, None)
    h = sites.site_health(layer).first()
    assert (h["n_sites"], h["n_short_rings"], h["n_open_rings"], h["n_multi_ring"], h["n_duplicate_codes"]) == (4, 0, 0, 2, 0)
