"""Checks of a finished surface and of joined outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import percent
from .hexgrid import assign_cells
from .spatial import POINT_ID, containing_pairs
from ..functions.geo import intersects


def lost_points(points: DataFrame, assigned: DataFrame) -> DataFrame:
    """Points whose id an assignment does not have."""
    return points.join(assigned.select(POINT_ID).distinct(), POINT_ID, "left_anti")


def lost_point_counts(points: DataFrame, area: DataFrame, grid: DataFrame, a: float, label: str = "hex") -> DataFrame:
    """(n_points, n_in_area, n_in_grid, missing_area, missing_grid), by distinct id."""
    in_area = containing_pairs(points, area, intersects).select(POINT_ID).distinct().withColumn("in_area", F.lit(1))
    in_grid = assign_cells(points, a, label).join(grid.select("cell_id"), "cell_id", "left_semi").select(POINT_ID).distinct().withColumn("in_grid", F.lit(1))
    ids = points.select(POINT_ID).distinct().join(in_area, POINT_ID, "left").join(in_grid, POINT_ID, "left")
    n = F.count(F.lit(1))
    return ids.agg(n.alias("n_points"), F.count("in_area").alias("n_in_area"), F.count("in_grid").alias("n_in_grid"), (n - F.count("in_area")).alias("missing_area"), (n - F.count("in_grid")).alias("missing_grid"))


def pipeline_validation(points: DataFrame, area: DataFrame, grid: DataFrame, cells: DataFrame, a: float, label: str = "hex", srid: int | None = 4326) -> DataFrame:
    """(ord, check_name, passed, details): the 22 checks of a surface, from five aggregations of one row each."""
    lost = lost_point_counts(points, area, grid, a, label).withColumnsRenamed({"n_points": "n_ids"})
    occ = points.agg(F.count(F.lit(1)).alias("n_occ"))
    areas = area.agg(F.count(F.lit(1)).alias("n_area"))
    grids = grid.agg(F.count(F.lit(1)).alias("n_grid"), F.count_distinct("cell_id").alias("d_grid"))
    n_occ, n_sp = F.col("n_occurrences"), F.col("n_species")
    yes = lambda c: F.coalesce(F.bool_and(c), F.lit(True))
    agg = cells.agg(
        F.count(F.lit(1)).alias("n_cells"), F.count_distinct("cell_id").alias("d_cells"), yes(n_occ >= 0).alias("occ_ok"), yes(n_sp >= 0).alias("sp_ok"), yes(n_sp <= n_occ).alias("le_ok"),
        F.coalesce(F.sum(n_occ), F.lit(0)).alias("sum_occ"), F.count(F.when(n_occ > 0, 1)).alias("active"), F.count(F.when(n_occ == 0, 1)).alias("zero"),
    )
    one = lost.join(F.broadcast(occ)).join(F.broadcast(areas)).join(F.broadcast(grids)).join(F.broadcast(agg))
    c = F.col
    size = lambda n: (c(n) > 0, F.concat(F.lit("n="), c(n).cast("string")))
    crs = (F.lit(srid is not None), F.lit(f"EPSG:{srid}" if srid else "None"))
    has = lambda df, name: (F.lit(name in df.columns), F.lit(f"{name} present"))
    of = lambda x, y: F.concat(x.cast("string"), F.lit("/"), y.cast("string"))
    unique = lambda n, d: (c(n) == c(d), F.concat(F.lit("unique="), F.when(c(n) == c(d), "True").otherwise("False")))
    checks: list[tuple[str, Column, Column]] = [
        ("Occurrences non-empty", *size("n_occ")),
        ("Study area non-empty", *size("n_area")),
        ("Grid non-empty", *size("n_grid")),
        ("Aggregated grid non-empty", *size("n_cells")),
        ("Occurrences CRS", *crs),
        ("Study area CRS", *crs),
        ("Grid CRS", *crs),
        ("Aggregated grid CRS", *crs),
        ("Grid has cell_id", *has(grid, "cell_id")),
        ("Aggregated grid has cell_id", *has(cells, "cell_id")),
        ("Aggregated grid has n_occurrences", *has(cells, "n_occurrences")),
        ("Aggregated grid has n_species", *has(cells, "n_species")),
        ("All selected occurrences intersect study area", c("n_in_area") == c("n_ids"), of(c("n_in_area"), c("n_ids"))),
        ("All selected occurrences intersect grid", c("n_in_grid") == c("n_ids"), of(c("n_in_grid"), c("n_ids"))),
        ("Grid cell_id unique", *unique("n_grid", "d_grid")),
        ("Aggregated grid cell_id unique", *unique("n_cells", "d_cells")),
        ("n_occurrences non-negative", c("occ_ok"), F.lit("all values >= 0")),
        ("n_species non-negative", c("sp_ok"), F.lit("all values >= 0")),
        ("n_species <= n_occurrences for all cells", c("le_ok"), F.lit("checked all cells")),
        ("Total aggregated occurrences equals selected occurrences", c("sum_occ") == c("n_occ"), of(c("sum_occ"), c("n_occ"))),
        ("Active + zero cells equals total cells", c("active") + c("zero") == c("n_cells"), F.concat(c("active").cast("string"), F.lit(" + "), c("zero").cast("string"), F.lit(" = "), c("n_cells").cast("string"))),
        ("No gbifID lost in point-to-grid assignment", c("missing_grid") == 0, F.concat(F.lit("missing="), c("missing_grid").cast("string"))),
    ]
    return one.select(F.inline(F.array(*(F.struct(F.lit(i).alias("ord"), F.lit(n).alias("check_name"), p.alias("passed"), d.alias("details")) for i, (n, p, d) in enumerate(checks)))))


def validation_tally(checks: DataFrame) -> DataFrame:
    n = F.count(F.when(F.col("passed"), 1))
    return checks.agg(n.alias("n_pass"), (F.count(F.lit(1)) - n).alias("n_fail"))


def joined_inspection(joined: DataFrame) -> DataFrame:
    """Row counts, inside share and id health of a joined output, one row."""
    n, inside = F.count(F.lit(1)), F.count("SITECODE")
    distinct = F.count_distinct(POINT_ID) + F.coalesce(F.max(F.when(F.col(POINT_ID).isNull(), 1)), F.lit(0))
    classes = [F.count("uncertainty_class").alias("n_classified")] if "uncertainty_class" in joined.columns else []
    return joined.agg(n.alias("n_rows"), inside.alias("n_inside"), (n - inside).alias("n_outside"), percent(inside, n).alias("pct_inside"), F.count(F.when(F.col(POINT_ID).isNull(), 1)).alias("null_ids"), (n - distinct).cast("long").alias("duplicate_ids"), *classes)


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Whether two outputs have as many rows."""
    left, right = a.agg(F.count(F.lit(1)).alias("n_a")), b.agg(F.count(F.lit(1)).alias("n_b"))
    return left.join(F.broadcast(right)).withColumn("same", F.col("n_a") == F.col("n_b"))
