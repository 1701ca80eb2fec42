"""Occurrence counts on grid cells and the datasets behind the figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.common import percent
from ..plans.quantiles import column_quantiles, quantile


def cell_counts(assigned: DataFrame) -> DataFrame:
    """(cell_id, n_occurrences, n_species) of cells with points."""
    return assigned.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n_occurrences"), F.count_distinct("scientificName").alias("n_species"))


def aggregate_to_grid(grid: DataFrame, assigned: DataFrame) -> DataFrame:
    """The whole grid with its counts; cells without points have zero."""
    zero = F.lit(0).cast("long")
    out = grid.join(cell_counts(assigned), "cell_id", "left")
    return out.withColumns({c: F.coalesce(c, zero) for c in ("n_occurrences", "n_species")})


def grid_summary(cells: DataFrame, points: DataFrame) -> DataFrame:
    n, covered = F.count(F.lit(1)), F.count(F.when(F.col("n_occurrences") > 0, 1))
    figures = [f(c).alias(f"{s}_{k}") for c, s in (("n_occurrences", "occurrences"), ("n_species", "species")) for k, f in (("min", F.min), ("max", F.max), ("mean", F.avg))]
    middle = column_quantiles(cells, ["n_occurrences", "n_species"], [0.5])
    middle = middle.agg(*(quantile(middle, c).alias(f"{s}_median") for c, s in (("n_occurrences", "occurrences"), ("n_species", "species"))))
    out = cells.agg(n.alias("total_cells"), covered.alias("cells_with_occurrence"), (n - covered).alias("empty_cells"), percent(covered, n).alias("coverage_pct"), *figures)
    return out.join(F.broadcast(middle)).join(F.broadcast(points.agg(F.count_distinct("scientificName").alias("total_species"))))


def coverage_flags(cells: DataFrame) -> DataFrame:
    return cells.withColumn("has_data", F.col("n_occurrences") > 0).withColumn("presence", (F.col("n_occurrences") > 0).cast("int"))


def log_density(cells: DataFrame) -> DataFrame:
    return cells.filter("n_occurrences > 0").withColumn("log_n", F.log1p("n_occurrences"))


def richness_cells(cells: DataFrame) -> DataFrame:
    return cells.filter("n_species > 0")


def coverage_counts(cells: DataFrame) -> DataFrame:
    some = F.when(F.col("n_occurrences") > 0, F.col("n_occurrences"))
    return cells.agg(F.count(some).alias("cells_with_data"), (F.count(F.lit(1)) - F.count(some)).alias("cells_without_data"), F.min(some).alias("min_nonzero"), F.max(some).alias("max_nonzero"))


def hotspot_cells(cells: DataFrame, share: float = 0.95) -> DataFrame:
    """Cells with data whose count reaches the interpolated quantile of such cells; ties count."""
    some = cells.filter("n_occurrences > 0")
    limit = column_quantiles(some, ["n_occurrences"], [share]).select(F.get("quantiles", F.lit(0)).alias("threshold"))
    return some.join(F.broadcast(limit)).filter("n_occurrences >= threshold")


def histogram(cells: DataFrame, column: str, bins: int, nonzero: bool = False) -> DataFrame:
    """(bin, lower, upper, n): all bins of equal width between the least and greatest value, the last one closed.

    Values belong to bins by comparison with the bins' own ends. A single value gets bins from half
    below to half above it. No values give no bins. ``nonzero`` leaves out zeros.
    """
    values = cells.select(F.col(column).cast("double").alias("x")).filter("x > 0" if nonzero else "x is not null")
    ends = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).filter("lo is not null")
    ends = ends.select(*((F.col(c) + F.when(F.col("lo") == F.col("hi"), F.lit(d)).otherwise(F.lit(0.0))).alias(c) for c, d in (("lo", -0.5), ("hi", 0.5))))
    ends = ends.withColumn("w", (F.col("hi") - F.col("lo")) / F.lit(float(bins)))
    first = F.least(F.floor((F.col("x") - F.col("lo")) / F.col("w")), F.lit(bins - 1).cast("long"))
    edge = lambda k: F.col("lo") + (F.col("k") + k) * F.col("w")
    moved = F.when(F.col("x") < edge(0), F.col("k") - 1).when((F.col("x") >= edge(1)) & (F.col("k") < bins - 1), F.col("k") + 1).otherwise(F.col("k"))
    counted = values.join(F.broadcast(ends)).withColumn("k", first).groupBy(moved.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = ends.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))))
    out = every.join(counted, "bin", "left")
    return out.select("bin", (F.col("lo") + F.col("bin") * F.col("w")).alias("lower"), (F.col("lo") + (F.col("bin") + 1) * F.col("w")).alias("upper"), F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def grid_sample(cells: DataFrame, n: int = 5000, seed: int = 42) -> DataFrame:
    """``n`` cells (all, if fewer) in the order of a seeded hash of their ids: the same for any partitioning."""
    return cells.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), "cell_id")), "cell_id").limit(n)
