"""Global and local Moran's I over grid cells, with inference by permutations.

Permutations are orders of the cells by a hash of (seed, number of the permutation, cell), so they are the same for
any partitioning and in any engine. Everything is joins and sums over cells and links; nothing of the grid comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.quantiles import with_places
from ..plans.shared import checked, cut, is_small
from ..schemas import LISA_LABELS

#: Decimals to which drawn and observed statistics are compared, so that sums in another order are still ties.
DECIMALS = 9


def with_variables(cells: DataFrame) -> DataFrame:
    """Presence (0 or 1) and log intensity as doubles."""
    return cells.withColumns({"presence": (F.col("n_occurrences") > 0).cast("double"), "log_n": F.log1p("n_occurrences")})


def spatial_lag(cells: DataFrame, links: DataFrame, variable: str) -> DataFrame:
    """(cell_id, z, lag): deviations from the mean and the mean deviation of neighbours, null where there are none."""
    mean = cells.agg(F.avg(variable).alias("__mean"))
    z = cells.join(F.broadcast(mean)).select("cell_id", (F.col(variable) - F.col("__mean")).alias("z"))
    lag = links.join(z.select(F.col("cell_id").alias("nbr_id"), F.col("z").alias("nz")), "nbr_id").groupBy("cell_id").agg(F.sum(F.col("w") * F.col("nz")).alias("lag"))
    return z.join(lag, "cell_id", "left")


def morans_i(cells: DataFrame, links: DataFrame, variable: str) -> DataFrame:
    """(n, s0, I, expected_I). Cells without neighbours count in n but not in the weights' sum; no variance gives null."""
    lag = spatial_lag(cells, links, variable)
    out = lag.agg(F.count(F.lit(1)).alias("n"), F.count("lag").alias("s0"), F.sum(F.col("z") * F.col("lag")).alias("num"), F.sum(F.col("z") * F.col("z")).alias("den"))
    value = F.when((F.col("den") > 0) & (F.col("s0") > 0), F.col("n") / F.when(F.col("s0") > 0, F.col("s0")) * F.col("num") / F.when(F.col("den") > 0, F.col("den")))
    return out.select("n", "s0", value.alias("I"), F.when(F.col("n") > 1, F.lit(-1.0) / F.when(F.col("n") > 1, F.col("n") - 1)).alias("expected_I"))


def quadrant(z: Column, lag: Column) -> Column:
    """1 high among high, 2 low among high, 3 low among low, 4 high among low; high is strictly above the mean."""
    high, around = z > 0, F.coalesce(lag, F.lit(0.0)) > 0
    return F.when(high & around, 1).when(~high & around, 2).when(~high & ~around, 3).otherwise(4)


def local_morans_i(cells: DataFrame, links: DataFrame, variable: str) -> DataFrame:
    """(cell_id, z, lag, local_i, q) with ``local_i`` scaled by (n - 1) over the sum of squares."""
    lag = spatial_lag(cells, links, variable)
    total = lag.agg(F.sum(F.col("z") * F.col("z")).alias("__den"), F.count(F.lit(1)).alias("__n"))
    scaled = F.when(F.col("__den") > 0, (F.col("__n") - 1) * F.col("z") * F.coalesce("lag", F.lit(0.0)) / F.when(F.col("__den") > 0, F.col("__den")))
    return lag.join(F.broadcast(total)).select("cell_id", "z", "lag", scaled.alias("local_i"), quadrant(F.col("z"), F.col("lag")).alias("q"))


def cluster_label(q: Column, p: Column, alpha: float = 0.05) -> Column:
    return F.when(p >= alpha, "Not significant").when(q == 1, "HH").when(q == 2, "LH").when(q == 3, "LL").when(q == 4, "HL").otherwise("Not significant")


def cluster_counts(labelled: DataFrame, column: str = "cluster") -> DataFrame:
    """(cluster, n) with all five labels, absent ones at zero."""
    found = labelled.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    labels = labelled.sparkSession.createDataFrame([(x,) for x in LISA_LABELS], f"{column} string")
    return labels.join(found, column, "left").select(column, F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def _order(seed: int, cell: str = "cell_id") -> Column:
    """The place of a cell in permutation ``k``, as text to sort by."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("k").cast("string"), F.col(cell)))


def _permutations(cells: DataFrame, permutations: int) -> DataFrame:
    return cells.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(permutations))))


def permuted_i(cells: DataFrame, links: DataFrame, variable: str, permutations: int = 999, seed: int = 42) -> DataFrame:
    """(k, I) of ``permutations`` random relabellings: in each the n-th cell in hash order takes the value of the n-th by id."""
    z = spatial_lag(cells, links, variable).select("cell_id", "z")
    base = cut(with_places(z, "cell_id", "place"))
    sums = base.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("z") * F.col("z")).alias("den"))
    by = Window.partitionBy("k").orderBy("h", "cell_id")
    drawn = _permutations(base.select("cell_id"), permutations).withColumn("h", _order(seed)).withColumn("place", F.row_number().over(by) - 1)
    small = is_small(base)
    drawn = cut(drawn.join(checked(base.select("place", "z"), small), "place").select("k", "cell_id", "z"))
    side = checked(links.select("cell_id", "nbr_id", "w"), is_small(links))
    pairs = drawn.join(side, "cell_id").select("k", "nbr_id", (F.col("w") * F.col("z")).alias("wz"))
    pairs = pairs.join(drawn.select("k", F.col("cell_id").alias("nbr_id"), F.col("z").alias("nz")), ["k", "nbr_id"])
    total = pairs.groupBy("k").agg(F.sum(F.col("wz") * F.col("nz")).alias("num"))
    s0 = links.agg(F.count_distinct("cell_id").alias("s0"))
    value = F.when((F.col("den") > 0) & (F.col("s0") > 0), F.col("n") / F.when(F.col("s0") > 0, F.col("s0")) * F.col("num") / F.when(F.col("den") > 0, F.col("den")))
    return total.join(F.broadcast(sums)).join(F.broadcast(s0)).select("k", value.alias("I"))


def morans_permutation(cells: DataFrame, links: DataFrame, variable: str, permutations: int = 999, seed: int = 42) -> DataFrame:
    """(I, expected_I, p_sim, z_sim, interpretation) from random permutations of the values; nulls where I is undefined."""
    observed = morans_i(cells, links, variable).select("I", "expected_I")
    drawn = permuted_i(cells, links, variable, permutations, seed)
    own = cut(observed)
    rounded = lambda x: F.round(x, DECIMALS)
    simulated = drawn.withColumnRenamed("I", "i_k").join(F.broadcast(own.select("I"))).agg(
        F.count(F.when(rounded(F.col("i_k")) >= rounded(F.col("I")), 1)).alias("larger"), F.avg("i_k").alias("mean"), F.stddev_pop("i_k").alias("std")
    )
    extreme = F.least(F.col("larger"), F.lit(permutations) - F.col("larger"))
    p = F.when(F.col("I").isNotNull(), (extreme + 1) / F.lit(permutations + 1.0))
    return own.join(F.broadcast(simulated)).select(
        "I",
        "expected_I",
        p.alias("p_sim"),
        F.when(F.col("std") > 0, (F.col("I") - F.col("mean")) / F.when(F.col("std") > 0, F.col("std"))).alias("z_sim"),
        interpretation(F.col("I"), p, variable).alias("interpretation"),
    )


def interpretation(i: Column, p: Column, label: str, alpha: float = 0.05) -> Column:
    said = F.when((p < alpha) & (i > 0), "Positive spatial autocorrelation (clustering)").when((p < alpha) & (i < 0), "Negative spatial autocorrelation (dispersion)").otherwise("No significant spatial autocorrelation")
    return F.concat(F.lit(f"{label}: "), said)


def lisa(cells: DataFrame, links: DataFrame, variable: str, permutations: int = 999, seed: int = 42, alpha: float = 0.05) -> DataFrame:
    """``local_morans_i`` with ``p_sim`` of conditional permutations and ``cluster``.

    A cell keeps its value while its neighbours' are drawn from the others without repeats: in permutation k they are the first cells
    in hash order but itself. All cells share the draws, so only as many cells of each permutation are gathered as
    a cell has neighbours, and one more, whatever the size of the grid. Cells without neighbours, and grids with too few cells to draw from, have p 1.
    """
    local = cut(local_morans_i(cells, links, variable))
    degrees = links.groupBy("cell_id").agg(F.count(F.lit(1)).cast("int").alias("degree"))
    most = F.lit((degrees.agg(F.max("degree")).first()[0] or 0) + 1)
    by = Window.partitionBy("k").orderBy("h", "cell_id")
    first = _permutations(local.select("cell_id", "z"), permutations).withColumn("h", _order(seed)).withColumn("nth", F.row_number().over(by)).filter(F.col("nth") <= most)
    draw = first.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("nth", "cell_id", "z"))).alias("draw"))
    draws = cut(draw.agg(F.collect_list("draw").alias("draws"), F.max(F.size("draw")).alias("drawable")))
    rows = local.join(degrees, "cell_id", "left").join(F.broadcast(draws))
    rounded = lambda x: F.round(x, DECIMALS)

    def mean(draw: Column) -> Column:
        others = F.slice(F.filter(draw, lambda c: c["cell_id"] != F.col("cell_id")), F.lit(1), F.col("degree"))
        return F.aggregate(others, F.lit(0.0), lambda a, c: a + c["z"]) / F.col("degree")

    larger = F.size(F.filter("draws", lambda d: rounded(mean(d) * F.col("z")) >= rounded(F.col("lag") * F.col("z"))))
    p = F.when(F.col("degree").isNull() | (F.col("drawable") <= F.col("degree")), F.lit(1.0)).otherwise((F.least(larger, F.lit(permutations) - larger) + 1) / F.lit(permutations + 1.0))
    out = rows.withColumn("p_sim", p).drop("draws", "degree", "drawable")
    return out.withColumn("cluster", cluster_label(F.col("q"), F.col("p_sim"), alpha))
