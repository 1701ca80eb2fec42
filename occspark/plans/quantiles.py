"""Exact quantiles of any number of values, without one task that holds a column."""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut


def with_places(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with the place of each row in the order of ``column`` (distinct values), from 0 on; no task orders all rows."""
    ranges = cut(df.repartitionByRange(column).withColumn("__part", F.spark_partition_id()))
    sums = ranges.groupBy("__part").agg(F.count(F.lit(1)).alias("__held"))
    sums = cut(sums.select("__part", (F.sum("__held").over(Window.orderBy("__part")) - F.col("__held")).alias("__start")))
    nth = F.row_number().over(Window.partitionBy("__part").orderBy(column)) - 1
    return ranges.withColumn("__nth", nth).join(F.broadcast(sums), "__part").withColumn(name, F.col("__start") + F.col("__nth")).drop("__part", "__start", "__nth")


def exact_quantiles(counted: DataFrame, key: str, value: str, n: str, qs: Sequence[float]) -> DataFrame:
    """(``key``, quantiles): per key an array of the quantiles ``qs``, interpolated between the two values around them.

    ``counted`` has a row per key and value with how often it stands there; null values are left out, and keys that have no others.
    Values are dealt to ranges in their order, the ranges' sums say in which of them the ranks lie that are asked for, and
    only those ranges are put in order and counted through.
    """
    rows = counted.filter(F.col(value).isNotNull()).select(F.col(key).alias("k"), F.col(value).alias("x"), F.col(n).cast("long").alias("n"))
    ranges = cut(rows.repartitionByRange("k", "x").withColumn("part", F.spark_partition_id()))
    sums = ranges.groupBy("k", "part").agg(F.sum("n").alias("held"))
    along = Window.partitionBy("k").orderBy("part")
    sums = sums.select("k", "part", "held", (F.sum("held").over(along) - F.col("held")).alias("start"), F.sum("held").over(Window.partitionBy("k")).alias("total"))
    place = lambda q: F.lit(float(q)) * (F.col("total") - 1)
    ranks = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(up).alias("up"), f(place(q)).cast("long").alias("rank"), place(q).alias("place")) for i, q in enumerate(qs) for up, f in ((False, F.floor), (True, F.ceil))))
    asked = sums.select("k", "part", "start", "held", F.explode(ranks).alias("r")).filter("r.rank >= start and r.rank < start + held")
    asked = cut(asked.select("k", "part", "start", "r.*"))
    where = asked.select("k", "part", "start").distinct()
    on = lambda a, b: a["k"].eqNullSafe(b["k"]) & (a["part"] == b["part"])
    some = ranges.join(F.broadcast(where), on(ranges, where)).select(ranges["k"], ranges["part"], "x", "n", "start")
    before = F.sum("n").over(Window.partitionBy("k", "part").orderBy("x")) - F.col("n") + F.col("start")
    some = some.withColumn("before", before)
    hit = some.join(F.broadcast(asked.drop("start")), on(some, asked) & (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
    hit = hit.select(some["k"], "i", "up", "rank", "place", F.col("x").cast("double").alias("x"))
    low, high = (F.max(F.when(F.col("up") == up, F.col("x"))) for up in (False, True))
    share = F.max(F.when(~F.col("up"), F.col("place") - F.col("rank")))
    found = hit.groupBy("k", "i").agg(low.alias("low"), high.alias("high"), share.alias("share"))
    at = F.when(F.col("share") == 0, F.col("low")).otherwise((F.lit(1.0) - F.col("share")) * F.col("low") + F.col("share") * F.col("high"))
    out = found.select("k", "i", at.alias("q")).groupBy("k").agg(F.sort_array(F.collect_list(F.struct("i", "q"))).alias("qs"))
    return out.select(F.col("k").alias(key), F.transform("qs", lambda s: s["q"]).alias("quantiles"))


def moments(df: DataFrame, fields: Sequence[str], count: str) -> DataFrame:
    """(field, ``count``, mean, std, min, max) of several numeric columns in one pass, none of whose rows is repeated by field."""
    of = {count: F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    one = df.select(*(F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(fields)))
    one = one.agg(*(how(f"x{i}").alias(f"{name}{i}") for i in range(len(fields)) for name, how in of.items()))
    rows = F.array(*(F.struct(F.lit(f).alias("field"), *(F.col(f"{name}{i}").alias(name) for name in of)) for i, f in enumerate(fields)))
    return one.select(F.inline(rows))


def column_quantiles(df: DataFrame, columns: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """(column, quantiles) of several numeric columns; those without values are left out."""
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns))
    counted = df.select(F.explode(cells).alias("c")).select("c.*").filter("x is not null").groupBy("column", "x").agg(F.count(F.lit(1)).alias("n"))
    return exact_quantiles(counted, "column", "x", "n", qs)


def stretch_quantiles(df: DataFrame, columns: Sequence[str], qs: Sequence[float], buckets: int = 1 << 14) -> DataFrame:
    """``column_quantiles`` of columns whose values are nearly all distinct and are cheap to read more than once.

    Values are first counted by equal stretches of their column. Only those stretches that hold an asked rank are counted by
    value; each other one goes on as one row, since none of its values is asked for. Columns with values that are not finite are one stretch.
    """
    xs = [F.col(c).cast("double") for c in columns]
    ends = df.agg(*(f(x) for x in xs for f in (F.min, F.max))).first()
    parts = []
    for i, (c, x) in enumerate(zip(columns, xs, strict=True)):
        low, high = ends[2 * i], ends[2 * i + 1]
        if low is None:
            continue
        # Rounding keeps the order of what is subtracted, divided and multiplied, so stretches are in the order of values.
        stretch = F.floor((x - F.lit(low)) / F.lit(high - low) * F.lit(float(buckets))).cast("long") if 0 < high - low < math.inf else F.lit(0).cast("long")
        parts.append(df.select(F.lit(c).alias("column"), x.alias("x"), stretch.alias("stretch")).filter("x is not null"))
    if not parts:
        return df.sparkSession.createDataFrame([], "column string, quantiles array<double>")
    held = cut(reduce(DataFrame.unionByName, (p.groupBy("column", "stretch").agg(F.min("x").alias("x"), F.count(F.lit(1)).alias("n")) for p in parts)))
    wanted: dict[str, set[int]] = {}
    by_column: dict[str, list] = {}
    for row in held.select("column", "stretch", "n").orderBy("column", "stretch").collect():
        by_column.setdefault(row["column"], []).append((row["stretch"], row["n"]))
    for c, rows in by_column.items():
        until = list(accumulate(n for _, n in rows))
        ranks = {int(f(float(q) * (until[-1] - 1))) for q in qs for f in (math.floor, math.ceil)}
        wanted[c] = {rows[bisect_right(until, rank)][0] for rank in ranks}
    of = lambda c: F.col("stretch").isin(*wanted[c])
    rest = reduce(Column.__or__, ((F.col("column") == c) & ~of(c) for c in wanted))
    counted = held.filter(rest).select("column", "x", "n")
    for p, c in zip(parts, (c for c in columns if c in wanted), strict=True):
        counted = counted.unionByName(p.filter(of(c)).groupBy("column", "x").agg(F.count(F.lit(1)).alias("n")))
    return exact_quantiles(counted, "column", "x", "n", qs)


def quantile(found: DataFrame, column: str, i: int = 0) -> Column:
    """Of a table of one row per column, the ``i``-th quantile of ``column`` as an aggregate."""
    return F.max(F.when(F.col("column") == column, F.get("quantiles", F.lit(i))))
