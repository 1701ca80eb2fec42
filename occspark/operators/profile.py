"""Column profiles of the occurrence table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import is_date_like, percent, warning_flags
from ..plans.quantiles import exact_quantiles, moments, stretch_quantiles
from ..plans.shared import cut
from ..schemas import COLUMN_ROLES, DATE_LIKE, LOGICAL_TYPES, MEASURED


def _logical(name: str, kind: str) -> str:
    by_kind = {"bigint": "integer", "int": "integer", "smallint": "integer", "tinyint": "integer", "double": "float", "float": "float", "string": "string"}
    return LOGICAL_TYPES.get(name, by_kind.get(kind, "other"))


def sample_values(df: DataFrame, n: int = 3) -> DataFrame:
    """(column, sample_values): the first ``n`` distinct values of each column in text order.

    A column's values are made distinct by a shuffle on (column, value) and each task keeps
    its first few, so no column's values are gathered.
    """
    values = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in df.columns))
    distinct = df.select(F.explode(values).alias("v")).select("v.*").filter("value is not null").distinct()
    first = distinct.withColumn("nth", F.row_number().over(Window.partitionBy("column").orderBy("value"))).filter(F.col("nth") <= n)
    return first.groupBy("column").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "value"))), lambda x: x["value"]), " | ").alias("sample_values"))


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: counts, distinct values, numbers of measured columns, date quality and flags.

    Values are counted by (column, value), summed up in each task before the one shuffle; all figures of a column then come from its
    counted values, the median by their frequencies. Whole numbers that are not measured, ids above all, have as many
    values as rows: each such column is counted by itself, by its own type and from a scan of it alone.
    """
    kinds = dict(df.dtypes)
    measured = [c for c in df.columns if c in MEASURED and kinds[c] != "string"]
    keys = [c for c in df.columns if kinds[c] == "bigint" and c not in MEASURED]
    place = {c: F.lit(i) for i, c in enumerate(df.columns)}
    none = F.lit(None)
    cell = lambda c: F.struct(place[c].alias("ord"), (none if c in measured else F.col(c)).cast("string").alias("v"), (F.col(c) if c in measured else none).cast("double").alias("x"))
    others = [c for c in df.columns if c not in keys]
    counted = df.select(F.explode(F.array(*map(cell, others))).alias("c")).groupBy("c.ord", "c.v", "c.x").agg(F.count(F.lit(1)).alias("n"))
    dates = F.array(*(place[c] for c in others if c in DATE_LIKE)).cast("array<int>")
    valid = F.array_contains(dates, F.col("ord")) & F.coalesce(is_date_like(F.col("v")), F.lit(False))
    counted = cut(counted.select("ord", (F.col("v").isNotNull() | F.col("x").isNotNull()).alias("there"), "x", valid.alias("valid"), "n"))
    every = counted
    for c in keys:
        own = df.groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        every = every.unionByName(own.select(place[c].alias("ord"), F.col("v").isNotNull().alias("there"), none.cast("double").alias("x"), F.lit(False).alias("valid"), "n"))
    n = lambda of: F.coalesce(F.sum(F.when(of, F.col("n"))), F.lit(0))
    found = every.groupBy("ord").agg(
        F.sum("n").alias("rows"),
        n(F.col("there")).alias("non_null"),
        F.count(F.when(F.col("there"), 1)).alias("unique_values"),
        n(F.col("valid")).alias("valid"),
        F.min("x").alias("numeric_min"),
        F.max("x").alias("numeric_max"),
        F.bround(F.sum(F.col("x") * F.col("n")) / F.sum(F.when(F.col("x").isNotNull(), F.col("n"))), 4).alias("numeric_mean"),
    )
    middle = exact_quantiles(counted, "ord", "x", "n", [0.5]).select("ord", F.bround(F.get("quantiles", F.lit(0)), 4).alias("numeric_median"))
    found = found.join(F.broadcast(middle), "ord", "left")
    about = [(i, c, COLUMN_ROLES.get(c, "unspecified"), kinds[c], _logical(c, kinds[c]), c in DATE_LIKE) for i, c in enumerate(df.columns)]
    columns = df.sparkSession.createDataFrame(about, "ord int, column string, role string, dtype string, logical_type string, dates boolean")
    out = columns.join(F.broadcast(found), "ord", "left").fillna(0, ["rows", "non_null", "unique_values", "valid"])
    missing_pct = percent(F.col("missing"), F.col("rows"), 4)
    out = out.withColumn("missing", F.col("rows") - F.col("non_null")).withColumn("missing_pct", missing_pct)
    out = out.withColumns(
        {
            "date_like_valid_values": F.when(F.col("dates"), F.col("valid")),
            "date_like_valid_pct": F.when(F.col("dates"), percent(F.col("valid"), F.col("non_null"), 4)),
            "warning_flags": warning_flags(F.col("missing_pct"), F.col("unique_values"), F.col("non_null")),
        }
    )
    names = ["ord", "column", "role", "dtype", "logical_type", "non_null", "missing", "missing_pct", "unique_values", "numeric_min", "numeric_max", "numeric_mean", "numeric_median", "date_like_valid_values", "date_like_valid_pct", "warning_flags"]
    return out.select(*names)


def full_profile(df: DataFrame, n: int = 3) -> DataFrame:
    """``schema_profile`` with sample values."""
    return schema_profile(df).join(sample_values(df, n), "column", "left").withColumn("sample_values", F.coalesce("sample_values", F.lit(""))).orderBy("ord")


def date_quality(df: DataFrame, column: str = "eventDate") -> DataFrame:
    good = F.count(F.when(is_date_like(F.col(column)), 1))
    return df.agg(F.count(column).alias("non_null"), good.alias("valid"), percent(good, F.count(column), 4).alias("valid_pct"))


def duplicate_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows beyond the first of each value of ``keys``, nulls being equal to one another."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.coalesce(F.sum("n") - F.count(F.lit(1)), F.lit(0)).cast("long").alias("duplicates"))


def describe(df: DataFrame, *fields: str) -> DataFrame:
    """(field, count, mean, std, min, q25, q50, q75, max) with the sample deviation and exact quartiles."""
    out = moments(df, fields, "count")
    quartiles = stretch_quantiles(df, fields, [0.25, 0.5, 0.75]).select(F.col("column").alias("field"), F.col("quantiles").alias("q"))
    out = out.join(F.broadcast(quartiles), "field", "left")
    return out.select("field", "count", "mean", "std", "min", *(F.get("q", F.lit(i)).alias(c) for i, c in enumerate(("q25", "q50", "q75"))), "max")
