"""Counts by group and the figures of the filter report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.common import percent

COUNTERS = ["scientificName", "taxonKey", "countryCode", "basisOfRecord", "year"]


def group_summary(df: DataFrame, key: str) -> DataFrame:
    """(key, occurrences): most first, ties by key; null keys are left out."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("occurrences")).orderBy(F.desc("occurrences"), key)


def year_summary(df: DataFrame) -> DataFrame:
    return group_summary(df, "year").orderBy("year")


def top_groups(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    return group_summary(df, key).limit(k)


def counters(df: DataFrame, keys: list[str] = COUNTERS) -> DataFrame:
    """(counter, value, n) for all counters in one pass: rows are summed up per task before the shuffle."""
    pairs = F.array(*(F.struct(F.lit(k).alias("counter"), F.col(k).cast("string").alias("value")) for k in keys))
    return df.select(F.explode(pairs).alias("c")).filter("c.value is not null").groupBy("c.counter", "c.value").agg(F.count(F.lit(1)).alias("n"))


def distribution(df: DataFrame, key: str, name: str, count: str = "n_occurrences", share: str = "percentage") -> DataFrame:
    """Counts by key with null as a group, and their share of all rows in percent.

    The window runs over the groups, of which there are few, not over rows.
    """
    counted = df.groupBy(F.col(key).alias(name)).agg(F.count(F.lit(1)).alias(count))
    total = counted.agg(F.sum(count).alias("__total"))
    return counted.join(F.broadcast(total)).select(name, count, percent(F.col(count), F.col("__total")).alias(share))


def filter_report(n_raw: int, filtered: DataFrame) -> DataFrame:
    """The scalar figures of the filter report, one row."""
    n = F.count(F.lit(1))
    return filtered.agg(
        F.lit(n_raw).cast("long").alias("n_raw"),
        n.alias("n_filtered"),
        percent(n, F.lit(n_raw)).alias("pct_kept"),
        F.count_distinct("scientificName").alias("n_names"),
        F.count_distinct("taxonKey").alias("n_taxon_keys"),
        F.count_distinct("countryCode").alias("n_countries"),
        *(f(c).alias(f"{c}_{k}") for c in ("year", "decimalLatitude", "decimalLongitude") for k, f in (("min", F.min), ("max", F.max))),
    )
