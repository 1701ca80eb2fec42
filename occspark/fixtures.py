"""Occurrence and site tables made of the test tables, by expressions that any SQL engine shares.

``RAW``, ``OCC`` and ``SITE`` are the text of the views; the oracle SQL of the queries uses them as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.sites import prepare_sites
from .plans.shared import cut

RAW = """
SELECT CASE WHEN k % 211 = 0 THEN NULL ELSE CAST(k AS STRING) END AS gbifID,
  CASE WHEN k % 199 = 0 THEN 'n/a' WHEN k % 197 = 0 THEN 'x7' ELSE CAST(k % 97 AS STRING) END AS taxonKey,
  CASE WHEN k % 193 = 0 THEN NULL ELSE concat('Species ', CAST((k % 97) % 89 AS STRING)) END AS scientificName,
  CASE WHEN k % 101 = 0 THEN 'abc' WHEN k % 103 = 0 THEN concat(' ', lat, ' ') WHEN k % 107 = 0 THEN '1d' WHEN k % 109 = 0 THEN 'NaN' ELSE lat END AS decimalLatitude,
  lon AS decimalLongitude,
  CASE k % 7 WHEN 0 THEN 'DE' WHEN 1 THEN 'FR' WHEN 2 THEN 'ES' WHEN 3 THEN 'NA' WHEN 4 THEN 'IT' WHEN 5 THEN 'PT' ELSE 'SE' END AS countryCode,
  CASE k % 5 WHEN 0 THEN 'HUMAN_OBSERVATION' WHEN 1 THEN 'MACHINE_OBSERVATION' WHEN 2 THEN 'PRESERVED_SPECIMEN' WHEN 3 THEN 'FOSSIL_SPECIMEN' ELSE NULL END AS basisOfRecord,
  CASE WHEN k % 11 = 0 THEN NULL WHEN k % 307 = 0 THEN '-1' ELSE CAST(k * 31 % 1200 AS STRING) END AS coordinateUncertaintyInMeters,
  CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(y AS STRING) END AS year,
  CAST(m AS STRING) AS month,
  CASE k % 17 WHEN 0 THEN 'unknown' WHEN 1 THEN CAST(y AS STRING) WHEN 2 THEN NULL WHEN 3 THEN '2001-02-30' ELSE d END AS eventDate
FROM (
  SELECT k, y, m, d,
    concat(CAST(35 + CAST(floor(la / 1e2) AS BIGINT) AS STRING), '.', lpad(CAST(la % 100 AS STRING), 2, '0')) AS lat,
    concat(CASE WHEN lo < 0 THEN '-' ELSE '' END, CAST(CAST(floor(abs(lo) / 1e2) AS BIGINT) AS STRING), '.', lpad(CAST(abs(lo) % 100 AS STRING), 2, '0')) AS lon
  FROM (
    SELECT o_orderkey AS k, (o_orderkey * 104729) % 3001 AS la, (o_orderkey * 7919) % 4001 - 1000 AS lo,
      year(o_orderdate) AS y, month(o_orderdate) AS m, CAST(CAST(o_orderdate AS DATE) AS STRING) AS d
    FROM orders
  ) AS a
) AS b"""

OCC = """
SELECT o_orderkey AS gbifID, o_orderkey % 97 AS taxonKey, concat('Species ', CAST((o_orderkey % 97) % 89 AS STRING)) AS scientificName,
  -10 + ((o_orderkey * 7919) % 4001) / 1e2 AS decimalLongitude, 35 + ((o_orderkey * 104729) % 3001) / 1e2 AS decimalLatitude,
  CASE WHEN o_orderkey % 11 = 0 THEN CAST(NULL AS DOUBLE) ELSE (o_orderkey * 31 % 1200) * 1e0 END AS coordinateUncertaintyInMeters,
  CASE WHEN o_orderkey % 13 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(year(o_orderdate) AS BIGINT) END AS year
FROM orders"""

SITE = """
SELECT s_suppkey AS index_right, concat('S', CAST(s_suppkey AS STRING)) AS SITECODE, concat('Site ', CAST(s_suppkey AS STRING)) AS SITENAME,
  CAST(s_nationkey AS STRING) AS MS, CASE s_suppkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS SITETYPE,
  -10 + ((s_suppkey * 613) % 401) / 1e1 AS cx, 35 + ((s_suppkey * 389) % 301) / 1e1 AS cy, 0.5e0 + (s_suppkey % 7) * 0.25e0 AS r
FROM supplier"""

# Occurrences whose ids repeat or are missing: rows are told apart by ``k`` alone.
ODD_OCC = """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 50 END AS gbifID, concat('Species ', CAST(o_orderkey % 89 AS STRING)) AS scientificName,
  CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE -10 + ((o_orderkey * 7919) % 4001) / 1e2 END AS decimalLongitude, 35 + ((o_orderkey * 104729) % 3001) / 1e2 AS decimalLatitude,
  CASE WHEN o_orderkey % 11 = 0 THEN CAST(NULL AS DOUBLE) ELSE (o_orderkey * 31 % 1200) * 1e2 END AS coordinateUncertaintyInMeters
FROM orders"""

# Rings of sites of three parts, the first with a hole wound like its outer ring, the second wound the other way, the third tiny.
RINGS = """
SELECT s.index_right, t.ring, t.part, t.back, s.cx + t.dx * s.r AS cx, s.cy + t.dy * s.r + t.up AS cy, s.r * t.f + t.g AS r
FROM site AS s CROSS JOIN (VALUES (0, 0, false, 0e0, 0e0, 0e0, 1e0, 0e0), (1, 0, false, 0e0, 0e0, 0e0, 0.4e0, 0e0), (2, 1, true, 2.5e0, 0e0, 0e0, 0.5e0, 0e0), (3, 2, false, 0e0, 1e0, 0.3e0, 0e0, 0.05e0))
  AS t(ring, part, back, dx, dy, up, f, g)"""

SPECIES = """
SELECT CASE WHEN p_partkey % 29 = 0 THEN 'none' ELSE CAST(p_partkey % 300 AS STRING) END AS usageKey,
  CASE WHEN p_partkey % 14 = 0 THEN CAST(p_partkey % 50 AS STRING) ELSE NULL END AS acceptedUsageKey
FROM part"""


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def _view(spark: SparkSession, sf_dir: str, sql: str, table: str) -> DataFrame:
    return spark.sql(sql.replace(f"FROM {table}", f"FROM {{{table}}}"), **tables(spark, sf_dir, table))


_STAGED: dict[tuple[str, str, str], DataFrame] = {}


def _staged(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A table stored once per application and input as Parquet in several files, as occurrence and site stores would be."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGED:
        _STAGED[key] = cut(make().repartition(spark.sparkContext.defaultParallelism))
    return _STAGED[key]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "raw", lambda: _view(spark, sf_dir, RAW, "orders"))


def occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "occurrences", lambda: _view(spark, sf_dir, OCC, "orders"))


def species(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SPECIES, "part")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One diamond per supplier, prepared."""
    return _staged(spark, sf_dir, "sites", lambda: _sites(spark, sf_dir))


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _view(spark, sf_dir, SITE, "supplier")
    p = lambda dx, dy: F.struct((F.col("cx") + dx).alias("x"), (F.col("cy") + dy).alias("y"))
    r, zero = F.col("r"), F.lit(0.0)
    ring = F.array(p(r, zero), p(zero, r), p(-r, zero), p(zero, -r), p(r, zero))
    return prepare_sites(s.withColumn("rings", F.array(ring)).drop("cx", "cy", "r"))


def odd_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "odd", lambda: _view(spark, sf_dir, ODD_OCC, "orders"))


def part_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites of several parts and a hole per supplier, prepared."""
    return _staged(spark, sf_dir, "parts", lambda: _part_sites(spark, sf_dir))


def _part_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    site = _view(spark, sf_dir, SITE, "supplier")
    rings = spark.sql(RINGS.replace("FROM site AS s", "FROM {site} AS s"), site=site)
    p = lambda dx, dy: F.struct((F.col("cx") + dx).alias("x"), (F.col("cy") + dy).alias("y"))
    r, zero = F.col("r"), F.lit(0.0)
    ring = F.array(p(r, zero), p(zero, r), p(-r, zero), p(zero, -r), p(r, zero))
    rows = rings.select("index_right", F.struct("ring", "part", F.when(F.col("back"), F.reverse(ring)).otherwise(ring).alias("points")).alias("x"))
    shapes = rows.groupBy("index_right").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    shapes = shapes.select("index_right", F.transform("xs", lambda x: x["points"]).alias("rings"), F.transform("xs", lambda x: x["part"]).alias("ring_parts"))
    return prepare_sites(site.drop("cx", "cy", "r").join(shapes, "index_right"))
