"""One query per operator over tables made of the test data, each with the SQL that must give the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as X
from .functions.common import rounded, warning_flags
from .functions.geo import A, COS_B0, D, E2, FE, FN, LON0, QP, RQ, SIN_B0, intersects, laea, mercator, to_degrees, within
from .operators import autocorr, clean, figures, hexgrid, metrics, profile, readiness, report, sites, spatial, summaries, surface, uncertainty, validate
from .operators.predicates import FilterSpec, basis_filter, bbox_filter, predicate, uncertainty_filter, year_filter
from .plans.shared import cut, scratch
from .schemas import CERTAINLY_INSIDE, CERTAINLY_OUTSIDE, INSIDE_UNCERTAIN, OUTSIDE_LABEL, OUTSIDE_UNCERTAIN, RAW_COLUMNS, UNCLASSIFIED, WITHIN_LABEL
from .sources import files, geopackage
from .sources.download import request_predicate
from .streaming.counters import stored_counters, stream_counters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Edge of the test grid's cells in metres, and the sites that make its study area.
HEX = 60_000.0
AREA_MS = ["3", "7", "11"]
BOX = FilterSpec(min_lat=40.0, max_lat=55.5, min_lon=-5.25, max_lon=20.0)
YEARS = FilterSpec(min_year=1996, max_year=1999)


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# SQL of the shared tables ---------------------------------------------------------------------------

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _num(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '{_NUMBER}') THEN TRY_CAST(trim({c}) AS DOUBLE) END"


RAW_SQL = f"raw AS ({X.RAW})"
# Missing marks are made null first, as the reader of the raw table does.
_NULLED = ", ".join(f"CASE WHEN {c} IN ('', 'NA', 'n/a', 'NaN', 'null', 'None', 'N/A', 'nan', 'NULL') THEN NULL ELSE {c} END AS {c}" for c in RAW_COLUMNS)
_TYPED = ", ".join(f"{_num(c)} AS {c}" if c in ("gbifID", "taxonKey", "decimalLatitude", "decimalLongitude", "coordinateUncertaintyInMeters", "year", "month") else c for c in RAW_COLUMNS)
TYPED_SQL = f"""{RAW_SQL}, nulled AS (SELECT {_NULLED} FROM raw), typed AS (
  SELECT {_TYPED} FROM nulled WHERE gbifID IS NOT NULL AND scientificName IS NOT NULL AND taxonKey IS NOT NULL AND decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL
), kept AS (SELECT * FROM typed WHERE gbifID IS NOT NULL AND taxonKey IS NOT NULL AND decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL)"""
_CANON = ", ".join(f"CAST({c} AS BIGINT) AS {c}" if c in ("gbifID", "taxonKey", "year", "month") else c for c in RAW_COLUMNS)
_BASIS = "basisOfRecord IN ('HUMAN_OBSERVATION', 'MACHINE_OBSERVATION', 'PRESERVED_SPECIMEN')"
_UNC = "coalesce(coordinateUncertaintyInMeters, 0) < 1000"
CLEAN_SQL = f"{TYPED_SQL}, clean AS (SELECT {_CANON} FROM kept WHERE {_BASIS} AND {_UNC})"
_LON, _LAT = "decimalLongitude", "decimalLatitude"
_CROSS = "((y1 > {y}) <> (y2 > {y})) AND {x} < (x2 - x1) * ({y} - y1) / (CASE WHEN y2 <> y1 THEN y2 - y1 END) + x1"
_ON = "(x2 - x1) * ({y} - y1) - (y2 - y1) * ({x} - x1) = 0 AND {x} BETWEEN least(x1, x2) AND greatest(x1, x2) AND {y} BETWEEN least(y1, y2) AND greatest(y1, y2)"
SITE_SQL = f"""occ AS ({X.OCC}), site AS ({X.SITE}), edge AS (
  SELECT index_right, cx + r AS x1, cy AS y1, cx AS x2, cy + r AS y2 FROM site UNION ALL SELECT index_right, cx, cy + r, cx - r, cy FROM site
  UNION ALL SELECT index_right, cx - r, cy, cx, cy - r FROM site UNION ALL SELECT index_right, cx, cy - r, cx + r, cy FROM site
)"""
_OF_POINT = {"x": "o.decimalLongitude", "y": "o.decimalLatitude"}
HITS_SQL = f"""{SITE_SQL}, hits AS (
  SELECT o.gbifID, s.index_right, sum(CASE WHEN {_CROSS.format(**_OF_POINT)} THEN 1 ELSE 0 END) % 2 = 1 AS odd, max(CASE WHEN {_ON.format(**_OF_POINT)} THEN 1 ELSE 0 END) = 1 AS on_edge
  FROM occ AS o JOIN site AS s ON o.decimalLongitude BETWEEN s.cx - s.r AND s.cx + s.r AND o.decimalLatitude BETWEEN s.cy - s.r AND s.cy + s.r JOIN edge AS e ON e.index_right = s.index_right
  GROUP BY o.gbifID, s.index_right
)"""
JOINED_SQL = f"""{HITS_SQL}, pair AS (SELECT gbifID, index_right FROM hits WHERE odd AND NOT on_edge), joined AS (
  SELECT o.*, p.index_right, s.SITECODE, s.SITENAME, s.MS, s.SITETYPE FROM occ AS o LEFT JOIN pair AS p ON o.gbifID = p.gbifID LEFT JOIN site AS s ON p.index_right = s.index_right
)"""


def _laea_sql(lon: str, lat: str, source: str, names: str) -> str:
    """``source`` with x and y in metres for a pair of degree columns."""
    e = E2**0.5
    return f"""SELECT {names}, {FE!r}e0 + b * {D!r}e0 * cosb * sin(dl) AS x, {FN!r}e0 + b / {D!r}e0 * ({COS_B0!r}e0 * sinb - {SIN_B0!r}e0 * cosb * cos(dl)) AS y FROM (
  SELECT *, {RQ!r}e0 * sqrt(2e0 / (1e0 + {SIN_B0!r}e0 * sinb + {COS_B0!r}e0 * cosb * cos(dl))) AS b FROM (
    SELECT *, sqrt(1e0 - sinb * sinb) AS cosb FROM (
      SELECT *, greatest(-1e0, least(1e0, {1 - E2!r}e0 * (sn / (1e0 - {E2!r} * sn * sn) - {1 / (2 * e)!r}e0 * ln((1e0 - {e!r}e0 * sn) / (1e0 + {e!r}e0 * sn))) / {QP!r}e0)) AS sinb FROM (
        SELECT *, sin(radians({lat})) AS sn, radians({lon}) - {LON0!r}e0 AS dl FROM {source}))))"""


METRIC_SQL = f"""{JOINED_SQL}, vertex AS (SELECT index_right, k, vx, vy FROM (
  SELECT index_right, 0 AS k, cx + r AS vx, cy AS vy FROM site UNION ALL SELECT index_right, 1, cx, cy + r FROM site UNION ALL SELECT index_right, 2, cx - r, cy FROM site UNION ALL SELECT index_right, 3, cx, cy - r FROM site)
), mvertex AS ({_laea_sql("vx", "vy", "vertex", "index_right, k")}), medge AS (
  SELECT a.index_right, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM mvertex AS a JOIN mvertex AS b ON a.index_right = b.index_right AND b.k = (a.k + 1) % 4
), mocc AS ({_laea_sql("decimalLongitude", "decimalLatitude", "occ", "gbifID")})"""
_T = "greatest(0e0, least(1e0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))))"
_DIST = f"sqrt((x - (x1 + {_T} * (x2 - x1))) * (x - (x1 + {_T} * (x2 - x1))) + (y - (y1 + {_T} * (y2 - y1))) * (y - (y1 + {_T} * (y2 - y1))))"
CLASS_SQL = f"""{METRIC_SQL}, din AS (SELECT p.gbifID, p.index_right, min({_DIST}) AS d FROM pair AS p JOIN mocc AS m ON p.gbifID = m.gbifID JOIN medge AS e ON p.index_right = e.index_right GROUP BY p.gbifID, p.index_right), mout AS (
  SELECT * FROM mocc WHERE gbifID NOT IN (SELECT gbifID FROM pair)
), crossed AS (
  SELECT m.gbifID, e.index_right, min({_DIST}) AS d, sum(CASE WHEN {_CROSS.format(x="x", y="y")} THEN 1 ELSE 0 END) % 2 = 1 AS odd FROM mout AS m CROSS JOIN medge AS e GROUP BY m.gbifID, e.index_right
), dout AS (SELECT gbifID, min(CASE WHEN odd THEN 0e0 ELSE d END) AS d FROM crossed GROUP BY gbifID), classified AS (
  SELECT j.*, j.index_right IS NOT NULL AS baseline_within, coordinateUncertaintyInMeters AS uncertainty_m, i.d AS dist_to_boundary_m, CASE WHEN j.index_right IS NULL THEN o.d END AS dist_to_polygon_m,
    CASE WHEN j.index_right IS NOT NULL AND i.d > coordinateUncertaintyInMeters THEN '{CERTAINLY_INSIDE}' WHEN j.index_right IS NOT NULL AND i.d <= coordinateUncertaintyInMeters THEN '{INSIDE_UNCERTAIN}'
      WHEN j.index_right IS NULL AND o.d <= coordinateUncertaintyInMeters THEN '{OUTSIDE_UNCERTAIN}' WHEN j.index_right IS NULL AND o.d > coordinateUncertaintyInMeters THEN '{CERTAINLY_OUTSIDE}' ELSE '{UNCLASSIFIED}' END AS uncertainty_class
  FROM joined AS j LEFT JOIN din AS i ON j.gbifID = i.gbifID AND j.index_right = i.index_right LEFT JOIN dout AS o ON j.gbifID = o.gbifID
)"""

_W3 = 3**0.5
_AXIAL = f"""SELECT *, CASE WHEN dq > dr AND dq > ds THEN -nr - ns ELSE nq END AS cq, CASE WHEN dq > dr AND dq > ds THEN nr WHEN dr > ds THEN -nq - ns ELSE nr END AS cr FROM (
  SELECT *, abs(nq - fq) AS dq, abs(nr - fr) AS dr, abs(ns + fq + fr) AS ds FROM (
    SELECT *, floor(fq + 5e-1) AS nq, floor(fr + 5e-1) AS nr, floor(-fq - fr + 5e-1) AS ns FROM (
      SELECT *, (x * {_W3 / 3!r}e0 - y / 3e0) / {HEX!r}e0 AS fq, y * {2.0 / 3!r}e0 / {HEX!r}e0 AS fr FROM {{source}})))"""
_CELL = "'hex:' || CAST(CAST(cq AS BIGINT) AS STRING) || ':' || CAST(CAST(cr AS BIGINT) AS STRING)"
ASSIGN_SQL = f"{METRIC_SQL}, axial AS ({_AXIAL.format(source='mocc')}), assigned AS (SELECT o.*, CAST(cq AS BIGINT) AS q, CAST(cr AS BIGINT) AS r, {_CELL} AS cell_id FROM axial AS a JOIN occ AS o ON a.gbifID = o.gbifID)"
# The study area's cells: candidates in one box around all of it, then the exact test with each site.
_FIRST = {"x": "vx", "y": "vy"}
GRID_SQL = f"""{ASSIGN_SQL}, area AS (SELECT index_right FROM site WHERE MS IN ({", ".join(f"'{m}'" for m in AREA_MS)})), aedge AS (SELECT e.* FROM medge AS e JOIN area AS a ON e.index_right = a.index_right), box AS (
  SELECT min(x1) AS lx, max(x1) AS hx, min(y1) AS ly, max(y1) AS hy FROM aedge
), cand AS (
  SELECT q, r, {HEX * _W3!r}e0 * (q + r / 2e0) AS px, {HEX * 1.5!r}e0 * r AS py FROM (
    SELECT r, unnest(range(CAST(floor(lx / {HEX * _W3!r}e0 - r / 2e0) AS BIGINT) - 2, CAST(floor(hx / {HEX * _W3!r}e0 - r / 2e0) AS BIGINT) + 3)) AS q FROM (
      SELECT *, unnest(range(CAST(floor(ly / {HEX * 1.5!r}e0) AS BIGINT) - 2, CAST(floor(hy / {HEX * 1.5!r}e0) AS BIGINT) + 3)) AS r FROM box))
), step AS (
  SELECT * FROM (VALUES (0, 0e0, {HEX!r}e0, {-HEX * _W3 / 2!r}e0, {HEX / 2!r}e0), (1, {-HEX * _W3 / 2!r}e0, {HEX / 2!r}e0, {-HEX * _W3 / 2!r}e0, {-HEX / 2!r}e0), (2, {-HEX * _W3 / 2!r}e0, {-HEX / 2!r}e0, 0e0, {-HEX!r}e0),
    (3, 0e0, {-HEX!r}e0, {HEX * _W3 / 2!r}e0, {-HEX / 2!r}e0), (4, {HEX * _W3 / 2!r}e0, {-HEX / 2!r}e0, {HEX * _W3 / 2!r}e0, {HEX / 2!r}e0), (5, {HEX * _W3 / 2!r}e0, {HEX / 2!r}e0, 0e0, {HEX!r}e0)) AS t(k, sx, sy, tx, ty)
), cedge AS (SELECT q, r, k, px + sx AS u1, py + sy AS v1, px + tx AS u2, py + ty AS v2 FROM cand CROSS JOIN step), meet AS (
  SELECT q, r, c.k, e.*, c.u1, c.v1, (x2 - x1) * (v1 - y1) - (y2 - y1) * (u1 - x1) AS ta, (x2 - x1) * (v2 - y1) - (y2 - y1) * (u2 - x1) AS tb, (u2 - u1) * (y1 - v1) - (v2 - v1) * (x1 - u1) AS tc, (u2 - u1) * (y2 - v1) - (v2 - v1) * (x2 - u1) AS td,
    ((y1 > v1) <> (y2 > v1)) AND u1 < (x2 - x1) * (v1 - y1) / (CASE WHEN y2 <> y1 THEN y2 - y1 END) + x1 AS cell_ray, ((v1 > y1) <> (v2 > y1)) AND x1 < (u2 - u1) * (y1 - v1) / (CASE WHEN v2 <> v1 THEN v2 - v1 END) + u1 AS site_ray
  FROM cedge AS c CROSS JOIN aedge AS e
), inner_cells AS (
  SELECT q, r FROM meet WHERE (ta > 0) <> (tb > 0) AND (tc > 0) <> (td > 0)
  UNION SELECT q, r FROM meet WHERE k = 0 GROUP BY q, r, index_right HAVING sum(CASE WHEN cell_ray THEN 1 ELSE 0 END) % 2 = 1
  UNION SELECT q, r FROM meet GROUP BY q, r, index_right, x1, y1 HAVING sum(CASE WHEN site_ray THEN 1 ELSE 0 END) % 2 = 1
), grid AS (SELECT 'hex:' || CAST(q AS STRING) || ':' || CAST(r AS STRING) AS cell_id, q, r FROM inner_cells)"""
CELLS_SQL = f"""{GRID_SQL}, selected AS (SELECT * FROM assigned WHERE gbifID IN (SELECT gbifID FROM hits WHERE (odd OR on_edge) AND index_right IN (SELECT index_right FROM area))), counted AS (
  SELECT cell_id, count(*) AS n_occurrences, count(DISTINCT scientificName) AS n_species FROM selected GROUP BY cell_id
), cells AS (SELECT g.*, coalesce(n_occurrences, 0) AS n_occurrences, coalesce(n_species, 0) AS n_species FROM grid AS g LEFT JOIN counted AS c ON g.cell_id = c.cell_id)"""
LINKS_SQL = f"""{CELLS_SQL}, found AS (
  SELECT a.cell_id, b.cell_id AS nbr_id FROM cells AS a JOIN cells AS b ON (b.q - a.q, b.r - a.r) IN ((1, 0), (-1, 0), (0, 1), (0, -1), (1, -1), (-1, 1))
), links AS (SELECT cell_id, nbr_id, 1e0 / count(*) OVER (PARTITION BY cell_id) AS w FROM found), v AS (SELECT cell_id, CASE WHEN n_occurrences > 0 THEN 1e0 ELSE 0e0 END AS presence, ln(1e0 + n_occurrences) AS log_n FROM cells)"""


def _lag_sql(variable: str) -> str:
    return f"""{LINKS_SQL}, z AS (SELECT cell_id, {variable} - (SELECT avg({variable}) FROM v) AS z FROM v), lag AS (SELECT l.cell_id, sum(w * z) AS lag FROM links AS l JOIN z ON l.nbr_id = z.cell_id GROUP BY l.cell_id), lz AS (SELECT z.*, lag FROM z LEFT JOIN lag ON z.cell_id = lag.cell_id)"""


def _pct(part: str, total: str, digits: int = 2) -> str:
    return f"CASE WHEN {total} = 0 THEN 0e0 ELSE round_even({part} / ({total} * 1e0) * 100e0, {digits}) END"


# Cleaning ---------------------------------------------------------------------------------------------


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = clean.drop_missing(clean.null_out(X.raw(spark, sf_dir)))
    return clean.drop_missing(clean.coerce_numbers(raw), clean.REQUIRED_TYPED)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.filter_occurrences(X.raw(spark, sf_dir))


@query(f"WITH {TYPED_SQL} SELECT gbifID, taxonKey, decimalLatitude, decimalLongitude FROM kept")
def filter_required_nulls(spark, sf_dir):
    return _kept(spark, sf_dir).select("gbifID", "taxonKey", "decimalLatitude", "decimalLongitude")


@query(f"WITH {RAW_SQL} SELECT gbifID, basisOfRecord FROM raw WHERE {_BASIS}")
def filter_basis(spark, sf_dir):
    return X.raw(spark, sf_dir).filter(basis_filter(FilterSpec())).select("gbifID", "basisOfRecord")


@query(f"WITH occ AS ({X.OCC}) SELECT gbifID, coordinateUncertaintyInMeters FROM occ WHERE {_UNC}")
def filter_uncertainty_null_zero(spark, sf_dir):
    return X.occurrences(spark, sf_dir).filter(uncertainty_filter(FilterSpec())).select("gbifID", "coordinateUncertaintyInMeters")


@query(f"WITH occ AS ({X.OCC}) SELECT gbifID, decimalLatitude, decimalLongitude FROM occ WHERE decimalLatitude >= 40 AND decimalLatitude <= 55.5e0 AND decimalLongitude >= -5.25e0 AND decimalLongitude <= 20")
def filter_bbox(spark, sf_dir):
    return X.occurrences(spark, sf_dir).filter(bbox_filter(BOX)).select("gbifID", "decimalLatitude", "decimalLongitude")


@query(f"WITH occ AS ({X.OCC}) SELECT gbifID, year FROM occ WHERE year IS NOT NULL AND year >= 1996 AND year <= 1999")
def filter_year_range(spark, sf_dir):
    return X.occurrences(spark, sf_dir).filter(year_filter(YEARS)).select("gbifID", "year")


@query(
    f"WITH {TYPED_SQL} SELECT CAST(gbifID AS BIGINT) AS gbifID FROM typed WHERE (taxonKey = 3 OR taxonKey = 5 OR taxonKey = 8 OR taxonKey = 13) AND countryCode IN ('AT','BE','BG','HR','CY','CZ','DK','EE','FI','FR','DE','GR','HU','IE','IT','LV','LT','LU','MT','NL','PL','PT','RO','SK','SI','ES','SE','IS','NO','CH','LI','GB') "
    f"AND decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL AND coordinateUncertaintyInMeters < 1000 AND {_BASIS} AND gbifID IS NOT NULL"
)
def predicate_tree(spark, sf_dir):
    typed = clean.coerce_numbers(clean.drop_missing(clean.null_out(X.raw(spark, sf_dir)))).dropna(subset=["gbifID"])
    return clean.cast_integers(typed.filter(predicate(request_predicate([3, 5, 8, 13]))), ["gbifID"]).select("gbifID")


@query(f"WITH s AS ({X.SPECIES}), k AS (SELECT coalesce({_num('acceptedUsageKey')}, {_num('usageKey')}) AS v FROM s) SELECT DISTINCT CAST(v AS BIGINT) AS taxonKey FROM k WHERE v IS NOT NULL")
def coalesce_taxon_keys(spark, sf_dir):
    return clean.taxon_keys(X.species(spark, sf_dir))


@query(f"WITH {RAW_SQL} SELECT {', '.join(f'{_num(c)} AS {c}' for c in ('gbifID', 'taxonKey', 'decimalLatitude', 'decimalLongitude', 'coordinateUncertaintyInMeters', 'year', 'month'))} FROM raw")
def numeric_coercion(spark, sf_dir):
    return clean.coerce_numbers(X.raw(spark, sf_dir)).select("gbifID", "taxonKey", "decimalLatitude", "decimalLongitude", "coordinateUncertaintyInMeters", "year", "month")


@query(f"WITH {TYPED_SQL} SELECT {_CANON} FROM kept")
def canonical_projection(spark, sf_dir):
    return clean.canonical(_kept(spark, sf_dir))


@query(f"WITH {CLEAN_SQL} SELECT * FROM clean")
def filter_pipeline(spark, sf_dir):
    return _clean(spark, sf_dir)


@query(f"WITH {CLEAN_SQL} " + " UNION ALL ".join(f"SELECT '{c}' AS counter, CAST({c} AS STRING) AS value, count(*) AS n FROM clean WHERE {c} IS NOT NULL GROUP BY {c}" for c in summaries.COUNTERS))
def filter_counts(spark, sf_dir):
    return summaries.counters(_clean(spark, sf_dir))


@query(
    f"WITH {CLEAN_SQL} SELECT (SELECT count(*) FROM raw) AS n_raw, count(*) AS n_filtered, {_pct('count(*)', '(SELECT count(*) FROM raw)')} AS pct_kept, count(DISTINCT scientificName) AS n_names, count(DISTINCT taxonKey) AS n_taxon_keys, count(DISTINCT countryCode) AS n_countries, "
    "min(year) AS year_min, max(year) AS year_max, min(decimalLatitude) AS decimalLatitude_min, max(decimalLatitude) AS decimalLatitude_max, min(decimalLongitude) AS decimalLongitude_min, max(decimalLongitude) AS decimalLongitude_max FROM clean"
)
def filter_report_scalars(spark, sf_dir):
    raw = X.raw(spark, sf_dir)
    return summaries.filter_report(raw.count(), clean.filter_occurrences(raw))


def _summary_sql(key: str, tail: str = "") -> str:
    return f"WITH {CLEAN_SQL} SELECT {key}, count(*) AS occurrences FROM clean WHERE {key} IS NOT NULL GROUP BY {key}{tail}"


@query(_summary_sql("scientificName"))
def species_summary(spark, sf_dir):
    return summaries.group_summary(_clean(spark, sf_dir), "scientificName")


@query(_summary_sql("countryCode"))
def country_summary(spark, sf_dir):
    return summaries.group_summary(_clean(spark, sf_dir), "countryCode")


@query(_summary_sql("basisOfRecord"))
def basis_summary(spark, sf_dir):
    return summaries.group_summary(_clean(spark, sf_dir), "basisOfRecord")


@query(_summary_sql("year"))
def year_summary(spark, sf_dir):
    return summaries.year_summary(_clean(spark, sf_dir))


@query(_summary_sql("scientificName", " ORDER BY occurrences DESC, scientificName LIMIT 10"))
def top10_species(spark, sf_dir):
    return summaries.top_groups(_clean(spark, sf_dir), "scientificName", 10)


# Profiles ---------------------------------------------------------------------------------------------

_DATE = r"^\d{4}(-\d{2}(-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?)?)?$"


def _is_date(c: str) -> str:
    return f"(regexp_matches({c}, '{_DATE}') AND TRY_CAST(substring({c}, 1, 10) || CASE length({c}) WHEN 4 THEN '-01-01' WHEN 7 THEN '-01' ELSE '' END AS DATE) IS NOT NULL)"


def _profile_sql() -> str:
    from .schemas import COLUMN_ROLES, LOGICAL_TYPES, MEASURED

    kinds = {c: "bigint" for c in ("gbifID", "taxonKey", "year", "month")} | {c: "double" for c in ("decimalLatitude", "decimalLongitude", "coordinateUncertaintyInMeters")}
    parts = []
    for i, c in enumerate(RAW_COLUMNS):
        numbers = f"CAST(min({c}) AS DOUBLE), CAST(max({c}) AS DOUBLE), round_even(avg({c} * 1e0), 4), round_even(CAST(median({c}) AS DOUBLE), 4)" if c in MEASURED else "NULL, NULL, NULL, NULL"
        dates = f"count(CASE WHEN {_is_date(c)} THEN 1 END), {_pct(f'count(CASE WHEN {_is_date(c)} THEN 1 END)', f'count({c})', 4)}" if c == "eventDate" else "NULL, NULL"
        pct = _pct(f"(count(*) - count({c}))", "count(*)", 4)
        flags = f"""coalesce(nullif(concat_ws(' | ', CASE WHEN {pct} >= 20 THEN 'high_missingness' WHEN {pct} > 0 THEN 'some_missingness' END, CASE WHEN count(DISTINCT {c}) = 1 AND count({c}) > 0 THEN 'constant_column' END, CASE WHEN count(DISTINCT {c}) <= 12 THEN 'low_cardinality' END), ''), 'none')"""
        parts.append(f"SELECT {i}, '{c}', '{COLUMN_ROLES[c]}', '{kinds.get(c, 'string')}', '{LOGICAL_TYPES[c]}', count({c}), count(*) - count({c}), {pct}, count(DISTINCT {c}), {numbers}, {dates}, {flags} FROM clean")
    names = "ord, \"column\", role, dtype, logical_type, non_null, missing, missing_pct, unique_values, numeric_min, numeric_max, numeric_mean, numeric_median, date_like_valid_values, date_like_valid_pct, warning_flags"
    return f"WITH {CLEAN_SQL}, p({names}) AS ({' UNION ALL '.join(parts)}) SELECT * FROM p"


@query(_profile_sql())
def schema_profile(spark, sf_dir):
    return profile.schema_profile(_clean(spark, sf_dir))


@query(
    f"WITH {CLEAN_SQL}, d AS ({' UNION '.join(f'''SELECT '{c}' AS c, CAST({c} AS STRING) AS v FROM clean WHERE {c} IS NOT NULL''' for c in RAW_COLUMNS)}), r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY v) AS k FROM d) "
    "SELECT c AS \"column\", string_agg(v, ' | ' ORDER BY k) AS sample_values FROM r WHERE k <= 3 GROUP BY c"
)
def sample_values(spark, sf_dir):
    return profile.sample_values(_clean(spark, sf_dir))


@query(f"WITH {RAW_SQL} SELECT count(eventDate) AS non_null, count(CASE WHEN {_is_date('eventDate')} THEN 1 END) AS valid, {_pct('count(CASE WHEN ' + _is_date('eventDate') + ' THEN 1 END)', 'count(eventDate)', 4)} AS valid_pct FROM raw")
def date_quality(spark, sf_dir):
    return profile.date_quality(X.raw(spark, sf_dir))


@query(f"WITH {_profile_sql()[5:].rpartition(' SELECT')[0]} SELECT \"column\", warning_flags AS flags FROM p")
def column_warning_flags(spark, sf_dir):
    return schema_profile(spark, sf_dir).select("column", warning_flags(F.col("missing_pct"), F.col("unique_values"), F.col("non_null")).alias("flags"))


@query(f"WITH {RAW_SQL} SELECT (SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT taxonKey, countryCode FROM raw)) AS duplicates")
def duplicate_counts(spark, sf_dir):
    return profile.duplicate_counts(X.raw(spark, sf_dir), "taxonKey", "countryCode")


_IN = "lon BETWEEN -35 AND 45 AND lat BETWEEN 24 AND 75"


def _readiness_sql() -> str:
    n = lambda cond: f"count(CASE WHEN {cond} THEN 1 END)"
    flag = lambda v, bad: f"CASE WHEN {v} = 0 THEN 'PASS' ELSE '{bad}' END"
    dup = "count(*) - count(DISTINCT gbifID) - coalesce(max(CASE WHEN gbifID IS NULL THEN 1 END), 0)"
    pairs = "count(CASE WHEN lon IS NOT NULL AND lat IS NOT NULL THEN 1 END) - count(DISTINCT CASE WHEN lon IS NOT NULL AND lat IS NOT NULL THEN (lon, lat) END)"
    rows = [("dataset", "rows", "count(*)", "'INFO'")]
    rows += [
        ("gbifID", "missing_gbifID", n("gbifID IS NULL"), "FAIL"),
        ("gbifID", "duplicate_gbifID", dup, "FAIL"),
        ("numeric_validation", "invalid_longitude_numeric", n("decimalLongitude IS NOT NULL AND lon IS NULL"), "FAIL"),
        ("numeric_validation", "invalid_latitude_numeric", n("decimalLatitude IS NOT NULL AND lat IS NULL"), "FAIL"),
        ("numeric_validation", "invalid_uncertainty_numeric", n("coordinateUncertaintyInMeters IS NOT NULL AND unc IS NULL"), "WARNING"),
        ("missing_values", "missing_longitude", n("decimalLongitude IS NULL"), "FAIL"),
        ("missing_values", "missing_latitude", n("decimalLatitude IS NULL"), "FAIL"),
        ("missing_values", "missing_uncertainty", n("coordinateUncertaintyInMeters IS NULL"), "WARNING"),
        ("coordinate_ranges", "invalid_longitude_range", n("lon NOT BETWEEN -180 AND 180"), "FAIL"),
        ("coordinate_ranges", "invalid_latitude_range", n("lat NOT BETWEEN -90 AND 90"), "FAIL"),
        ("suspicious_coordinates", "records_at_0_0", n("lon = 0 AND lat = 0"), "WARNING"),
        ("suspicious_coordinates", "records_with_longitude_0", n("lon = 0"), "'INFO'"),
        ("suspicious_coordinates", "records_with_latitude_0", n("lat = 0"), "'INFO'"),
        ("duplicate_coordinates", "duplicate_coordinate_pairs", pairs, "WARNING"),
        ("study_area_plausibility", "records_inside_europe_bbox", n(_IN), "'INFO'"),
        ("study_area_plausibility", "records_outside_europe_bbox", n(f"lon IS NOT NULL AND lat IS NOT NULL AND NOT ({_IN})"), "WARNING"),
        ("uncertainty_field", "non_null_uncertainty_values", "count(unc)", "'INFO'"),
        ("uncertainty_field", "negative_uncertainty_values", n("unc < 0"), "WARNING"),
        ("uncertainty_field", "zero_uncertainty_values", n("unc = 0"), "'INFO'"),
    ]
    parts = [f"SELECT '{s}' AS section, '{m}' AS metric, CAST({v} AS STRING) AS value, {st if st.startswith(chr(39)) else flag(v, st)} AS status FROM t" for s, m, v, st in rows]
    return f"WITH {RAW_SQL}, t AS (SELECT *, {_num(_LON)} AS lon, {_num(_LAT)} AS lat, {_num('coordinateUncertaintyInMeters')} AS unc FROM raw), report AS ({' UNION ALL '.join(parts)})"


_COUNTED = ["rows", "missing_gbifID", "duplicate_gbifID", "invalid_longitude_numeric", "invalid_latitude_numeric", "invalid_uncertainty_numeric", "missing_longitude", "missing_latitude", "missing_uncertainty", "invalid_longitude_range", "invalid_latitude_range", "records_at_0_0", "records_with_longitude_0", "records_with_latitude_0", "duplicate_coordinate_pairs", "records_inside_europe_bbox", "records_outside_europe_bbox", "non_null_uncertainty_values", "negative_uncertainty_values", "zero_uncertainty_values"]


def _report(spark, sf_dir) -> DataFrame:
    return readiness.readiness_report(X.raw(spark, sf_dir), "TEST")


@query(f"{_readiness_sql()} SELECT * FROM report")
def readiness_report(spark, sf_dir):
    return _report(spark, sf_dir).filter(F.col("metric").isin(*_COUNTED)).select("section", "metric", "value", "status")


@query(
    f"""{_readiness_sql()}, n AS (SELECT count(CASE WHEN status = 'FAIL' THEN 1 END) AS n_fail, count(CASE WHEN status = 'WARNING' THEN 1 END) AS n_warning FROM report)
SELECT *, CASE WHEN n_fail > 0 THEN 'FAIL' WHEN n_warning > 0 THEN 'PASS WITH WARNINGS' ELSE 'PASS' END AS final_status, CASE WHEN n_fail > 0 THEN '{readiness.FAILED}' WHEN n_warning > 0 THEN '{readiness.WARNED}' ELSE '{readiness.PASSED}' END AS notes FROM n"""
)
def readiness_verdict(spark, sf_dir):
    return readiness.readiness_verdict(_report(spark, sf_dir).filter(F.col("section") != "final_assessment"))


def _full_readiness_sql() -> str:
    """All rows of the report in their order, with the fixed notes."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    top = lambda zero, other: f"coalesce((SELECT string_agg(CAST(round_even(v, 4) AS STRING) || ':' || n, '; ' ORDER BY n DESC, v) FROM (SELECT {other} AS v, count(*) AS n FROM t WHERE {zero} = 0 AND {other} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 5)), '')"
    own = {
        "lon0_unique_latitudes": "count(DISTINCT CASE WHEN lon = 0 THEN lat END)", "lon0_top_latitudes": top("lon", "lat"), "lat0_unique_longitudes": "count(DISTINCT CASE WHEN lat = 0 THEN lon END)", "lat0_top_longitudes": top("lat", "lon"),
        "min_longitude": "min(lon)", "max_longitude": "max(lon)", "min_latitude": "min(lat)", "max_latitude": "max(lat)", "uncertainty_min": "min(unc)", "uncertainty_median": "median(unc)", "uncertainty_max": "max(unc)",
    }
    fixed = [("dataset", "rows", "(SELECT value FROM report WHERE metric = 'rows')", "'INFO'", ""), ("dataset", "columns", f"'{len(RAW_COLUMNS)}'", "'INFO'", ""), ("dataset", "input_zip", "''", "'INFO'", ""), ("dataset", "inner_csv", "''", "'INFO'", "")]
    fixed += [("required_columns", "all_required_columns_present", "'True'", "'PASS'", "")] + [("optional_columns", f"{c}_present", "'True'", "'INFO'", "") for c in ("taxonKey", "scientificName", "countryCode", "year")]
    for section, metric, _, _, note in readiness.checks(readiness.EUROPE):
        of = lambda c, m=metric: f"(SELECT {c} FROM report WHERE metric = '{m}')"
        fixed.append((section, metric, own[metric] if "top" in metric else f"(SELECT CAST({own[metric]} AS STRING) FROM t)" if metric in own else of("value"), "'INFO'" if metric in own else of("status"), note))
    parts = [f"SELECT {i} AS ord, '{s}' AS section, '{m}' AS metric, {v} AS value, {st} AS status, {quoted(note)} AS notes" for i, (s, m, v, st, note) in enumerate(fixed)]
    n = len(fixed)
    return f"""{_readiness_sql()}, long AS (SELECT * FROM ({" UNION ALL ".join(parts)}) WHERE NOT (metric IN ('lon0_unique_latitudes', 'lon0_top_latitudes', 'lat0_unique_longitudes', 'lat0_top_longitudes') AND value IN ('0', ''))),
n AS (SELECT count(CASE WHEN status = 'FAIL' THEN 1 END) AS n_fail, count(CASE WHEN status = 'WARNING' THEN 1 END) AS n_warning FROM long),
verdict AS (SELECT CASE WHEN n_fail > 0 THEN 'FAIL' WHEN n_warning > 0 THEN 'PASS WITH WARNINGS' ELSE 'PASS' END AS s, CASE WHEN n_fail > 0 THEN '{readiness.FAILED}' WHEN n_warning > 0 THEN '{readiness.WARNED}' ELSE '{readiness.PASSED}' END AS notes FROM n)
SELECT ord, 'TEST' AS dataset_name, section, metric, value, status, notes FROM long UNION ALL SELECT {n}, 'TEST', 'final_assessment', 'final_status', s, s, notes FROM verdict UNION ALL SELECT {n + 1}, 'TEST', 'final_assessment', 'validation_timestamp', '', 'INFO', ''"""


@query(_full_readiness_sql())
def readiness_full_report(spark, sf_dir):
    return _report(spark, sf_dir)


@query(f"WITH {RAW_SQL} SELECT {_num(_LAT)} AS value, count(*) AS n FROM raw WHERE {_num(_LON)} = 0 AND {_num(_LAT)} IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 5")
def lon0_top_latitudes(spark, sf_dir):
    return readiness.top_values(X.raw(spark, sf_dir), "decimalLongitude", "decimalLatitude")


@query(f"WITH occ AS ({X.OCC}) SELECT gbifID, scientificName, decimalLongitude, decimalLatitude, year FROM occ WHERE NOT (decimalLongitude BETWEEN -5 AND 25 AND decimalLatitude BETWEEN 38 AND 60)")
def outside_bbox_records(spark, sf_dir):
    return readiness.outside_bounds(X.occurrences(spark, sf_dir), {"min_lon": -5.0, "max_lon": 25.0, "min_lat": 38.0, "max_lat": 60.0})


@query(f"WITH occ AS ({X.OCC}) SELECT min(decimalLongitude) AS min_lon, max(decimalLongitude) AS max_lon, min(decimalLatitude) AS min_lat, max(decimalLatitude) AS max_lat FROM occ")
def spatial_extent(spark, sf_dir):
    return readiness.spatial_extent(X.occurrences(spark, sf_dir))


# Sites and spatial joins ------------------------------------------------------------------------------


def _selected(spark, sf_dir, mode, value) -> DataFrame:
    return sites.select_sites(X.sites(spark, sf_dir), mode, value).select("index_right", "SITECODE", "MS")


def _select_sql(where: str) -> str:
    return f"WITH site AS ({X.SITE}) SELECT index_right, SITECODE, MS FROM site WHERE {where}"


@query(_select_sql("SITECODE = 'S7'"))
def select_sites_by_code(spark, sf_dir):
    return _selected(spark, sf_dir, "site_code", "S7")


@query(_select_sql("SITECODE IN ('S3', 'S5', 'S8', 'S99999')"))
def select_sites_by_codes(spark, sf_dir):
    return _selected(spark, sf_dir, "site_code_list", ["S3", "S5", "S8", "S99999"])


@query(_select_sql("MS = '3'"))
def select_sites_by_ms(spark, sf_dir):
    return _selected(spark, sf_dir, "member_state", "3")


def _area(spark, sf_dir) -> DataFrame:
    return X.sites(spark, sf_dir).filter(F.col("MS").isin(*AREA_MS))


def _in_area(spark, sf_dir) -> DataFrame:
    return spatial.points_in_area(X.occurrences(spark, sf_dir), _area(spark, sf_dir), "test area")


@query(f"WITH {HITS_SQL} SELECT gbifID, scientificName, year, 'test area' AS study_area_name FROM occ WHERE gbifID IN (SELECT gbifID FROM hits JOIN site ON hits.index_right = site.index_right WHERE (odd OR on_edge) AND MS IN ({', '.join(f'{chr(39)}{m}{chr(39)}' for m in AREA_MS)}))")
def study_area_points(spark, sf_dir):
    return _in_area(spark, sf_dir).select("gbifID", "scientificName", "year", "study_area_name")


def _joined(spark, sf_dir) -> DataFrame:
    return spatial.join_sites(X.occurrences(spark, sf_dir), X.sites(spark, sf_dir))


@query(f"WITH {JOINED_SQL} SELECT gbifID, index_right, SITECODE, SITENAME, MS, SITETYPE FROM joined")
def pip_left_join(spark, sf_dir):
    return _joined(spark, sf_dir).select("gbifID", "index_right", "SITECODE", "SITENAME", "MS", "SITETYPE")


@query(f"WITH {HITS_SQL} SELECT gbifID, index_right, odd AND NOT on_edge AS is_within, odd OR on_edge AS does_intersect FROM hits WHERE odd OR on_edge")
def containment_predicates(spark, sf_dir):
    points, shapes = X.occurrences(spark, sf_dir), X.sites(spark, sf_dir)
    inner = spatial.containing_pairs(points, shapes, within).withColumn("is_within", F.lit(True))
    outer = spatial.containing_pairs(points, shapes, intersects).withColumn("does_intersect", F.lit(True))
    return outer.join(inner, ["gbifID", "index_right"], "left").select("gbifID", "index_right", F.coalesce("is_within", F.lit(False)).alias("is_within"), "does_intersect")


@query(f"WITH {JOINED_SQL} SELECT count(*) AS n_rows, count(SITECODE) AS n_matched, {_pct('count(SITECODE)', 'count(*)')} AS pct_matched FROM joined")
def site_match_ratio(spark, sf_dir):
    return metrics.match_ratio(_joined(spark, sf_dir))


@query(f"WITH {METRIC_SQL} SELECT gbifID, round(x, 3) AS x, round(y, 3) AS y FROM mocc")
def laea_projection(spark, sf_dir):
    m = X.occurrences(spark, sf_dir).select("gbifID", laea(F.col(_LON), F.col(_LAT)).alias("m"))
    return m.select("gbifID", F.round("m.x", 3).alias("x"), F.round("m.y", 3).alias("y"))


@query(f"WITH occ AS ({X.OCC}) SELECT gbifID, round({A!r}e0 * radians(decimalLongitude), 3) AS x, round({A!r}e0 * ln(tan(pi() / 4 + radians(decimalLatitude) / 2e0)), 3) AS y FROM occ")
def mercator_projection(spark, sf_dir):
    m = X.occurrences(spark, sf_dir).select("gbifID", mercator(F.col(_LON), F.col(_LAT)).alias("m"))
    return m.select("gbifID", F.round("m.x", 3).alias("x"), F.round("m.y", 3).alias("y"))


def _classified(spark, sf_dir) -> DataFrame:
    return uncertainty.classify_points(X.occurrences(spark, sf_dir), X.sites(spark, sf_dir))


@query(f"WITH {CLASS_SQL} SELECT gbifID, index_right, round(d, 3) AS dist_to_boundary_m FROM din")
def inside_boundary_distance(spark, sf_dir):
    return _rounded(uncertainty.inside_distances(X.occurrences(spark, sf_dir), X.sites(spark, sf_dir)), 3, "dist_to_boundary_m")


@query(f"WITH {CLASS_SQL} SELECT gbifID, round(d, 3) AS dist_to_polygon_m FROM dout")
def nearest_site_distance(spark, sf_dir):
    outside = _joined(spark, sf_dir).filter("index_right is null")
    return _rounded(spatial.nearest_distances(outside, X.sites(spark, sf_dir)), 3, "dist_to_polygon_m")


_DISTANCES = "round(uncertainty_m, 3) AS uncertainty_m, round(dist_to_boundary_m, 3) AS dist_to_boundary_m, round(dist_to_polygon_m, 3) AS dist_to_polygon_m"


@query(f"WITH {CLASS_SQL} SELECT gbifID, index_right, baseline_within, {_DISTANCES}, uncertainty_class FROM classified")
def uncertainty_class(spark, sf_dir):
    out = _classified(spark, sf_dir).select("gbifID", "index_right", "baseline_within", *uncertainty.NUMERIC_FIELDS, "uncertainty_class")
    return _rounded(out, 3, *uncertainty.NUMERIC_FIELDS)


@query(
    f"""WITH {CLASS_SQL} SELECT '{WITHIN_LABEL}' AS "Category", count(index_right) AS "Count", {_pct('count(index_right)', 'count(*)')} AS "Percentage" FROM classified
UNION ALL SELECT '{OUTSIDE_LABEL}', count(*) - count(index_right), {_pct('(count(*) - count(index_right))', 'count(*)')} FROM classified
UNION ALL SELECT uncertainty_class, count(*), {_pct('count(*)', '(SELECT count(*) FROM classified)')} FROM classified GROUP BY uncertainty_class"""
)
def uncertainty_summary(spark, sf_dir):
    return uncertainty.uncertainty_summary(_classified(spark, sf_dir))


@query(f"WITH {CLASS_SQL} SELECT gbifID, {_DISTANCES}, uncertainty_class FROM classified")
def uncertainty_mapping(spark, sf_dir):
    return _rounded(uncertainty.mapping(_classified(spark, sf_dir)), 3, *uncertainty.NUMERIC_FIELDS)


@query(f"WITH {CLASS_SQL} SELECT j.gbifID, j.index_right, c.uncertainty_class FROM joined AS j LEFT JOIN classified AS c ON j.gbifID = c.gbifID")
def uncertainty_fanout_compat(spark, sf_dir):
    return uncertainty.fanout_by_id(X.occurrences(spark, sf_dir), X.sites(spark, sf_dir))


# Metrics ----------------------------------------------------------------------------------------------

_YEARS = "min(year) AS year_min, max(year) AS year_max, count(DISTINCT year) AS n_years"


@query(
    f"WITH {JOINED_SQL} SELECT 'TEST' AS dataset_name, count(*) AS n_total_occurrences, count(SITECODE) AS n_occurrences_inside_natura, count(*) - count(SITECODE) AS n_occurrences_outside_natura, {_pct('count(SITECODE)', 'count(*)')} AS pct_inside_natura, {_pct('(count(*) - count(SITECODE))', 'count(*)')} AS pct_outside_natura FROM joined"
)
def baseline_summary(spark, sf_dir):
    return metrics.baseline_summary(_joined(spark, sf_dir), "TEST")


_ATTRIBUTES = "min(SITENAME) AS site_name, min(MS) AS ms, min(SITETYPE) AS site_type"


@query(f"WITH {JOINED_SQL} SELECT SITECODE, {_ATTRIBUTES}, count(*) AS n_occurrences, count(DISTINCT scientificName) AS n_species, {_YEARS} FROM joined WHERE SITECODE IS NOT NULL GROUP BY SITECODE")
def site_metrics(spark, sf_dir):
    return metrics.site_metrics(_joined(spark, sf_dir))


def _group_sql(key: str, source: str = f"WITH {JOINED_SQL}") -> str:
    return f"{source} SELECT {key}, count(*) AS n_occurrences, count(DISTINCT SITECODE) AS n_sites, count(DISTINCT scientificName) AS n_species, {_YEARS} FROM joined WHERE SITECODE IS NOT NULL AND {key} IS NOT NULL GROUP BY {key}"


@query(_group_sql("MS", f"WITH {JOINED_SQL.replace('FROM occ AS o LEFT JOIN pair', f'FROM (SELECT * FROM occ WHERE {_UNC}) AS o LEFT JOIN pair')}"))
def ms_metrics(spark, sf_dir):
    """The flagship: clean points, join them to sites, and sum up by member state."""
    points = X.occurrences(spark, sf_dir).filter(uncertainty_filter(FilterSpec()))
    return metrics.group_metrics(spatial.join_sites(points, X.sites(spark, sf_dir)), "MS")


@query(_group_sql("SITETYPE"))
def sitetype_metrics(spark, sf_dir):
    return metrics.group_metrics(_joined(spark, sf_dir), "SITETYPE")


@query(
    f"""WITH {JOINED_SQL}, s AS (SELECT taxonKey, min(scientificName) AS scientificName, count(*) AS n_occurrences_natura, count(DISTINCT SITECODE) AS n_sites, count(DISTINCT MS) AS n_ms, {_YEARS} FROM joined WHERE SITECODE IS NOT NULL GROUP BY taxonKey)
SELECT *, year_max - year_min AS temporal_span, CASE WHEN year_max = year_min THEN 1e0 ELSE round(n_years / (year_max - year_min + 1e0), 9) END AS temporal_completeness FROM s"""
)
def species_metrics(spark, sf_dir):
    return _rounded(metrics.species_metrics(_joined(spark, sf_dir)), 9, "temporal_completeness")


@query(
    f"""WITH {JOINED_SQL}, s AS (SELECT SITECODE, {_ATTRIBUTES}, count(*) AS n_occurrences, {_YEARS} FROM joined WHERE SITECODE IS NOT NULL GROUP BY SITECODE)
SELECT *, year_max - year_min + 1 AS expected_years, year_max - year_min + 1 - n_years AS missing_years, CASE WHEN year_min IS NOT NULL THEN round(greatest(0e0, least(1e0, (year_max - year_min + 1 - n_years) / (year_max - year_min + 1e0))), 9) END AS gap_fraction FROM s"""
)
def site_temporal_gaps(spark, sf_dir):
    return _rounded(metrics.site_temporal_gaps(_joined(spark, sf_dir)), 9, "gap_fraction")


def _class_sql(key: str, total: str, share: str) -> str:
    return f"""WITH {CLASS_SQL}, g AS (SELECT {key}, uncertainty_class, count(*) AS n_occurrences, count(DISTINCT SITECODE) AS n_sites, count(DISTINCT scientificName) AS n_species FROM classified WHERE {key} IS NOT NULL GROUP BY {key}, uncertainty_class),
t AS (SELECT *, CAST(sum(n_occurrences) OVER (PARTITION BY {key}) AS BIGINT) AS {total} FROM g) SELECT *, {_pct('n_occurrences', total)} AS {share} FROM t"""


@query(_class_sql("MS", "ms_total_occurrences", "percentage_within_ms"))
def uncertainty_ms_metrics(spark, sf_dir):
    return metrics.class_metrics(_classified(spark, sf_dir), "MS", "ms_total_occurrences", "percentage_within_ms")


@query(_class_sql("SITETYPE", "sitetype_total_occurrences", "percentage_within_sitetype"))
def uncertainty_sitetype_metrics(spark, sf_dir):
    return metrics.class_metrics(_classified(spark, sf_dir), "SITETYPE", "sitetype_total_occurrences", "percentage_within_sitetype")


@query(f"WITH {CLASS_SQL} SELECT uncertainty_class, count(*) AS n_occurrences, {_pct('count(*)', '(SELECT count(*) FROM classified)')} AS percentage FROM classified GROUP BY uncertainty_class")
def uncertainty_class_distribution(spark, sf_dir):
    return summaries.distribution(_classified(spark, sf_dir), "uncertainty_class", "uncertainty_class")


@query(
    f"WITH {CLASS_SQL} "
    + " UNION ALL ".join(f"SELECT '{c}' AS field, count({c}) AS count_non_null, round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS std, round(min({c}), 3) AS min, round(median({c}), 3) AS median, round(max({c}), 3) AS max FROM classified" for c in uncertainty.NUMERIC_FIELDS)
)
def uncertainty_numeric_summary(spark, sf_dir):
    return _rounded(metrics.numeric_summary(cut(_classified(spark, sf_dir).select(*uncertainty.NUMERIC_FIELDS)), uncertainty.NUMERIC_FIELDS), 3, "mean", "std", "min", "median", "max")


@query(
    f"WITH {CLASS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS field, count({c}) AS count, round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS std, round(min({c}), 3) AS min, round(quantile_cont({c}, 0.25), 3) AS q25, round(quantile_cont({c}, 0.5), 3) AS q50, round(quantile_cont({c}, 0.75), 3) AS q75, round(max({c}), 3) AS max FROM classified"
        for c in ("dist_to_boundary_m", "dist_to_polygon_m")
    )
)
def describe_distances(spark, sf_dir):
    distances = cut(_classified(spark, sf_dir).select("dist_to_boundary_m", "dist_to_polygon_m"))
    return _rounded(profile.describe(distances, "dist_to_boundary_m", "dist_to_polygon_m"), 3, "mean", "std", "min", "q25", "q50", "q75", "max")


# Grid and surface -------------------------------------------------------------------------------------


@query(f"WITH {ASSIGN_SQL} SELECT gbifID, q, r, cell_id FROM assigned")
def hex_assign(spark, sf_dir):
    return hexgrid.assign_cells(X.occurrences(spark, sf_dir), HEX).select("gbifID", "q", "r", "cell_id")


@query(f"WITH {GRID_SQL} SELECT * FROM grid")
def hex_grid(spark, sf_dir):
    return hexgrid.hex_grid(_area(spark, sf_dir), HEX)


def _surface(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Grid, selected points and cells with their counts."""
    grid = cut(hexgrid.hex_grid(_area(spark, sf_dir), HEX))
    points = cut(_in_area(spark, sf_dir))
    return grid, points, surface.aggregate_to_grid(grid, hexgrid.assign_cells(points, HEX))


def _cells(spark, sf_dir) -> DataFrame:
    return _surface(spark, sf_dir)[2]


@query(f"WITH {CELLS_SQL} SELECT * FROM cells")
def hex_aggregate(spark, sf_dir):
    return _cells(spark, sf_dir)


@query(
    f"WITH {CELLS_SQL} SELECT count(*) AS total_cells, count(CASE WHEN n_occurrences > 0 THEN 1 END) AS cells_with_occurrence, count(CASE WHEN n_occurrences = 0 THEN 1 END) AS empty_cells, {_pct('count(CASE WHEN n_occurrences > 0 THEN 1 END)', 'count(*)')} AS coverage_pct, "
    "min(n_occurrences) AS occurrences_min, max(n_occurrences) AS occurrences_max, round(avg(n_occurrences), 6) AS occurrences_mean, median(n_occurrences) * 1e0 AS occurrences_median, min(n_species) AS species_min, max(n_species) AS species_max, round(avg(n_species), 6) AS species_mean, median(n_species) * 1e0 AS species_median, "
    "(SELECT count(DISTINCT scientificName) FROM selected) AS total_species FROM cells"
)
def hex_summary(spark, sf_dir):
    _, points, cells = _surface(spark, sf_dir)
    return _rounded(surface.grid_summary(cells, points), 6, "occurrences_mean", "species_mean")


@query(f"WITH {CELLS_SQL} SELECT cell_id, n_occurrences, n_occurrences > 0 AS has_data, CASE WHEN n_occurrences > 0 THEN 1 ELSE 0 END AS presence FROM cells")
def coverage_flags(spark, sf_dir):
    return surface.coverage_flags(_cells(spark, sf_dir)).select("cell_id", "n_occurrences", "has_data", "presence")


@query(f"WITH {CELLS_SQL} SELECT count(CASE WHEN n_occurrences > 0 THEN 1 END) AS cells_with_data, count(CASE WHEN n_occurrences = 0 THEN 1 END) AS cells_without_data, min(CASE WHEN n_occurrences > 0 THEN n_occurrences END) AS min_nonzero, max(CASE WHEN n_occurrences > 0 THEN n_occurrences END) AS max_nonzero FROM cells")
def coverage_counts(spark, sf_dir):
    return surface.coverage_counts(_cells(spark, sf_dir))


@query(f"WITH {CELLS_SQL} SELECT cell_id, n_occurrences, round(ln(1e0 + n_occurrences), 9) AS log_n FROM cells WHERE n_occurrences > 0")
def log_density(spark, sf_dir):
    return _rounded(surface.log_density(_cells(spark, sf_dir)).select("cell_id", "n_occurrences", "log_n"), 9, "log_n")


@query(f"WITH {CELLS_SQL} SELECT cell_id, n_species FROM cells WHERE n_species > 0")
def richness_cells(spark, sf_dir):
    return surface.richness_cells(_cells(spark, sf_dir)).select("cell_id", "n_species")


@query(f"WITH {CELLS_SQL}, t AS (SELECT quantile_cont(n_occurrences, 0.95) AS threshold FROM cells WHERE n_occurrences > 0) SELECT cell_id, n_occurrences, threshold * 1e0 AS threshold FROM cells CROSS JOIN t WHERE n_occurrences > 0 AND n_occurrences >= threshold")
def hotspot_cells(spark, sf_dir):
    return surface.hotspot_cells(_cells(spark, sf_dir)).select("cell_id", "n_occurrences", "threshold")


def _histogram_sql(column: str, bins: int, nonzero: bool) -> str:
    return f"""WITH {CELLS_SQL}, x AS (SELECT {column} * 1e0 AS x FROM cells WHERE {column} {'>' if nonzero else '>='} 0), e0 AS (SELECT min(x) AS a, max(x) AS b FROM x),
e AS (SELECT lo, (hi - lo) / {bins}e0 AS w FROM (SELECT CASE WHEN a = b THEN a - 5e-1 ELSE a END AS lo, CASE WHEN a = b THEN b + 5e-1 ELSE b END AS hi FROM e0)),
k AS (SELECT x, lo, w, CAST(least(floor((x - lo) / w), {bins - 1}) AS BIGINT) AS k FROM x CROSS JOIN e),
c AS (SELECT CASE WHEN x < lo + k * w THEN k - 1 WHEN x >= lo + (k + 1) * w AND k < {bins - 1} THEN k + 1 ELSE k END AS bin, count(*) AS n FROM k GROUP BY 1)
SELECT i.bin, round(lo + i.bin * w, 6) AS lower, round(lo + (i.bin + 1) * w, 6) AS upper, coalesce(n, 0) AS n FROM e CROSS JOIN (SELECT unnest(range({bins})) AS bin) AS i LEFT JOIN c ON c.bin = i.bin"""


@query(_histogram_sql("n_occurrences", 50, False))
def occurrence_histogram(spark, sf_dir):
    return _rounded(surface.histogram(_cells(spark, sf_dir), "n_occurrences", 50), 6, "lower", "upper")


@query(_histogram_sql("n_occurrences", 30, True))
def occurrence_histogram_nonzero(spark, sf_dir):
    return _rounded(surface.histogram(_cells(spark, sf_dir), "n_occurrences", 30, nonzero=True), 6, "lower", "upper")


@query(_histogram_sql("n_species", 20, False))
def species_histogram(spark, sf_dir):
    return _rounded(surface.histogram(_cells(spark, sf_dir), "n_species", 20), 6, "lower", "upper")


@query(_histogram_sql("n_species", 10, True))
def species_histogram_nonzero(spark, sf_dir):
    return _rounded(surface.histogram(_cells(spark, sf_dir), "n_species", 10, nonzero=True), 6, "lower", "upper")


@query(f"WITH {GRID_SQL} SELECT * FROM grid ORDER BY md5('42:' || cell_id), cell_id LIMIT 50")
def grid_sample(spark, sf_dir):
    return surface.grid_sample(hexgrid.hex_grid(_area(spark, sf_dir), HEX), 50)


# Autocorrelation --------------------------------------------------------------------------------------


def _moran(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    cells = cut(autocorr.with_variables(_cells(spark, sf_dir)))
    return cells, cut(hexgrid.neighbours(cells))


@query(f"WITH {LINKS_SQL} SELECT cell_id, nbr_id, round(w, 9) AS w FROM links")
def queen_edges(spark, sf_dir):
    return _rounded(_moran(spark, sf_dir)[1], 9, "w")


@query(f"WITH {_lag_sql('log_n')} SELECT cell_id, round(z, 9) AS z, round(lag, 9) AS lag FROM lz")
def spatial_lag(spark, sf_dir):
    return _rounded(autocorr.spatial_lag(*_moran(spark, sf_dir), "log_n"), 9, "z", "lag")


def _moran_sql(variable: str) -> str:
    return f"WITH {_lag_sql(variable)} SELECT count(*) AS n, count(lag) AS s0, round(count(*) / (count(lag) * 1e0) * sum(z * lag) / sum(z * z), 9) AS \"I\", round(-1e0 / (count(*) - 1), 9) AS \"expected_I\" FROM lz"


@query(_moran_sql("presence"))
def morans_i_binary(spark, sf_dir):
    return _rounded(autocorr.morans_i(*_moran(spark, sf_dir), "presence"), 9, "I", "expected_I")


@query(_moran_sql("log_n"))
def morans_i_log(spark, sf_dir):
    return _rounded(autocorr.morans_i(*_moran(spark, sf_dir), "log_n"), 9, "I", "expected_I")


@query(
    f"WITH {_lag_sql('log_n')} SELECT cell_id, round((SELECT count(*) - 1 FROM lz) * z * coalesce(lag, 0) / (SELECT sum(z * z) FROM lz), 7) AS local_i, "
    "CASE WHEN z > 0 AND coalesce(lag, 0) > 0 THEN 1 WHEN z <= 0 AND coalesce(lag, 0) > 0 THEN 2 WHEN z <= 0 THEN 3 ELSE 4 END AS q FROM lz"
)
def local_morans_i(spark, sf_dir):
    return _rounded(autocorr.local_morans_i(*_moran(spark, sf_dir), "log_n").select("cell_id", "local_i", "q"), 7, "local_i")


def _lisa_sql(variable: str) -> str:
    return f"""WITH {_lag_sql(variable)}, deg AS (SELECT cell_id, count(*) AS d FROM links GROUP BY cell_id), ranked AS (
  SELECT k, cell_id, z, row_number() OVER (PARTITION BY k ORDER BY md5('42:' || k || ':' || cell_id), cell_id) AS nth FROM z CROSS JOIN (SELECT unnest(range(1, 1000)) AS k)
), few AS (SELECT * FROM ranked WHERE nth <= (SELECT max(d) + 1 FROM deg)), taken AS (
  SELECT o.cell_id, o.z, o.lag, d, f.k, f.z AS fz, row_number() OVER (PARTITION BY o.cell_id, f.k ORDER BY f.nth) AS m FROM lz AS o JOIN deg USING (cell_id) JOIN few AS f ON f.cell_id <> o.cell_id
), sim AS (SELECT cell_id, k, any_value(z) AS z, any_value(lag) AS lag, sum(fz) / any_value(d) AS drawn FROM taken WHERE m <= d GROUP BY cell_id, k),
larger AS (SELECT cell_id, count(CASE WHEN round(drawn * z, 9) >= round(lag * z, 9) THEN 1 END) AS n FROM sim GROUP BY cell_id),
tested AS (SELECT lz.cell_id, CASE WHEN n IS NULL THEN 1e0 ELSE (least(n, 999 - n) + 1) / 1000e0 END AS p_sim, CASE WHEN z > 0 AND coalesce(lag, 0) > 0 THEN 'HH' WHEN z <= 0 AND coalesce(lag, 0) > 0 THEN 'LH' WHEN z <= 0 THEN 'LL' ELSE 'HL' END AS q FROM lz LEFT JOIN larger ON lz.cell_id = larger.cell_id),
labelled AS (SELECT cell_id, p_sim, CASE WHEN p_sim >= 0.05 THEN 'Not significant' ELSE q END AS cluster FROM tested)"""


_COUNTS = "SELECT t.cluster, count(l.cell_id) AS n FROM (VALUES ('HH'), ('LH'), ('LL'), ('HL'), ('Not significant')) AS t(cluster) LEFT JOIN labelled AS l ON l.cluster = t.cluster GROUP BY t.cluster"


@query(f"{_lisa_sql('log_n')} {_COUNTS}")
def lisa_clusters(spark, sf_dir):
    return autocorr.cluster_counts(autocorr.lisa(*_moran(spark, sf_dir), "log_n"))


@query(f"{_lisa_sql('presence')} {_COUNTS}")
def lisa_clusters_presence(spark, sf_dir):
    return autocorr.cluster_counts(autocorr.lisa(*_moran(spark, sf_dir), "presence"))


@query(f"{_lisa_sql('log_n')} SELECT cell_id, p_sim, cluster FROM labelled")
def lisa_cells(spark, sf_dir):
    return autocorr.lisa(*_moran(spark, sf_dir), "log_n").select("cell_id", "p_sim", "cluster")


def _permutation_sql(variable: str) -> str:
    return f"""WITH {_lag_sql(variable)}, base AS (SELECT z, row_number() OVER (ORDER BY cell_id) AS place FROM z), ranked AS (
  SELECT k, cell_id, row_number() OVER (PARTITION BY k ORDER BY md5('42:' || k || ':' || cell_id), cell_id) AS place FROM z CROSS JOIN (SELECT unnest(range(1, 1000)) AS k)
), drawn AS (SELECT k, cell_id, z FROM ranked JOIN base USING (place)), c AS (SELECT count(*) AS n, sum(z * z) AS den, (SELECT count(DISTINCT cell_id) FROM links) AS s0 FROM z),
sim AS (SELECT a.k, sum(w * a.z * b.z) * any_value(n) / any_value(s0) / any_value(den) AS i FROM links AS l JOIN drawn AS a ON a.cell_id = l.cell_id JOIN drawn AS b ON b.cell_id = l.nbr_id AND b.k = a.k CROSS JOIN c GROUP BY a.k),
o AS (SELECT count(*) / (count(lag) * 1e0) * sum(z * lag) / sum(z * z) AS i, -1e0 / (count(*) - 1) AS e FROM lz),
r AS (SELECT o.i, o.e, count(CASE WHEN round(sim.i, 9) >= round(o.i, 9) THEN 1 END) AS larger, avg(sim.i) AS mean, stddev_pop(sim.i) AS std FROM sim CROSS JOIN o GROUP BY o.i, o.e), t AS (SELECT *, (least(larger, 999 - larger) + 1) / 1000e0 AS p_sim FROM r)
SELECT round(i, 9) AS "I", round(e, 9) AS "expected_I", p_sim, round((i - mean) / std, 6) AS z_sim,
  '{variable}: ' || CASE WHEN p_sim < 0.05 AND i > 0 THEN 'Positive spatial autocorrelation (clustering)' WHEN p_sim < 0.05 AND i < 0 THEN 'Negative spatial autocorrelation (dispersion)' ELSE 'No significant spatial autocorrelation' END AS interpretation FROM t"""


def _permutation(spark, sf_dir, variable: str) -> DataFrame:
    return _rounded(_rounded(autocorr.morans_permutation(*_moran(spark, sf_dir), variable), 9, "I", "expected_I"), 6, "z_sim")


@query(_permutation_sql("presence"))
def morans_permutation(spark, sf_dir):
    return _permutation(spark, sf_dir, "presence")


@query(_permutation_sql("log_n"))
def morans_permutation_log(spark, sf_dir):
    return _permutation(spark, sf_dir, "log_n")


# Validation -------------------------------------------------------------------------------------------


@query(
    f"WITH {RAW_SQL}, t AS (SELECT {', '.join(f'{_num(c)} AS {c}' for c in ('gbifID', 'taxonKey', 'decimalLatitude', 'decimalLongitude', 'year', 'month'))} FROM raw) SELECT count(CASE WHEN gbifID IS NULL THEN 1 END) AS gbifid_null, count(*) - count(DISTINCT gbifID) - coalesce(max(CASE WHEN gbifID IS NULL THEN 1 END), 0) AS gbifid_duplicate, "
    "count(CASE WHEN decimalLatitude IS NULL OR decimalLongitude IS NULL THEN 1 END) AS coordinates_null, count(CASE WHEN decimalLatitude NOT BETWEEN -90 AND 90 THEN 1 END) AS latitude_out_of_range, count(CASE WHEN decimalLongitude NOT BETWEEN -180 AND 180 THEN 1 END) AS longitude_out_of_range, "
    "count(CASE WHEN gbifID <> floor(gbifID) OR taxonKey <> floor(taxonKey) OR year <> floor(year) OR month <> floor(month) THEN 1 END) AS not_whole FROM t"
)
def integrity_checks(spark, sf_dir):
    return clean.integrity_counts(clean.coerce_numbers(X.raw(spark, sf_dir)))


@query(f"WITH {JOINED_SQL} SELECT gbifID FROM occ WHERE gbifID NOT IN (SELECT gbifID FROM pair)")
def lost_points(spark, sf_dir):
    points = X.occurrences(spark, sf_dir)
    return validate.lost_points(points, spatial.containing_pairs(points, X.sites(spark, sf_dir))).select("gbifID")


@query(
    f"WITH {CELLS_SQL} SELECT count(*) AS n_points, count(CASE WHEN a THEN 1 END) AS n_in_area, count(CASE WHEN g THEN 1 END) AS n_in_grid, count(CASE WHEN NOT a THEN 1 END) AS missing_area, count(CASE WHEN NOT g THEN 1 END) AS missing_grid "
    "FROM (SELECT gbifID IN (SELECT gbifID FROM selected) AS a, cell_id IN (SELECT cell_id FROM grid) AS g FROM assigned)"
)
def lost_point_counts(spark, sf_dir):
    area = _area(spark, sf_dir)
    return validate.lost_point_counts(X.occurrences(spark, sf_dir), area, hexgrid.hex_grid(area, HEX), HEX)


@query(f"WITH {JOINED_SQL} SELECT MS, count(*) AS occurrences FROM joined WHERE MS IS NOT NULL GROUP BY MS ORDER BY occurrences DESC, MS LIMIT 15")
def top_member_states(spark, sf_dir):
    return summaries.top_groups(_joined(spark, sf_dir), "MS", 15)


@query(f"WITH {CLASS_SQL} SELECT baseline_within, count(*) AS n_occurrences, {_pct('count(*)', '(SELECT count(*) FROM classified)')} AS percentage FROM classified GROUP BY baseline_within")
def baseline_within_distribution(spark, sf_dir):
    return summaries.distribution(_classified(spark, sf_dir), "baseline_within", "baseline_within")


@query(f"WITH {CLASS_SQL} SELECT (SELECT count(*) FROM joined) AS n_a, (SELECT count(*) FROM classified) AS n_b, (SELECT count(*) FROM joined) = (SELECT count(*) FROM classified) AS same")
def joined_row_parity(spark, sf_dir):
    joined = cut(_joined(spark, sf_dir))
    return validate.same_rows(joined, uncertainty.classify(joined, X.sites(spark, sf_dir)))


def _validation_sql() -> str:
    yes = lambda name, cond, details, source="cells": f"SELECT '{name}' AS check_name, {cond} AS passed, {details} AS details FROM {source}"
    text = lambda x: f"CAST({x} AS STRING)"
    parts = [yes(f"{n} non-empty", "count(*) > 0", "'n=' || " + text("count(*)"), t) for n, t in (("Occurrences", "selected"), ("Study area", "area"), ("Grid", "grid"), ("Aggregated grid", "cells"))]
    parts += [f"SELECT '{n} CRS', true, 'EPSG:4326'" for n in ("Occurrences", "Study area", "Grid", "Aggregated grid")]
    parts += [f"SELECT '{n}', true, '{c} present'" for n, c in (("Grid has cell_id", "cell_id"), ("Aggregated grid has cell_id", "cell_id"), ("Aggregated grid has n_occurrences", "n_occurrences"), ("Aggregated grid has n_species", "n_species"))]
    n = "(SELECT count(DISTINCT gbifID) FROM selected)"
    in_grid = "(SELECT count(DISTINCT gbifID) FROM selected WHERE cell_id IN (SELECT cell_id FROM grid))"
    parts += [f"SELECT 'All selected occurrences intersect study area', true, {text(n)} || '/' || {text(n)}", f"SELECT 'All selected occurrences intersect grid', {in_grid} = {n}, {text(in_grid)} || '/' || {text(n)}"]
    parts += [yes(f"{name} cell_id unique", "count(*) = count(DISTINCT cell_id)", "'unique=' || CASE WHEN count(*) = count(DISTINCT cell_id) THEN 'True' ELSE 'False' END", t) for name, t in (("Grid", "grid"), ("Aggregated grid", "cells"))]
    parts += [yes("n_occurrences non-negative", "bool_and(n_occurrences >= 0)", "'all values >= 0'"), yes("n_species non-negative", "bool_and(n_species >= 0)", "'all values >= 0'"), yes("n_species <= n_occurrences for all cells", "bool_and(n_species <= n_occurrences)", "'checked all cells'")]
    total = "(SELECT count(*) FROM selected)"
    parts += [yes("Total aggregated occurrences equals selected occurrences", f"sum(n_occurrences) = {total}", f"{text('CAST(sum(n_occurrences) AS BIGINT)')} || '/' || {text(total)}")]
    a, z = "count(CASE WHEN n_occurrences > 0 THEN 1 END)", "count(CASE WHEN n_occurrences = 0 THEN 1 END)"
    parts += [yes("Active + zero cells equals total cells", f"{a} + {z} = count(*)", f"{text(a)} || ' + ' || {text(z)} || ' = ' || {text('count(*)')}")]
    parts += [f"SELECT 'No gbifID lost in point-to-grid assignment', {n} = {in_grid}, 'missing=' || {text(f'{n} - {in_grid}')}"]
    return f"WITH {CELLS_SQL} " + " UNION ALL ".join(parts)


def _validation(spark, sf_dir) -> DataFrame:
    grid, points, cells = _surface(spark, sf_dir)
    return validate.pipeline_validation(points, _area(spark, sf_dir), grid, cells, HEX)


@query(_validation_sql())
def pipeline_validation(spark, sf_dir):
    return _validation(spark, sf_dir).drop("ord")


@query(f"SELECT count(CASE WHEN passed THEN 1 END) AS n_pass, count(CASE WHEN NOT passed THEN 1 END) AS n_fail FROM ({_validation_sql()})")
def validation_tally(spark, sf_dir):
    return validate.validation_tally(_validation(spark, sf_dir))


@query(f"WITH {CLASS_SQL} SELECT count(*) AS n_rows, count(SITECODE) AS n_inside, count(*) - count(SITECODE) AS n_outside, {_pct('count(SITECODE)', 'count(*)')} AS pct_inside, count(CASE WHEN gbifID IS NULL THEN 1 END) AS null_ids, count(*) - count(DISTINCT gbifID) AS duplicate_ids, count(uncertainty_class) AS n_classified FROM classified")
def joined_inspection(spark, sf_dir):
    return validate.joined_inspection(_classified(spark, sf_dir))


@query(f"WITH {METRIC_SQL}, a AS (SELECT index_right, abs(sum(x1 * y2 - x2 * y1)) / 2e6 AS area_km2 FROM medge GROUP BY index_right) SELECT SITECODE, SITENAME, MS, SITETYPE, round(area_km2, 3) AS area_km2 FROM a JOIN site AS s ON a.index_right = s.index_right ORDER BY a.area_km2 DESC, SITECODE LIMIT 10")
def site_area_top10(spark, sf_dir):
    return _rounded(sites.largest_sites(X.sites(spark, sf_dir)), 3, "area_km2")


@query(f"WITH {SITE_SQL} SELECT count(*) AS n_sites, 0 AS n_missing, 0 AS n_empty, 0 AS n_short_rings, 0 AS n_open_rings, 0 AS n_multi_ring, 0 AS n_invalid, count(*) - count(DISTINCT SITECODE) AS n_duplicate_codes, min(cx - r) AS min_lon, min(cy - r) AS min_lat, max(cx + r) AS max_lon, max(cy + r) AS max_lat FROM site")
def site_health(spark, sf_dir):
    return sites.site_health(X.sites(spark, sf_dir))


# Rows without ids of their own, and sites of parts and holes ------------------------------------------

PARTS_SQL = f"""occ AS ({X.ODD_OCC}), site AS ({X.SITE}), ring AS ({X.RINGS}), edge AS (
  SELECT index_right, ring, cx + r AS x1, cy AS y1, cx AS x2, cy + r AS y2 FROM ring UNION ALL SELECT index_right, ring, cx, cy + r, cx - r, cy FROM ring
  UNION ALL SELECT index_right, ring, cx - r, cy, cx, cy - r FROM ring UNION ALL SELECT index_right, ring, cx, cy - r, cx + r, cy FROM ring
), box AS (SELECT index_right, min(x1) AS lx, max(x1) AS hx, min(y1) AS ly, max(y1) AS hy FROM edge GROUP BY index_right), hits AS (
  SELECT o.k, b.index_right, sum(CASE WHEN {_CROSS.format(**_OF_POINT)} THEN 1 ELSE 0 END) % 2 = 1 AS odd, max(CASE WHEN {_ON.format(**_OF_POINT)} THEN 1 ELSE 0 END) = 1 AS on_edge
  FROM occ AS o JOIN box AS b ON o.decimalLongitude BETWEEN lx AND hx AND o.decimalLatitude BETWEEN ly AND hy JOIN edge AS e ON e.index_right = b.index_right GROUP BY o.k, b.index_right
), pair AS (SELECT k, index_right FROM hits WHERE odd AND NOT on_edge), joined AS (
  SELECT o.*, p.index_right, s.SITECODE FROM occ AS o LEFT JOIN pair AS p ON o.k = p.k LEFT JOIN site AS s ON p.index_right = s.index_right
), vertex AS (SELECT index_right, ring, k, vx, vy FROM (
  SELECT index_right, ring, 0 AS k, cx + r AS vx, cy AS vy FROM ring UNION ALL SELECT index_right, ring, 1, cx, cy + r FROM ring UNION ALL SELECT index_right, ring, 2, cx - r, cy FROM ring UNION ALL SELECT index_right, ring, 3, cx, cy - r FROM ring)
), mvertex AS ({_laea_sql("vx", "vy", "vertex", "index_right, ring, k")}), medge AS (
  SELECT a.index_right, a.ring, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM mvertex AS a JOIN mvertex AS b ON a.index_right = b.index_right AND a.ring = b.ring AND b.k = (a.k + 1) % 4
), mocc AS ({_laea_sql("decimalLongitude", "decimalLatitude", "(SELECT * FROM occ WHERE decimalLongitude IS NOT NULL)", "k")})"""
PART_AREA_SQL = "part_area AS (SELECT index_right, sum(CASE WHEN ring = 1 THEN -a ELSE a END) / 1e6 AS area_km2 FROM (SELECT index_right, ring, abs(sum(x1 * y2 - x2 * y1)) / 2 AS a FROM medge GROUP BY index_right, ring) GROUP BY index_right)"


def _odd_joined(spark, sf_dir) -> DataFrame:
    return spatial.join_sites(X.odd_occurrences(spark, sf_dir), X.part_sites(spark, sf_dir))


@query(f"WITH {PARTS_SQL} SELECT gbifID, scientificName, index_right, SITECODE FROM joined")
def rowwise_pip_join(spark, sf_dir):
    return _odd_joined(spark, sf_dir).select("gbifID", "scientificName", "index_right", "SITECODE")


@query(
    f"""WITH {PARTS_SQL}, din AS (SELECT p.k, p.index_right, min({_DIST}) AS d FROM pair AS p JOIN mocc AS m ON p.k = m.k JOIN medge AS e ON p.index_right = e.index_right GROUP BY p.k, p.index_right), mout AS (
  SELECT * FROM mocc WHERE k NOT IN (SELECT k FROM pair)
), crossed AS (
  SELECT m.k, e.index_right, min({_DIST}) AS d, sum(CASE WHEN {_CROSS.format(x="x", y="y")} THEN 1 ELSE 0 END) % 2 = 1 AS odd FROM mout AS m CROSS JOIN medge AS e GROUP BY m.k, e.index_right
), dout AS (SELECT k, min(CASE WHEN odd THEN 0e0 ELSE d END) AS d FROM crossed GROUP BY k), c AS (
  SELECT j.*, i.d AS bd, CASE WHEN j.index_right IS NULL THEN o.d END AS pd, coordinateUncertaintyInMeters AS u FROM joined AS j LEFT JOIN din AS i ON j.k = i.k AND j.index_right = i.index_right LEFT JOIN dout AS o ON j.k = o.k
) SELECT gbifID, index_right, round(bd, 3) AS dist_to_boundary_m, round(pd, 3) AS dist_to_polygon_m, CASE WHEN index_right IS NOT NULL AND bd > u THEN '{CERTAINLY_INSIDE}' WHEN index_right IS NOT NULL AND bd <= u THEN '{INSIDE_UNCERTAIN}'
  WHEN index_right IS NULL AND pd <= u THEN '{OUTSIDE_UNCERTAIN}' WHEN index_right IS NULL AND pd > u THEN '{CERTAINLY_OUTSIDE}' ELSE '{UNCLASSIFIED}' END AS uncertainty_class FROM c"""
)
def rowwise_uncertainty_class(spark, sf_dir):
    out = uncertainty.classify_points(X.odd_occurrences(spark, sf_dir), X.part_sites(spark, sf_dir))
    out = out.select("gbifID", "index_right", "dist_to_boundary_m", "dist_to_polygon_m", "uncertainty_class")
    return out.withColumns({c: rounded(F.col(c), 3) for c in ("dist_to_boundary_m", "dist_to_polygon_m")})


@query(f"WITH {PARTS_SQL}, area AS (SELECT index_right FROM site WHERE MS IN ({', '.join(f'{chr(39)}{m}{chr(39)}' for m in AREA_MS)})), aedge AS (SELECT e.* FROM medge AS e JOIN area AS a ON e.index_right = a.index_right){GRID_SQL[GRID_SQL.index(', box AS (') :].replace('box AS (', 'around AS (').replace('FROM box)', 'FROM around)')} SELECT * FROM grid")
def multipart_hex_grid(spark, sf_dir):
    return hexgrid.hex_grid(X.part_sites(spark, sf_dir).filter(F.col("MS").isin(*AREA_MS)), HEX)


@query(f"WITH {PARTS_SQL}, {PART_AREA_SQL} SELECT SITECODE, round(area_km2, 3) AS area_km2 FROM part_area AS a JOIN site AS s ON a.index_right = s.index_right")
def multipart_site_area(spark, sf_dir):
    return _rounded(sites.site_areas(X.part_sites(spark, sf_dir)).select("SITECODE", "area_km2"), 3, "area_km2")


@query(
    f"WITH {PARTS_SQL}, {PART_AREA_SQL} SELECT count(*) AS count, round(avg(area_km2), 3) AS mean, round(stddev_samp(area_km2), 3) AS std, round(min(area_km2), 3) AS min, "
    "round(quantile_cont(area_km2, 0.25), 3) AS q25, round(quantile_cont(area_km2, 0.5), 3) AS q50, round(quantile_cont(area_km2, 0.75), 3) AS q75, round(max(area_km2), 3) AS max FROM part_area"
)
def site_area_statistics(spark, sf_dir):
    return _rounded(sites.area_statistics(X.part_sites(spark, sf_dir)), 3, "mean", "std", "min", "q25", "q50", "q75", "max")


def _all_shapes(spark, sf_dir) -> DataFrame:
    """The sites of one part, those of several, and some whose rings cross themselves or are not closed."""
    shapes = X.part_sites(spark, sf_dir).select("SITECODE", "rings").unionByName(X.sites(spark, sf_dir).select(F.concat(F.lit("T"), "SITECODE").alias("SITECODE"), "rings"))
    ring = F.get("rings", F.lit(0))
    crossed = F.array(F.concat(F.slice(ring, 1, 1), F.slice(ring, 3, 1), F.slice(ring, 2, 1), F.slice(ring, 4, 2)))
    bad = F.when(F.col("SITECODE").endswith("3"), crossed).when(F.col("SITECODE").endswith("7"), F.array(F.slice(ring, 1, 4))).when(F.col("SITECODE").endswith("9"), F.lit(None)).otherwise(F.col("rings"))
    return shapes.withColumn("rings", bad)


_KINDS = "CASE WHEN code LIKE '%9' THEN NULL WHEN code LIKE '%3' THEN 'crossed' WHEN code LIKE '%7' THEN 'open' WHEN many THEN 'many' ELSE 'one' END AS kind FROM (SELECT SITECODE AS code, true AS many, * FROM site UNION ALL SELECT 'T' || SITECODE, false, * FROM site)"


@query(f"WITH site AS ({X.SITE}), k AS (SELECT {_KINDS}) SELECT CASE WHEN kind = 'many' THEN 'MULTIPOLYGON' WHEN kind IS NOT NULL THEN 'POLYGON' END AS geometry_type, count(*) AS n FROM k GROUP BY 1")
def geometry_types(spark, sf_dir):
    return sites.geometry_types(_all_shapes(spark, sf_dir))


@query(
    f"WITH site AS ({X.SITE}), k AS (SELECT cx, cy, r, {_KINDS}) SELECT count(*) AS n_sites, count(*) - count(kind) AS n_missing, 0 AS n_empty, 0 AS n_short_rings, count(CASE WHEN kind = 'open' THEN 1 END) AS n_open_rings, count(CASE WHEN kind = 'many' THEN 1 END) AS n_multi_ring, "
    "count(CASE WHEN kind IN ('open', 'crossed') THEN 1 END) AS n_invalid, 0 AS n_duplicate_codes, min(CASE WHEN kind IS NOT NULL THEN cx - r END) AS min_lon, min(CASE WHEN kind IS NOT NULL THEN cy - r END) AS min_lat, "
    "max(CASE WHEN kind = 'many' THEN greatest(cx + r, cx + 2.5e0 * r + r * 0.5e0) WHEN kind IS NOT NULL THEN cx + r END) AS max_lon, max(CASE WHEN kind = 'many' THEN cy + 1e0 * r + 0.3e0 + (r * 0e0 + 0.05e0) WHEN kind IS NOT NULL THEN cy + r END) AS max_lat FROM k"
)
def site_health_of_bad_shapes(spark, sf_dir):
    return sites.site_health(_all_shapes(spark, sf_dir))


# Sources and sinks: tables are written by a sink and read back by a source --------------------------------


def _place(spark: SparkSession, name: str) -> str:
    """A path for one file in the shared folder, which must be one of the driver's own file system."""
    folder = scratch(spark, "files").removeprefix("file://")
    os.makedirs(folder)
    return f"{folder}/{name}"


@query(f"WITH s AS ({X.SPECIES}), k AS (SELECT coalesce({_num('acceptedUsageKey')}, {_num('usageKey')}) AS v FROM s) SELECT DISTINCT CAST(v AS BIGINT) AS taxonKey FROM k WHERE v IS NOT NULL")
def source_species_list(spark, sf_dir):
    names = [c.split()[0].strip("`") for c in files.SPECIES_LIST.split(", ")]
    species = X.species(spark, sf_dir)
    whole = species.select(*(F.col(c) if c in species.columns else F.lit('a "b", c').alias(c) for c in names))
    path = scratch(spark, "species")
    whole.write.option("header", True).option("escape", '"').csv(path)
    return clean.taxon_keys(files.read_species_list(spark, path))


@query(f"WITH {RAW_SQL} SELECT {', '.join(RAW_COLUMNS)} FROM raw")
def source_archive(spark, sf_dir):
    path = _place(spark, "archive.zip")
    files.export_zip_csv(X.raw(spark, sf_dir), path, "occurrence.txt", "\t")
    return files.read_archive(spark, path)


@query(f"WITH {CLEAN_SQL} SELECT * FROM clean")
def source_zip_table(spark, sf_dir):
    path = _place(spark, "clean.zip")
    files.export_zip_csv(_clean(spark, sf_dir), path)
    return clean.canonical(clean.coerce_numbers(files.read_zip(spark, path)))


@query(f"WITH {PARTS_SQL}, {PART_AREA_SQL} SELECT a.index_right, SITECODE, MS, 'MULTIPOLYGON' AS geometry_type, 4326 AS srid, 4 AS n_rings, round(area_km2, 3) AS area_km2 FROM part_area AS a JOIN site AS s ON a.index_right = s.index_right")
def source_named_layer(spark, sf_dir):
    path = _place(spark, "sites.gpkg")
    geopackage.write_layer(X.odd_occurrences(spark, sf_dir).limit(5), path, "points", geometry=("decimalLongitude", "decimalLatitude"))
    geopackage.write_layer(X.part_sites(spark, sf_dir).select("SITECODE", "SITENAME", "MS", "SITETYPE", F.col("index_right").alias("site"), "rings", "ring_parts").orderBy("index_right"), path, "sites")
    layer = geopackage.read_layer(spark, path, "sites")
    areas = sites.site_areas(sites.prepare_sites(layer)).select("index_right", "area_km2")
    out = layer.join(areas, "index_right").select(F.col("site").alias("index_right"), "SITECODE", "MS", "geometry_type", "srid", F.size("rings").alias("n_rings"), "area_km2")
    return _rounded(out, 3, "area_km2")


@query(f"WITH occ AS ({X.OCC}), o AS (SELECT *, row_number() OVER (ORDER BY gbifID) - 1 AS nth FROM occ) SELECT nth AS index_right, gbifID, scientificName, year, 'POINT' AS geometry_type, decimalLongitude AS x, decimalLatitude AS y FROM o")
def source_default_layer(spark, sf_dir):
    path = _place(spark, "points.gpkg")
    geopackage.write_layer(X.occurrences(spark, sf_dir).orderBy("gbifID"), path, "occurrences", geometry=("decimalLongitude", "decimalLatitude"))
    place = F.get(F.get("rings", F.lit(0)), F.lit(0))
    return geopackage.read_layer(spark, path).select("index_right", "gbifID", "scientificName", "year", "geometry_type", place["x"].alias("x"), place["y"].alias("y"))


@query(_summary_sql("countryCode"))
def sink_csv_table(spark, sf_dir):
    path = scratch(spark, "table")
    files.write_csv(country_summary(spark, sf_dir), path)
    return spark.read.csv(path, header=True, schema="countryCode string, occurrences long")


@query(f"WITH {CLEAN_SQL} " + " UNION ALL ".join(f"SELECT '{c}' AS counter, CAST({c} AS STRING) AS value, count(*) AS n FROM clean WHERE {c} IS NOT NULL GROUP BY {c}" for c in summaries.COUNTERS))
def streamed_counts(spark, sf_dir):
    """The counters of the filter report, from a stream over files of raw records."""
    inbox, store = scratch(spark, "inbox"), scratch(spark, "store")
    X.raw(spark, sf_dir).write.option("sep", "\t").option("header", True).option("quote", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(inbox)
    stream_counters(spark, inbox, store, scratch(spark, "progress")).awaitTermination()
    return stored_counters(spark, store)


@query(f"WITH occ AS ({X.OCC}) SELECT gbifID, 3035 AS srid, round(decimalLongitude, 6) AS lon, round(decimalLatitude, 6) AS lat FROM occ UNION ALL SELECT gbifID, 3857, round(decimalLongitude, 6), round(decimalLatitude, 6) FROM occ")
def degrees_of_projected_places(spark, sf_dir):
    """Places projected and brought back to degrees, as layers in other reference systems are."""
    occ, out = X.occurrences(spark, sf_dir), None
    for srid, there in ((3035, laea), (3857, mercator)):
        m = occ.select("gbifID", F.lit(srid).alias("srid"), there(F.col(_LON), F.col(_LAT)).alias("m"))
        d = m.select("gbifID", "srid", to_degrees(F.col("m.x"), F.col("m.y"), srid).alias("d"))
        rows = d.select("gbifID", "srid", F.round("d.x", 6).alias("lon"), F.round("d.y", 6).alias("lat"))
        out = rows if out is None else out.unionByName(rows)
    return out


# Reports as lines of text; blank lines and underlines, which repeat, are counted ---------------------------


def _lines(spark, text: str) -> DataFrame:
    rows = spark.createDataFrame([(x,) for x in text.rstrip("\n").split("\n")], "line string")
    return rows.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


def _lines_sql(source: str, title: str, parts: list[str]) -> str:
    """``parts`` give (heading, line); a heading is underlined and has a blank line before it."""
    every = " UNION ALL ".join(parts)
    return f"""{source}, said AS ({every}), heads AS (SELECT DISTINCT heading FROM said WHERE heading <> ''), all_lines AS (
  SELECT line FROM said WHERE line IS NOT NULL UNION ALL SELECT heading FROM heads UNION ALL SELECT repeat('-', length(heading)) FROM heads UNION ALL SELECT '' FROM heads UNION ALL SELECT '{title}' UNION ALL SELECT repeat('=', length('{title}'))
) SELECT line, count(*) AS n FROM all_lines GROUP BY line"""


def _filter_text_sql() -> str:
    share = "printf('%.2f', 100e0 * count(*) / (SELECT count(*) FROM clean))"
    by = lambda heading, key, tail="": f"SELECT '{heading}' AS heading, CAST({key} AS STRING) || ': ' || count(*) || ' (' || {share} || '%)' AS line FROM clean WHERE {key} IS NOT NULL GROUP BY {key}{tail}"
    one = lambda text: f"SELECT 'Totals' AS heading, {text} AS line FROM clean"
    parts = ["SELECT 'Settings' AS heading, 'max_uncertainty: 1000' AS line", "SELECT 'Totals' AS heading, 'Raw records: ' || count(*) AS line FROM raw"]
    parts += [one(f"'Filtered records: ' || count(*) || ' (' || printf('%.2f', {_pct('count(*)', '(SELECT count(*) FROM raw)')}) || '%)'"), one("'Distinct names: ' || count(DISTINCT scientificName)"), one("'Distinct taxon keys: ' || count(DISTINCT taxonKey)"), one("'Years: ' || min(year) || '-' || max(year)")]
    parts += [one("'Latitude: ' || printf('%.4f', min(decimalLatitude)) || ' to ' || printf('%.4f', max(decimalLatitude))"), one("'Longitude: ' || printf('%.4f', min(decimalLongitude)) || ' to ' || printf('%.4f', max(decimalLongitude))"), one("'Countries: ' || count(DISTINCT countryCode)")]
    parts += [by("Basis of record", "basisOfRecord"), f"SELECT * FROM ({by('Top 10 names', 'scientificName', ' ORDER BY count(*) DESC, scientificName LIMIT 10')})", by("Records per country", "countryCode"), by("Records per year", "year"), by("All names", "scientificName")]
    return _lines_sql(f"WITH {CLEAN_SQL}", "TEST: filtering summary", parts)


@query(_filter_text_sql())
def report_of_filter(spark, sf_dir):
    raw = X.raw(spark, sf_dir)
    return _lines(spark, report.filter_text(raw.count(), clean.filter_occurrences(raw), "TEST", {"max_uncertainty": 1000}))


def _profile_text_sql() -> str:
    parts = [
        "SELECT logical_type AS heading, \"column\" || ' (' || role || ', ' || dtype || ')' AS line FROM p",
        "SELECT logical_type, '  non-null ' || non_null || ', missing ' || missing || ' (' || printf('%.2f', missing_pct) || '%), distinct ' || unique_values || ', flags ' || warning_flags FROM p",
        "SELECT logical_type, '  min ' || CAST(CAST(numeric_min AS DOUBLE) AS STRING) || ', max ' || CAST(CAST(numeric_max AS DOUBLE) AS STRING) || ', mean ' || CAST(CAST(numeric_mean AS DOUBLE) AS STRING) || ', median ' || CAST(CAST(numeric_median AS DOUBLE) AS STRING) FROM p WHERE numeric_min IS NOT NULL",
        "SELECT logical_type, '  dates ' || date_like_valid_values || ' (' || printf('%.2f', date_like_valid_pct) || '%)' FROM p WHERE date_like_valid_values IS NOT NULL",
    ]
    return _lines_sql(_profile_sql().rpartition(" SELECT")[0], "TEST: schema summary", parts)


@query(_profile_text_sql())
def report_of_profile(spark, sf_dir):
    return _lines(spark, report.profile_text(schema_profile(spark, sf_dir), "TEST"))


def _readiness_text_sql() -> str:
    title = "array_to_string(list_transform(string_split(section, '_'), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
    parts = [
        f"SELECT {title} AS heading, replace(metric, '_', ' ') || ': ' || value || CASE WHEN status IN ('WARNING', 'FAIL') THEN ' [' || status || ']' ELSE '' END AS line FROM whole",
        f"SELECT {title}, '  ' || notes FROM whole WHERE notes <> ''",
        "SELECT 'Reading the report', 'PASS: no issue. WARNING: review before use. FAIL: joins to sites would be wrong or impossible.'",
    ]
    source, _, tail = _full_readiness_sql().rpartition("\nSELECT ord")
    return _lines_sql(f"{source}, whole AS (SELECT ord{tail})", "TEST: spatial readiness", parts)


@query(_readiness_text_sql())
def report_of_readiness(spark, sf_dir):
    return _lines(spark, report.readiness_text(_report(spark, sf_dir), "TEST"))


@query(_lines_sql(f"WITH {CELLS_SQL}, cov AS (SELECT count(CASE WHEN n_occurrences > 0 THEN 1 END) AS a, count(CASE WHEN n_occurrences = 0 THEN 1 END) AS b FROM cells)", "TEST: surface", ["SELECT 'Coverage' AS heading, 'cells_with_data: ' || a AS line FROM cov", "SELECT 'Coverage', 'cells_without_data: ' || b FROM cov", "SELECT 'Cells', 'cell_id=' || cell_id || ', n_occurrences=' || n_occurrences FROM cells"]))
def report_of_tables(spark, sf_dir):
    cells = cut(_cells(spark, sf_dir))
    coverage = surface.coverage_counts(cells).select("cells_with_data", "cells_without_data")
    return _lines(spark, report.table_text("TEST: surface", ("Coverage", coverage), ("Cells", cells.select("cell_id", "n_occurrences"))))


@query(f"WITH site AS ({X.SITE}) SELECT SITECODE, SITENAME, MS, SITETYPE FROM site WHERE SITENAME IS NOT NULL ORDER BY index_right LIMIT 10")
def site_preview(spark, sf_dir):
    """The first sites of a layer, as they stand in it."""
    return X.sites(spark, sf_dir).filter("SITENAME is not null").orderBy("index_right").limit(10).select("SITECODE", "SITENAME", "MS", "SITETYPE")


@query(
    f"""WITH {CELLS_SQL}, placed AS (SELECT *, {HEX * _W3!r}e0 * (q + r / 2e0) AS cx, {HEX * 1.5!r}e0 * r AS cy FROM cells), ends AS (SELECT min(cx) - {HEX!r}e0 AS x0, max(cy) + {HEX!r}e0 AS y1, (max(cx) - min(cx) + 2 * {HEX!r}e0) / 90e0 AS step, max(cy) - min(cy) + 2 * {HEX!r}e0 AS tall FROM placed),
pixel AS (SELECT px, py, x0 + (px + 0.5e0) * step AS x, y1 - (py + 0.5e0) * step AS y FROM (SELECT *, unnest(range(90)) AS px FROM (SELECT *, unnest(range(CAST(ceil(tall / step) AS BIGINT))) AS py FROM ends))), at AS ({_AXIAL.format(source='pixel')})
SELECT px, py, c.q, c.r, n_occurrences AS value FROM at AS p JOIN cells AS c ON CAST(p.cq AS BIGINT) = c.q AND CAST(p.cr AS BIGINT) = c.r""".replace(", at AS (", ", found AS (").replace("FROM at AS p", "FROM found AS p")
)
def figure_raster(spark, sf_dir):
    """The pixels of the density map."""
    return figures.raster(cut(_cells(spark, sf_dir)), HEX, "n_occurrences", 90)
