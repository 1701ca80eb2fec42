"""The spatial readiness report: one aggregation over the table, turned into report rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import status, to_number
from ..plans.quantiles import column_quantiles, quantile
from ..plans.shared import cut
from ..schemas import EUROPE

LON, LAT, UNC, ID = "decimalLongitude", "decimalLatitude", "coordinateUncertaintyInMeters", "gbifID"
REQUIRED = [ID, LON, LAT, UNC]
OPTIONAL = ["taxonKey", "scientificName", "countryCode", "year"]

# The verdicts.
CRITICAL = "Critical required columns are missing. Downstream spatial processing should not proceed."
FAILED = "One or more critical spatial readiness checks failed."
WARNED = "Dataset passed core spatial readiness checks, but one or more warnings should be reviewed."
PASSED = "Dataset passed spatial readiness validation."


def top_values(df: DataFrame, zero: str, other: str, k: int = 5) -> DataFrame:
    """(value, n): the ``k`` commonest values of ``other`` among records whose ``zero`` coordinate is 0; ties by value."""
    return _zero_counts(df, zero, other).orderBy(F.desc("n"), "value").limit(k)


def _zero_counts(df: DataFrame, zero: str, other: str) -> DataFrame:
    rows = df.select(to_number(F.col(zero)).alias("z"), to_number(F.col(other)).alias("value")).filter("z = 0 and value is not null")
    return rows.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def _zero_values(df: DataFrame, zero: str, other: str, distinct: str, top: str, k: int = 5) -> DataFrame:
    """One row: how many values ``other`` has where ``zero`` is 0, and the commonest of them as text. Values are counted before they are ranked."""
    counted = _zero_counts(df, zero, other)
    first = counted.orderBy(F.desc("n"), "value").limit(k)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "value", "n")))
    text = first.agg(F.array_join(F.transform(ordered, lambda x: F.concat(F.bround(x["value"], 4).cast("string"), F.lit(":"), x["n"].cast("string"))), "; ").alias(top))
    return counted.agg(F.count(F.lit(1)).alias(distinct)).join(F.broadcast(text))


def _repeats(df: DataFrame) -> DataFrame:
    return df.groupBy(ID).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n") - F.count(F.lit(1)), F.lit(0)).cast("long").alias("duplicate_id"))


def _pair_repeats(df: DataFrame) -> DataFrame:
    pairs = df.select(to_number(F.col(LON)).alias("x"), to_number(F.col(LAT)).alias("y")).filter("x is not null and y is not null")
    return pairs.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n") - F.count(F.lit(1)), F.lit(0)).cast("long").alias("duplicate_pairs"))


def _uncertainty_median(df: DataFrame) -> DataFrame:
    found = column_quantiles(df.select(to_number(F.col(UNC)).alias("u")), ["u"], [0.5])
    return found.agg(quantile(found, "u").alias("unc_median"))


def readiness_report(df: DataFrame, dataset: str, source: str = "", member: str = "", at: str = "", bounds: dict[str, float] = EUROPE) -> DataFrame:
    """(ord, dataset_name, section, metric, value, status, notes), values as text.

    Counters come from one aggregation without a shuffle; repeats, the median and the values where a coordinate is zero come from
    values counted in each task first. Missing required columns fail the report, which then ends with the verdict.
    """
    spark = df.sparkSession
    missing = [c for c in REQUIRED if c not in df.columns]
    head: list[tuple] = [("dataset", "columns", str(len(df.columns)), "INFO", ""), ("dataset", "input_zip", source, "INFO", ""), ("dataset", "inner_csv", member, "INFO", "")]
    if missing:
        head.append(("required_columns", "missing_required_columns", ", ".join(missing), "FAIL", "Downstream spatial processing cannot proceed safely."))
    else:
        head.append(("required_columns", "all_required_columns_present", "True", "PASS", ""))
    head += [("optional_columns", f"{c}_present", str(c in df.columns), "INFO", "") for c in OPTIONAL]
    rows: list[tuple[str, str, Column, Column | str, str]] = [("dataset", "rows", F.col("n").cast("string"), "INFO", "")]
    rows += [(s, m, F.lit(v), st, note) for s, m, v, st, note in head]
    wide = [F.count(F.lit(1)).alias("n")]
    if not missing:
        wide += _counters(df, bounds)
        rows += [(s, m, F.col(c), status(F.col(c), bad) if bad else "INFO", note) for s, m, c, bad, note in checks(bounds)]
    agg = df.agg(*wide)
    if not missing:
        for other in (_repeats(df), _pair_repeats(df), _uncertainty_median(df), _zero_values(df, LON, LAT, "lon0_distinct", "top_lat"), _zero_values(df, LAT, LON, "lat0_distinct", "top_lon")):
            agg = agg.join(F.broadcast(other))
    agg = cut(agg)  # the report's rows and the verdict are both made of it
    as_row = lambda i, s, m, v, st, note: F.struct(F.lit(i).alias("ord"), F.lit(s).alias("section"), F.lit(m).alias("metric"), v.cast("string").alias("value"), (F.lit(st) if isinstance(st, str) else st).alias("status"), F.lit(note).alias("notes"))
    long = agg.select(F.inline(F.array(*(as_row(i, *r) for i, r in enumerate(rows)))))
    # What concerns the zero coordinates is told only where there are some.
    long = long.filter("not (metric in ('lon0_unique_latitudes', 'lon0_top_latitudes', 'lat0_unique_longitudes', 'lat0_top_longitudes') and (value = '0' or value = ''))")
    verdict = readiness_verdict(long, bool(missing))
    tail = verdict.select(F.lit(len(rows)).alias("ord"), F.lit("final_assessment").alias("section"), F.lit("final_status").alias("metric"), F.col("final_status").alias("value"), F.col("final_status").alias("status"), "notes")
    stamp = spark.createDataFrame([(len(rows) + 1, "final_assessment", "validation_timestamp", at, "INFO", "")], tail.schema)
    out = long.unionByName(tail).unionByName(stamp)
    return out.select("ord", F.lit(dataset).alias("dataset_name"), "section", "metric", "value", "status", "notes")


def readiness_verdict(rows: DataFrame, critical: bool = False) -> DataFrame:
    """(n_fail, n_warning, final_status, notes) of report rows."""
    n = rows.agg(F.count(F.when(F.col("status") == "FAIL", 1)).alias("n_fail"), F.count(F.when(F.col("status") == "WARNING", 1)).alias("n_warning"))
    bad, warned = F.lit(critical) | (F.col("n_fail") > 0), F.col("n_warning") > 0
    return n.select(
        "n_fail",
        "n_warning",
        F.when(bad, "FAIL").when(warned, "PASS WITH WARNINGS").otherwise("PASS").alias("final_status"),
        (F.lit(CRITICAL) if critical else F.when(bad, FAILED).when(warned, WARNED).otherwise(PASSED)).alias("notes"),
    )


def _in_bounds(lon: Column, lat: Column, b: dict[str, float]) -> Column:
    return lon.between(b["min_lon"], b["max_lon"]) & lat.between(b["min_lat"], b["max_lat"])


def _counters(df: DataFrame, b: dict[str, float]) -> list[Column]:
    lon, lat, unc = (to_number(F.col(c)) for c in (LON, LAT, UNC))
    n = lambda cond: F.count(F.when(cond, 1))
    both = lon.isNotNull() & lat.isNotNull()
    return [
        n(F.col(ID).isNull()).alias("missing_id"),
        *(n(F.col(c).isNotNull() & x.isNull()).alias(f"invalid_{k}") for c, x, k in ((LON, lon, "lon"), (LAT, lat, "lat"), (UNC, unc, "unc"))),
        *(n(F.col(c).isNull()).alias(f"missing_{k}") for c, k in ((LON, "lon"), (LAT, "lat"), (UNC, "unc"))),
        n(lon.isNotNull() & ~lon.between(-180, 180)).alias("lon_range"),
        n(lat.isNotNull() & ~lat.between(-90, 90)).alias("lat_range"),
        n((lon == 0) & (lat == 0)).alias("zero_both"),
        n(lon == 0).alias("zero_lon"),
        n(lat == 0).alias("zero_lat"),
        *(f(x).alias(f"{k}_{c}") for c, x in (("lon", lon), ("lat", lat)) for k, f in (("min", F.min), ("max", F.max))),
        n(both & _in_bounds(lon, lat, b)).alias("in_bounds"),
        n(both & ~_in_bounds(lon, lat, b)).alias("out_of_bounds"),
        F.count(unc).alias("unc_n"),
        n(unc < 0).alias("unc_negative"),
        n(unc == 0).alias("unc_zero"),
        F.min(unc).alias("unc_min"),
        F.max(unc).alias("unc_max"),
    ]


def checks(b: dict[str, float]) -> list[tuple[str, str, str, str, str]]:
    """(section, metric, counter, status if it is not zero or nothing, note)."""
    count = lambda s, m, col, bad, note="": (s, m, col, bad, note)
    return [
        count("gbifID", "missing_gbifID", "missing_id", "FAIL"),
        count("gbifID", "duplicate_gbifID", "duplicate_id", "FAIL"),
        count("numeric_validation", "invalid_longitude_numeric", "invalid_lon", "FAIL"),
        count("numeric_validation", "invalid_latitude_numeric", "invalid_lat", "FAIL"),
        count("numeric_validation", "invalid_uncertainty_numeric", "invalid_unc", "WARNING"),
        count("missing_values", "missing_longitude", "missing_lon", "FAIL"),
        count("missing_values", "missing_latitude", "missing_lat", "FAIL"),
        count("missing_values", "missing_uncertainty", "missing_unc", "WARNING", "Points can be joined to sites, but without uncertainty their class stays open."),
        count("coordinate_ranges", "invalid_longitude_range", "lon_range", "FAIL"),
        count("coordinate_ranges", "invalid_latitude_range", "lat_range", "FAIL"),
        count("suspicious_coordinates", "records_at_0_0", "zero_both", "WARNING"),
        count("suspicious_coordinates", "records_with_longitude_0", "zero_lon", ""),
        count("suspicious_coordinates", "records_with_latitude_0", "zero_lat", ""),
        count("suspicious_coordinates", "lon0_unique_latitudes", "lon0_distinct", ""),
        count("suspicious_coordinates", "lon0_top_latitudes", "top_lat", "", "Commonest latitudes where longitude is 0"),
        count("suspicious_coordinates", "lat0_unique_longitudes", "lat0_distinct", ""),
        count("suspicious_coordinates", "lat0_top_longitudes", "top_lon", "", "Commonest longitudes where latitude is 0"),
        count("duplicate_coordinates", "duplicate_coordinate_pairs", "duplicate_pairs", "WARNING", "Repeated places may come from repeated sampling, centroids or the georeferencing of a collection."),
        count("spatial_extent", "min_longitude", "min_lon", ""),
        count("spatial_extent", "max_longitude", "max_lon", ""),
        count("spatial_extent", "min_latitude", "min_lat", ""),
        count("spatial_extent", "max_latitude", "max_lat", ""),
        count("study_area_plausibility", "records_inside_europe_bbox", "in_bounds", "", f"Bounding box: lon [{b['min_lon']}, {b['max_lon']}], lat [{b['min_lat']}, {b['max_lat']}]"),
        count("study_area_plausibility", "records_outside_europe_bbox", "out_of_bounds", "WARNING", "Records outside the expected extent should be reviewed."),
        count("uncertainty_field", "non_null_uncertainty_values", "unc_n", ""),
        count("uncertainty_field", "negative_uncertainty_values", "unc_negative", "WARNING"),
        count("uncertainty_field", "zero_uncertainty_values", "unc_zero", ""),
        count("uncertainty_field", "uncertainty_min", "unc_min", ""),
        count("uncertainty_field", "uncertainty_median", "unc_median", ""),
        count("uncertainty_field", "uncertainty_max", "unc_max", ""),
    ]


def outside_bounds(df: DataFrame, bounds: dict[str, float] = EUROPE, columns: Sequence[str] = (ID, "scientificName", LON, LAT, "countryCode", "year")) -> DataFrame:
    """Records with both coordinates outside the expected extent; listed columns that exist."""
    lon, lat = to_number(F.col(LON)), to_number(F.col(LAT))
    return df.filter(lon.isNotNull() & lat.isNotNull() & ~_in_bounds(lon, lat, bounds)).select(*(c for c in columns if c in df.columns))


def spatial_extent(df: DataFrame) -> DataFrame:
    return df.agg(*(f(c).alias(f"{k}_{n}") for c, n in ((LON, "lon"), (LAT, "lat")) for k, f in (("min", F.min), ("max", F.max))))
