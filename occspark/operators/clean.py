"""From raw text records to the typed, filtered occurrence table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import blank_to_null, to_integer, to_number, whole
from ..schemas import INTEGER_COLUMNS, NA_VALUES, NUMERIC_COLUMNS, RAW_COLUMNS, REQUIRED_RAW, REQUIRED_TYPED
from .predicates import FilterSpec, spec_filter


def null_out(raw: DataFrame, na_values: Sequence[str] = NA_VALUES) -> DataFrame:
    """Text columns with the usual missing marks made null."""
    return raw.select(*(blank_to_null(F.col(f.name), na_values).alias(f.name) if f.dataType.simpleString() == "string" else f.name for f in raw.schema))


def drop_missing(df: DataFrame, columns: Sequence[str] = REQUIRED_RAW) -> DataFrame:
    return df.dropna(subset=[c for c in columns if c in df.columns])


def coerce_numbers(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Listed columns as doubles; what does not read as a number becomes null."""
    return df.withColumns({c: to_number(F.col(c)) for c in columns if c in df.columns})


def cast_integers(df: DataFrame, columns: Sequence[str] = INTEGER_COLUMNS) -> DataFrame:
    """Listed columns as longs; fractions raise."""
    return df.withColumns({c: whole(F.col(c), c) for c in columns if c in df.columns})


def canonical(df: DataFrame) -> DataFrame:
    """The occurrence columns in their order with their types."""
    return cast_integers(df).select(*RAW_COLUMNS)


def filter_occurrences(raw: DataFrame, spec: FilterSpec = FilterSpec(), na_values: Sequence[str] | None = NA_VALUES) -> DataFrame:
    """Raw text records to canonical occurrences: drop incomplete ones, read numbers, drop again, filter.

    One pass without a shuffle. ``na_values=None`` takes text as it stands. An integer column with a fraction raises.
    """
    df = raw.select(*(c for c in RAW_COLUMNS if c in raw.columns))
    if na_values is not None:
        df = null_out(df, na_values)
    df = drop_missing(coerce_numbers(drop_missing(df)), REQUIRED_TYPED)
    if spec.by_year:
        df = df.dropna(subset=["year"])
    return canonical(df.filter(spec_filter(spec)))


# The checks of the final table and what a violation says.
INTEGRITY = {
    "gbifid_null": "gbifID contains missing values",
    "gbifid_duplicate": "gbifID contains duplicate values",
    "coordinates_null": "coordinates contain missing values",
    "latitude_out_of_range": "decimalLatitude outside [-90, 90]",
    "longitude_out_of_range": "decimalLongitude outside [-180, 180]",
    "not_whole": "an integer column holds fractions",
}


def _bad(condition: Column) -> Column:
    return F.coalesce(F.sum(F.coalesce(condition, F.lit(False)).cast("long")), F.lit(0).cast("long"))


def integrity_counts(df: DataFrame) -> DataFrame:
    """One row with the violations of each check, of typed or still fractional columns."""
    lat, lon = F.col("decimalLatitude"), F.col("decimalLongitude")
    fraction = F.lit(False)
    for c in INTEGER_COLUMNS:
        if c in df.columns:
            fraction = fraction | F.coalesce(F.col(c) != F.floor(c), F.lit(False))
    # Nulls are equal to each other among duplicates: rows less distinct values, null being one.
    distinct = F.count_distinct("gbifID") + F.max(F.when(F.col("gbifID").isNull(), 1).otherwise(0))
    return df.agg(
        _bad(F.col("gbifID").isNull()).alias("gbifid_null"),
        F.coalesce(F.count(F.lit(1)) - distinct, F.lit(0)).cast("long").alias("gbifid_duplicate"),
        _bad(lat.isNull() | lon.isNull()).alias("coordinates_null"),
        _bad(~lat.between(-90, 90)).alias("latitude_out_of_range"),
        _bad(~lon.between(-180, 180)).alias("longitude_out_of_range"),
        _bad(fraction).alias("not_whole"),
    )


def check_integrity(df: DataFrame) -> DataFrame:
    """``df`` itself; raises on the first violated check."""
    counts = integrity_counts(df).first()
    for name, said in INTEGRITY.items():
        if counts[name]:
            raise ValueError(f"{said}: {counts[name]} rows")
    return df


def taxon_keys(species: DataFrame) -> DataFrame:
    """Distinct whole keys of a species list: the accepted key where there is one, else the key used."""
    key = F.coalesce(to_number(F.col("acceptedUsageKey")), to_number(F.col("usageKey")))
    return species.select(to_integer(key).alias("taxonKey")).filter("taxonKey is not null").distinct()


def require_taxon_keys(species: DataFrame) -> list[int]:
    """The keys as a list for a request, in order; raises when there are none. A species list is small."""
    found = [r["taxonKey"] for r in taxon_keys(species).orderBy("taxonKey").collect()]
    if not found:
        raise ValueError("the species list has no usable taxon key")
    return found
