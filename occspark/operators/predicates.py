"""Filter specifications and predicate trees as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ALLOWED_BASIS

# Names of request predicates and the columns they read.
PREDICATE_COLUMNS = {
    "TAXON_KEY": "taxonKey",
    "COUNTRY": "countryCode",
    "BASIS_OF_RECORD": "basisOfRecord",
    "COORDINATE_UNCERTAINTY_IN_METERS": "coordinateUncertaintyInMeters",
    "COORDINATE_UNCERTAINTY": "coordinateUncertaintyInMeters",
    "YEAR": "year",
    "MONTH": "month",
    "DECIMAL_LATITUDE": "decimalLatitude",
    "DECIMAL_LONGITUDE": "decimalLongitude",
}


@dataclass(frozen=True)
class FilterSpec:
    """Which occurrences to keep. Bounds are inclusive, the uncertainty limit is not."""

    basis: Sequence[str] = field(default_factory=lambda: list(ALLOWED_BASIS))
    max_uncertainty: float | None = 1000.0
    #: Records without an uncertainty count as certain.
    null_as_zero: bool = True
    min_lat: float | None = None
    max_lat: float | None = None
    min_lon: float | None = None
    max_lon: float | None = None
    min_year: int | None = None
    max_year: int | None = None

    @property
    def by_year(self) -> bool:
        return self.min_year is not None or self.max_year is not None


def basis_filter(spec: FilterSpec) -> Column:
    return F.col("basisOfRecord").isin(*spec.basis)


def uncertainty_filter(spec: FilterSpec) -> Column:
    """Written as a comparison or a null test, which a Parquet scan can use."""
    c = F.col("coordinateUncertaintyInMeters")
    below = c < F.lit(spec.max_uncertainty)
    return c.isNull() | below if spec.null_as_zero and spec.max_uncertainty > 0 else below


def _bounds(column: str, low, high) -> list[Column]:
    c = F.col(column)
    return [c >= F.lit(low)] * (low is not None) + [c <= F.lit(high)] * (high is not None)


def bbox_filter(spec: FilterSpec) -> Column:
    return _all([*_bounds("decimalLatitude", spec.min_lat, spec.max_lat), *_bounds("decimalLongitude", spec.min_lon, spec.max_lon)])


def year_filter(spec: FilterSpec) -> Column:
    """Without bounds everything passes, null years too; with one, a null year does not."""
    return _all(_bounds("year", spec.min_year, spec.max_year))


def _all(parts: Sequence[Column]) -> Column:
    out = F.lit(True)
    for p in parts:
        out = out & p
    return out


def spec_filter(spec: FilterSpec) -> Column:
    parts = [basis_filter(spec), bbox_filter(spec), year_filter(spec)]
    if spec.max_uncertainty is not None:
        parts.insert(1, uncertainty_filter(spec))
    return _all(parts)


def predicate(tree: Mapping, columns: Mapping[str, str] = PREDICATE_COLUMNS) -> Column:
    """A nested request predicate (and, or, not, equals, in, lessThan, ...) as a condition on local columns.

    HAS_COORDINATE asks for both coordinates. HAS_GEOSPATIAL_ISSUE has no local column: it is taken to
    be false. A comparison with null is not true, as in a filter.
    """
    kind = tree["type"]
    if kind in ("and", "or"):
        out = F.lit(kind == "and")
        for p in tree["predicates"]:
            out = out & predicate(p, columns) if kind == "and" else out | predicate(p, columns)
        return out
    if kind == "not":
        return ~F.coalesce(predicate(tree["predicate"], columns), F.lit(False))
    key = tree["key"]
    if key == "HAS_COORDINATE":
        has = F.col("decimalLatitude").isNotNull() & F.col("decimalLongitude").isNotNull()
        return has == F.lit(str(tree["value"]).lower() == "true")
    if key == "HAS_GEOSPATIAL_ISSUE":
        return F.lit(str(tree["value"]).lower() == "false")
    if key not in columns:
        raise ValueError(f"unknown predicate key {key}")
    c = F.col(columns[key])
    if kind == "in":
        return c.isin(*tree["values"])
    # Requests give limits as text; columns are numbers.
    value = F.lit(float(tree["value"]) if kind != "equals" else tree["value"])
    compare = {"equals": c == value, "lessThan": c < value, "lessThanOrEquals": c <= value, "greaterThan": c > value, "greaterThanOrEquals": c >= value}
    if kind not in compare:
        raise ValueError(f"unknown predicate type {kind}")
    return compare[kind]
