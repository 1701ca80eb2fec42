"""Small expressions with the reference semantics for nulls, rounding and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import NA_VALUES

_DATE = r"^\d{4}(-\d{2}(-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?)?)?$"


def to_number(x: Column) -> Column:
    """Text to double; whatever is not a plain decimal number, and infinities, become null.

    A cast alone would also read letters: type suffixes, hexadecimal digits, NaN and Infinity.
    """
    text = x.cast("string")
    value = text.try_cast("double")
    return F.when((F.abs(value) < float("inf")) & ~text.rlike("[a-df-zA-DF-Z]"), value)


def to_integer(x: Column) -> Column:
    """A double as a long, rounded down."""
    return F.floor(x).cast("long")


def whole(x: Column, name: str) -> Column:
    """A whole double as a long; a fraction is an error, as it would change ids and years unseen."""
    bad = F.raise_error(F.concat(F.lit(f"{name} holds the fraction "), x.cast("string")))
    return F.when(x == F.floor(x), F.floor(x)).when(x.isNotNull(), bad).cast("long")


def percent(part: Column, total: Column, digits: int = 2) -> Column:
    """``part`` of ``total`` in percent, rounded half to even; 0 if the total is 0."""
    return F.when(total == 0, F.lit(0.0)).otherwise(F.bround(part / total * 100.0, digits))


def rounded(x: Column, digits: int) -> Column:
    """A double that is not below 0, rounded as the SQL's engine does: times a power of ten, halves up. ``F.round`` makes a decimal of each."""
    scale = F.lit(10.0**digits)
    whole = F.rint(x * scale)
    return F.when(x * scale - whole == 0.5, whole + 1.0).otherwise(whole) / scale


def blank_to_null(x: Column, na_values=NA_VALUES) -> Column:
    return F.when(~x.isin(*na_values), x)


def clipped(x: Column, low: float, high: float) -> Column:
    """``x`` kept within bounds; null stays null."""
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def is_date_like(x: Column) -> Column:
    """ISO 8601 dates: a year, year and month, day, or time, that exist."""
    # Months and days that are left out are the first ones.
    full = F.concat(F.substring(x, 1, 10), F.when(F.length(x) == 4, "-01-01").when(F.length(x) == 7, "-01").otherwise(""))
    return F.coalesce(x.rlike(_DATE) & F.try_to_date(full, "yyyy-MM-dd").isNotNull(), F.lit(False))


def warning_flags(missing_pct: Column, distinct: Column, non_null: Column) -> Column:
    flags = F.array(
        F.when(missing_pct >= 20, "high_missingness").when(missing_pct > 0, "some_missingness"),
        F.when((distinct == 1) & (non_null > 0), "constant_column"),
        F.when(distinct <= 12, "low_cardinality"),
    )
    joined = F.array_join(F.array_compact(flags), " | ")
    return F.when(joined == "", "none").otherwise(joined)


def status(count: Column, bad: str) -> Column:
    """PASS when nothing was counted, else ``bad`` (WARNING or FAIL)."""
    return F.when(count == 0, "PASS").otherwise(bad)


def completeness(n_years: Column, span: Column) -> Column:
    return F.when(span == 0, F.lit(1.0)).otherwise(n_years / (span + 1))
