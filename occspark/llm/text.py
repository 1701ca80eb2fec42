"""Expressions on words and lines that several operators share; all stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that ends a word: the ASCII blanks and controls 9 to 13.
SPACE = "[\\x20\\x09-\\x0D]+"
BLANKS = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def shingles(found: Column, size: int, of: Callable[[list[Column]], Column]) -> Column:
    """``of`` applied to every run of ``size`` neighbouring entries of an array; shorter arrays give none."""
    starts = F.slice(found, 1, F.greatest(F.size(found) - (size - 1), F.lit(0)))
    return F.transform(starts, lambda w, i: of([w, *(F.get(found, i + k) for k in range(1, size))]))


def line_key(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))
