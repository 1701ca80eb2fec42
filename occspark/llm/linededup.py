"""Line dedup by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.shared import cut, fresh, lookup_join
from .text import BLANKS, line_key

RATIO = 0.1
MIN_PAGES = 5


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _trimmed(line: Column) -> Column:
    return F.trim(F.translate(line, BLANKS, " " * len(BLANKS)))


def boilerplate_lines(docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Lines (as ``line_key``) that stand on more than ``ratio`` of their host's pages and on ``min_pages`` at least.

    Returned as one row per host with an array of keys. The array is bounded whatever the
    host's size: each entry takes more than ``ratio`` of its pages, so it holds fewer than
    (mean distinct lines of a page) / ``ratio`` entries. Counts are summed before the shuffle, on
    (host, line), which spreads a large host over all tasks.
    """
    seen = docs.select(F.col(host).alias("__h"), _lines(F.col("text")).alias("__l"))
    seen = seen.select("__h", F.filter(F.transform("__l", _trimmed), lambda x: x != "").alias("__l"))
    keys = seen.select("__h", F.explode(F.array_distinct(F.transform("__l", line_key))).alias("__k"))
    pages = docs.groupBy(F.col(host).alias("__h")).agg(F.count(F.lit(1)).alias("__pages"))
    # Only lines that could pass on the number of pages alone go on to meet their host's total.
    counted = keys.groupBy("__h", "__k").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= min_pages)
    counted = lookup_join(cut(counted), cut(pages), "__h", F.col("__k.a"))
    often = counted.filter(F.col("__n") > F.lit(ratio) * F.col("__pages"))
    return often.groupBy("__h").agg(F.sort_array(F.collect_list("__k")).alias("__keys")).withColumnRenamed("__h", host)


def drop_boilerplate_lines(docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and ``n_lines`` and ``n_dropped_lines`` (long).

    Lines are compared without the blanks around them; blank lines are neither counted nor
    dropped. A null text stays null, with no lines. Documents without a host form one host.
    Every copy of a repeated row counts as a page. An empty table gives an empty result; the two
    counts replace columns of their names.
    """
    found = cut(boilerplate_lines(docs, host, ratio, min_pages))
    lines, kept_, all_keys = (fresh(n, docs) for n in ("__l", "__kept", "__keys"))
    out = lookup_join(docs, found.withColumnRenamed("__keys", all_keys), host, F.xxhash64("text"))
    keys = F.coalesce(all_keys, F.array().cast("array<struct<a:bigint,b:bigint>>"))
    drop = lambda x: F.array_contains(keys, line_key(_trimmed(x)))
    some = F.size(all_keys) > 0
    kept = F.when(some, F.filter(lines, lambda x: ~drop(x))).otherwise(F.col(lines))
    full = F.size(F.filter(lines, lambda x: _trimmed(x) != ""))
    out = out.withColumn(lines, _lines(F.col("text"))).withColumn(kept_, kept)
    return out.withColumns(
        {
            "n_lines": full.cast("long"),
            "n_dropped_lines": (F.size(lines) - F.size(kept_)).cast("long"),
            "text": F.when(F.col("text").isNotNull(), F.array_join(kept_, "\n")),
        }
    ).drop(lines, kept_, all_keys)
