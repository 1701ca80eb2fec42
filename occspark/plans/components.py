"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import checked, cut, discard


def _oriented(pairs: DataFrame) -> DataFrame:
    """Distinct (hi, lo) with hi > lo."""
    hi, lo = F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")
    return pairs.filter(F.col("hi") != F.col("lo")).select(hi, lo).distinct()


def _large_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges after a step, and the table of least neighbours that they are made with.

    That table is written down: the join then shuffles both sides for itself, or broadcasts a small one, so Spark splits a node
    that holds a large share of all links; next to the sums that made the table it could not.
    """
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m")))
    return _oriented(both.filter("v > u").join(checked(least), F.col("u") == F.col("w")).select(F.col("v").alias("hi"), F.col("m").alias("lo"))), least


def _small_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    least = cut(edges.groupBy("hi").agg(F.min("lo").alias("m")))
    moved = edges.join(checked(least.withColumnRenamed("hi", "w")), F.col("hi") == F.col("w")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return _oriented(moved.union(least.select("hi", F.col("m").alias("lo")))), least


def connected_components(pairs: DataFrame, a: str, b: str, max_rounds: int = 100) -> DataFrame:
    """(node, root): each node that has a link, with the least node it can reach; roots map to themselves.

    Rounds of large-star and small-star run until nothing changes, which takes about the
    logarithm of the longest path. Each round is written to the shared folder and only its
    row count and a checksum come to the driver. No neighbour list is ever gathered, so a node
    with very many links is only a large key of joins and sums. Null ends and self links are
    left out.
    """
    edges = cut(_oriented(pairs.select(F.col(a).alias("hi"), F.col(b).alias("lo"))))
    before = None
    for _ in range(max_rounds):
        sign = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        if sign == before or not sign[0]:
            break
        before, last = sign, edges
        wide, large = _large_star(edges)
        wide = cut(wide)
        narrow, small = _small_star(wide)
        edges = cut(narrow)
        for table in (last, wide, large, small):
            discard(table)
    else:
        raise RuntimeError(f"no fixed point within {max_rounds} rounds")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(edges.select(F.col("lo"), F.col("lo"))).distinct()
