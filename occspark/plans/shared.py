"""Lineage cuts in the shared folder and joins whose broadcast side is checked."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampType

#: Rows and bytes up to which a materialised side is broadcast; past either the join shuffles with salt.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
#: Bytes up to which a table read by few tasks is dealt over all cores.
SPREAD_BYTES = 1 << 30
#: Buckets that one key is dealt to in a salted join.
SALT = 32


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it in ``spark.checkpoint.dir``.

    Where that is unset a temporary folder stands in if all tasks run in the driver's own process; on a cluster
    it must be set, since executors do not see the driver's folders.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="occspark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def discard(df: DataFrame) -> None:
    """Deletes the folders of a ``cut`` table that nothing will read again, not only when the driver's JVM ends."""
    spark = df.sparkSession
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that goes when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def is_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a (materialised) table has at most ``limit`` rows, reading no more than it takes to tell, and few bytes.

    Strings and arrays of these rows are counted too; the rest of a row is some 8 bytes a column.
    """
    if df.limit(limit + 1).count() > limit:
        return False
    wide = [f.name for f in df.schema if not isinstance(f.dataType, (NumericType, BooleanType, DateType, TimestampType))]
    if not wide:
        return True
    size = F.sum(F.octet_length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in wide)))))
    return (df.agg(size).first()[0] or 0) <= BROADCAST_BYTES


def checked(df: DataFrame, small: bool | None = None) -> DataFrame:
    """A join side that is broadcast only if it was counted as small; else the join sorts and merges, and Spark splits large keys."""
    return F.broadcast(df) if (is_small(df) if small is None else small) else df.hint("merge")


def cut(df: DataFrame, *partition_by: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends there.

    The files outlive executors, so a lost one costs no recomputation upstream, and columns
    can still be pruned, which a checkpoint of rows does not allow. The folder goes when the
    driver's JVM ends.
    """
    spark = df.sparkSession
    path = scratch(spark, "cut")
    writer = df.write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A small table of fewer scan partitions than cores, its rows dealt over all cores: a row group is read by one task.

    What Spark plans to read decides. Tables with partitions enough, and those of over ``SPREAD_BYTES``, are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size <= SPREAD_BYTES and df.rdd.getNumPartitions() < cores else df


def fresh(name: str, *tables: DataFrame) -> str:
    """A column name that none of the tables has."""
    while any(name in t.columns for t in tables):
        name = f"_{name}"
    return name


def salted(key: Column, salts: int = SALT) -> Column:
    """A bucket from 0 to ``salts - 1`` that depends on ``key`` only, so retries agree."""
    return F.pmod(F.xxhash64(key), F.lit(salts)).cast("int")


def lookup_join(left: DataFrame, right: DataFrame, key: str, spread: Column, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Left join to a materialised ``right`` with one row per ``key`` (null keys meet null keys).

    ``right`` is counted: up to ``limit`` rows it is broadcast. Beyond that both sides shuffle on
    the key and a salt taken from ``spread``, with ``right`` repeated once per salt, so a key
    that holds a third of ``left`` goes to ``SALT`` tasks instead of one. Columns of ``right``
    replace those of ``left`` with their names.
    """
    own, salt, other = (fresh(n, left, right) for n in ("__key", "__salt", "__rsalt"))
    r = right.withColumnRenamed(key, own)
    left = left.drop(*(c for c in r.columns if c in left.columns))
    if is_small(r, limit):
        return left.join(F.broadcast(r), left[key].eqNullSafe(r[own]), "left").drop(own)
    lhs = left.withColumn(salt, salted(spread))
    rhs = r.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    on = lhs[key].eqNullSafe(rhs[own]) & (lhs[salt] == rhs[other])
    return lhs.join(rhs.hint("merge"), on, "left").drop(own, salt, other)
