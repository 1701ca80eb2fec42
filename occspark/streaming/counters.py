"""Filtering and counting of arriving records. Beyond the reference, which has no streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import filter_occurrences
from ..operators.predicates import FilterSpec
from ..operators.summaries import COUNTERS, counters
from ..schemas import RAW_COLUMNS


def stream_counters(spark: SparkSession, folder: str, store: str, checkpoint: str, spec: FilterSpec = FilterSpec()) -> StreamingQuery:
    """Counts every arriving file of raw TSV records once, keeping one folder of partial counts per batch.

    A batch that is run again after a failure replaces its own folder, so counts stay right. Partial
    counts add up (``stored_counters``), and the stream itself holds no state.
    """
    schema = ", ".join(f"{c} string" for c in RAW_COLUMNS)
    raw = spark.readStream.schema(schema).option("sep", "\t").option("header", True).option("quote", "").csv(folder)

    def one(batch: DataFrame, number: int) -> None:
        counters(filter_occurrences(batch, spec), COUNTERS).write.mode("overwrite").parquet(f"{store}/batch={number}")

    return raw.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored_counters(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(f"{store}/batch=*").groupBy("counter", "value").agg(F.sum("n").alias("n"))


def daily_counts(events: DataFrame, time: str, key: str, late: str = "1 day") -> DataFrame:
    """Counts by day and key of a stream with event times, closed once ``late`` has passed."""
    return events.withWatermark(time, late).groupBy(F.window(time, "1 day").alias("day"), key).agg(F.count(F.lit(1)).alias("n"))
