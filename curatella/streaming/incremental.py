"""Incremental runs: skip what is done, and take new files as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pending(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys aren't done; rows with null keys are always pending."""
    return df.join(done.select(*keys).distinct(), keys, "left_anti")


def run_new_files(spark: SparkSession, folder: str, schema: str, checkpoint: str, apply: Callable[[DataFrame, int], None], source: str = "json", timeout: int = 600) -> None:
    """Hands files that came since the last run to ``apply`` (batch, id), then ends.

    The file source keeps what it has seen in the checkpoint, so that a run that is broken off is taken up
    where it was; apply must be idempotent by batch id.
    """
    stream = spark.readStream.schema(schema).format(source).load(folder)
    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(apply).start()
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"not done in {timeout} s")


def late_links(links: DataFrame, at: str, keys: list[str], delay: str = "30 days") -> DataFrame:
    """Stream of links, each once within the delay: repeated deliveries are dropped by watermark."""
    return links.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def monthly(links: DataFrame, at: str, group: list[str], delay: str = "30 days", window: str = "30 days") -> DataFrame:
    """Stream of counts per group and window of event time, emitted when the watermark has passed."""
    counts = links.withWatermark(at, delay).groupBy(F.window(at, window).alias("w"), *group).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), *group, "n")
