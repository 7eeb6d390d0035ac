"""Readers for the catalogue's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Parquet table ``name`` of a data directory; columns are pruned by the plan that uses it."""
    return spark.read.parquet(f"{directory}/{name}.parquet")
