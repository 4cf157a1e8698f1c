"""Parquet tables of a data directory (one ``<name>.parquet`` per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan of the files there now; projections and filters applied
    later reach the scan (column pruning, PushedFilters), so callers select only
    what they use."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")
