"""Bucketed tables: co-locate the big inputs of repeated joins.

Several analytics join or aggregate the order lines and the orders on the
order key (revenue by category, delivery performance, customer segments).
Written once bucketed (and sorted) by that key into the same number of
buckets, the tables are read back already partitioned the way those joins and
aggregations need, so Spark plans them without any shuffle of either side.
Bucketing lives in the catalog, so the tables are read with ``spark.table``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, name: str, keys: str | Sequence[str], buckets: int,
                   mode: str = "overwrite") -> None:
    """Save ``df`` as table ``name`` bucketed and sorted by ``keys``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    df.write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def bucketed_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
