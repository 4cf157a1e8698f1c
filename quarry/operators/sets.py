"""Set operations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name (duplicates kept)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def tagged_union(parts: Mapping[str, DataFrame], tag_col: str = "part") -> DataFrame:
    """UNION ALL with a literal column telling which input each row came from."""
    return union_all(*[d.withColumn(tag_col, F.lit(tag)) for tag, d in parts.items()])


def spread(df: DataFrame, key: Column | str | None = None, min_partitions: int | None = None) -> DataFrame:
    """Hash-repartition a freshly read input before CPU-heavy per-row work
    (tokenising whole texts) when it arrives in fewer splits than the cluster
    can run at once -- a few large files or row groups.  An input already split
    wider than that (any large table) is returned unchanged, so no shuffle is
    added at scale.  ``key`` should be deterministic (an id, or a hash of the
    text) so a retried task sees the same rows.

    Apply it to a source scan: the split count of a plan that already contains
    a shuffle is only known after running that shuffle."""
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, key) if key is not None else df.repartition(want)
