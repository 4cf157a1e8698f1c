"""Aggregation blocks.

``partial_sums`` / ``merge_partials`` / ``finish_avg`` split an average into an
mergeable state (decimal sum, double sum of the values no decimal holds, count).  Plans use it to aggregate a fact
table on its join key *before* joining a dimension, so the join and the final
grouping see one row per key instead of one per fact row -- and a hot key
(say a third of all rows) collapses in the map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import lossless, ratio, total

SUM = "_sum"
REST = "_rest"
CNT = "_cnt"


def partial_sums(df: DataFrame, keys: Sequence[str], value: str, scale: int = 2) -> DataFrame:
    """keys + (_sum decimal, _rest double, _cnt bigint) over non-null values."""
    exact, rest = lossless(value, df.schema[value].dataType, scale)
    return (df.where(F.col(value).isNotNull())
              .groupBy(*keys)
              .agg(F.sum(exact).alias(SUM), F.sum(rest).alias(REST), F.count(F.lit(1)).alias(CNT)))


def merge_partials(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(SUM).alias(SUM), F.sum(REST).alias(REST), F.sum(CNT).alias(CNT))


def finish_avg(df: DataFrame, avg_name: str = "avg_rating", count_name: str | None = "n_ratings") -> DataFrame:
    out = df.withColumn(avg_name, ratio(total(SUM, REST), CNT))
    if count_name:
        out = out.withColumn(count_name, F.col(CNT))
    return out.drop(SUM, REST, CNT)


def pivot_avg(df: DataFrame, key: str | Sequence[str], group_col: str, groups: Sequence[str],
              names: Sequence[str], fill: float | None = 0.0) -> DataFrame:
    """Wide conditional averages from partial sums: one column per
    listed group value; other group values are ignored; a group with no rows
    gets ``fill``.  Equivalent to ``pivot(group_col, groups)`` with a fixed
    value list (no extra pass to discover values)."""
    keys = [key] if isinstance(key, str) else list(key)
    aggs = []
    for g, name in zip(groups, names):
        hit = F.col(group_col) == F.lit(g)
        aggs += [F.sum(F.when(hit, F.col(SUM))).alias(f"_s_{name}"), F.sum(F.when(hit, F.col(REST))).alias(f"_r_{name}"),
                 F.sum(F.when(hit, F.col(CNT))).alias(f"_n_{name}")]
    wide = df.where(F.col(group_col).isin(list(groups))).groupBy(*keys).agg(*aggs)
    cols = []
    for name in names:
        avg = ratio(total(f"_s_{name}", f"_r_{name}"), f"_n_{name}")
        cols.append((F.coalesce(avg, F.lit(fill)) if fill is not None else avg).alias(name))
    return wide.select(*keys, *cols)


def distinct_count(c: Column | str, approx: bool = False, rsd: float = 0.01) -> Column:
    """Distinct non-null values.  Exact by default (two-phase aggregation,
    shuffled on the (group, value) pairs).  ``approx=True`` is INEXACT: one
    HyperLogLog++ sketch per group (relative error ``rsd``); no job or query uses it."""
    col = F.col(c) if isinstance(c, str) else c
    return F.approx_count_distinct(col, rsd) if approx else F.count_distinct(col)


def distinct_count_with_null(c: Column | str, approx: bool = False) -> Column:
    """``select(c).distinct().count()``: like count_distinct, but null is one more value."""
    col = F.col(c) if isinstance(c, str) else c
    return (distinct_count(col, approx)
            + F.coalesce(F.max(F.when(col.isNull(), F.lit(1)).otherwise(F.lit(0))), F.lit(0))).cast("bigint")


def distinct_totals(parts: Sequence[tuple[str, DataFrame, str]], approx: bool = False) -> DataFrame:
    """One row with one distinct count (null counted) per (name, df, column).

    The inputs are unioned into (entity, key) so a single aggregation
    (partial distinct per entity, one shuffle on (entity, key)) computes all
    counts; the result is folded to one row without any join.
    """
    types = {df.schema[col].dataType for _, df, col in parts}
    # Keep the native key type when all agree (narrower rows to shuffle).
    cast = None if len(types) == 1 else "string"
    longs = [df.select(F.lit(name).alias("_entity"),
                       (F.col(col).cast(cast) if cast else F.col(col)).alias("_key"))
             for name, df, col in parts]
    unioned = longs[0]
    for other in longs[1:]:
        unioned = unioned.unionByName(other)
    per_entity = unioned.groupBy("_entity").agg(distinct_count_with_null("_key", approx).alias("_n"))
    return per_entity.agg(*[
        F.coalesce(F.max(F.when(F.col("_entity") == name, F.col("_n"))), F.lit(0)).cast("bigint").alias(name)
        for name, _, _ in parts])
