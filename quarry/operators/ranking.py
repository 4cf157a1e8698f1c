"""Top-k and arg-max.

``top_k_per_group`` is ``row_number() <= k`` directly over the window: Spark
plans it with a partial WindowGroupLimit *before* the shuffle, so each map
task ships at most k rows per group -- a group holding a third of the data
does not end up whole in one task.  ``argmax_row`` is sort+limit, planned as
TakeOrderedAndProject (per-partition top-1, then a tiny merge).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column], k: int,
                    rank_col: str | None = None) -> DataFrame:
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    ranked = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    return ranked.withColumnRenamed("_rn", rank_col) if rank_col else ranked.drop("_rn")


def nested_top_k(df: DataFrame, group_cols: Sequence[str], item_cols: Sequence[str],
                 order_cols: Sequence[Column], k: int, out: str = "top") -> DataFrame:
    """Group -> array<struct(item_cols)> of its top k rows in order.  The
    collected list is bounded by k."""
    ranked = top_k_per_group(df, group_cols, order_cols, k, rank_col="_rank")
    bag = F.sort_array(F.collect_list(F.struct(F.col("_rank"), *[F.col(c) for c in item_cols])))
    return (ranked.groupBy(*group_cols).agg(bag.alias("_bag"))
                  .select(*group_cols, F.transform("_bag", lambda s: F.struct(*[s[c].alias(c) for c in item_cols])).alias(out)))


def argmax_row(df: DataFrame, order_cols: Sequence[Column]) -> DataFrame:
    """The first row under ``order_cols`` (empty input -> empty result)."""
    return df.orderBy(*order_cols).limit(1)


def global_rank(df: DataFrame, keys: Sequence[str], ascending: bool | Sequence[bool] = True,
                out: str = "rank", dense: bool = False) -> DataFrame:
    """``rank()`` (or ``dense_rank()``) over the whole input ordered by
    ``keys``, without a single-partition window and without putting all rows
    of one key value into one task.

    The rows are range-sorted by (keys, a unique tiebreak), so even a key value
    held by a third of all rows spreads over several partitions, and ranked
    inside their partition; these rows are checkpointed once (range bounds come
    from a sample, so the assignment must not be recomputed, and both the
    summary and the result read it).  A small summary with one row per partition
    (row or key counts, first and last key) gives each partition its offset and,
    for a key group that started in an earlier partition, the rank that group
    started with; window functions over that summary resolve both.
    """
    from quarry.session import materialize
    asc = [ascending] * len(keys) if isinstance(ascending, bool) else list(ascending)
    order = [F.col(k).asc() if a else F.col(k).desc() for k, a in zip(keys, asc)]
    key = F.struct(*[F.col(k) for k in keys])
    in_part = Window.partitionBy("_pid").orderBy(*order)
    local = materialize(df.withColumn("_tb", F.monotonically_increasing_id())
                          .orderBy(*order, F.col("_tb").asc())
                          .withColumn("_pid", F.spark_partition_id())
                          .withColumn("_lr", (F.dense_rank() if dense else F.rank()).over(in_part))
                          .withColumn("_rn", F.row_number().over(in_part.orderBy(*order, F.col("_tb")))))
    parts = local.groupBy("_pid").agg(
        F.count(F.lit(1)).alias("_rows"), F.max("_lr").alias("_keys"),
        F.min_by(key, F.col("_rn")).alias("_first"), F.max_by(key, F.col("_rn")).alias("_last"),
        F.max_by(F.col("_lr"), F.col("_rn")).alias("_last_lr"))
    by_pid = Window.orderBy("_pid")
    before = by_pid.rowsBetween(Window.unboundedPreceding, -1)
    prev_last = F.lag("_last").over(by_pid)
    overlap = F.coalesce(F.col("_first").eqNullSafe(prev_last), F.lit(False))
    summary = parts.withColumn("_overlap", overlap)
    if dense:
        # distinct keys before this partition; a key spanning partitions counts once
        summary = summary.withColumn("_off", F.coalesce(F.sum(
            F.col("_keys") - F.col("_overlap").cast("long")).over(before), F.lit(0)))
        summary = summary.select("_pid", "_off", F.col("_overlap").cast("long").alias("_ov"))
        ranked = local.join(summary, "_pid")
        value = F.col("_off") + F.col("_lr") - F.col("_ov")
        return ranked.withColumn(out, value.cast("bigint")).drop("_tb", "_pid", "_lr", "_rn", "_off", "_ov")
    summary = summary.withColumn("_off", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    # rank at which the last key group of each partition started: its own, unless the
    # whole partition continues a group from before (then the earlier start carries on)
    whole_continues = F.col("_overlap") & F.col("_first").eqNullSafe(F.col("_last"))
    own_start = F.col("_off") + F.col("_last_lr")
    summary = summary.withColumn("_start", F.last(F.when(~whole_continues, own_start), ignorenulls=True)
                                 .over(by_pid.rowsBetween(Window.unboundedPreceding, 0)))
    summary = summary.withColumn("_carry", F.when(F.col("_overlap"), F.lag("_start").over(by_pid)))
    summary = summary.select("_pid", "_off", "_first", "_carry")
    ranked = local.join(summary, "_pid")
    continues = F.col("_carry").isNotNull() & key.eqNullSafe(F.col("_first"))
    value = F.when(continues, F.col("_carry")).otherwise(F.col("_off") + F.col("_lr"))
    return ranked.withColumn(out, value.cast("bigint")).drop("_tb", "_pid", "_lr", "_rn", "_off", "_first", "_carry")
