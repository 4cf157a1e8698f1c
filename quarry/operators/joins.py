"""Dimension lookups.

Which side is broadcast is left to Spark: its planner applies
``autoBroadcastJoinThreshold`` to the estimate and adaptive execution re-checks
the *measured* size.  Beyond that the join is a shuffle (sort-merge) join, and
AQE splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column in which the readers give a row's place in its files ("last wins").
ORDER = "_order"


def dedup_last(dim: DataFrame, key: str | Sequence[str], order_col: str) -> DataFrame:
    """One row per key: the one with the greatest ``order_col`` ("last wins",
    like filling a hash map in file order).  Runs as a normal aggregation."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in dim.columns if c not in keys]
    picked = dim.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order_col)).alias("_row"))
    return picked.select(*keys, *[F.col("_row." + c).alias(c) for c in rest])


def unique_dimension(dim: DataFrame, key: str, columns: Sequence[str], dedup: str | None = None,
                     order_col: str = ORDER) -> DataFrame:
    """``key`` and ``columns`` of a dimension.  ``dedup``: ``last_wins`` keeps
    the row with the greatest ``order_col`` of each key (a hash map filled in
    file order), ``assert`` fails on a repeated key, ``none`` keeps all rows
    (a repeated key multiplies).  By default ``last_wins`` where the reader
    gave the rows' order, else ``none``."""
    dedup = dedup or ("last_wins" if order_col in dim.columns else "none")
    if dedup == "last_wins":
        return dedup_last(dim.select(key, *columns, order_col), key, order_col).select(key, *columns)
    if dedup == "assert":
        row = F.struct(*columns)
        checked = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.concat(
            F.lit(f"repeated {key}: "), F.coalesce(F.first(F.col(key)).cast("string"), F.lit("null"))))
        ).otherwise(F.first(row)).cast(dim.select(row.alias("r")).schema["r"].dataType)
        return dim.groupBy(key).agg(checked.alias("_row")).select(key, *[F.col(f"_row.{c}").alias(c) for c in columns])
    if dedup != "none":
        raise ValueError(f"dedup: last_wins, assert or none, not {dedup!r}")
    return dim.select(key, *columns)


def lookup_inner(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Inner equi-join to a dimension; rows without a match are dropped."""
    dim_key = dim_key or fact_key
    if dim_key == fact_key:
        return fact.join(dim, fact_key, "inner")
    return fact.join(dim, fact[fact_key] == dim[dim_key], "inner").drop(dim[dim_key])


def lookup_with_default(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                        value: str, default, out: str | None = None) -> DataFrame:
    """Left lookup of one value; a miss yields ``default`` and never drops a row."""
    out = out or value
    side = dim.select(F.col(dim_key).alias("_lk"), F.col(value).alias("_lv"))
    joined = fact.join(side, fact[fact_key] == side["_lk"], "left")
    return joined.withColumn(out, F.coalesce(F.col("_lv"), F.lit(default))).drop("_lk", "_lv")


def anti_join_words(words: DataFrame, stop: DataFrame, word_col: str = "word",
                    stop_col: str = "stopword") -> DataFrame:
    """Words minus a stop list.  Duplicate stop entries are harmless; a null
    word never matches, so it is kept (left-outer-join + IS NULL semantics)."""
    side = stop.select(F.col(stop_col).alias("_stop"))
    return words.join(side, words[word_col] == side["_stop"], "left_anti")


def grid_join(left: DataFrame, right: DataFrame, on: Sequence[str], dense: int) -> DataFrame:
    """Inner equi-join whose crowded keys are split: where a side has more than
    ``dense`` rows of a key, both sides' rows are dealt into chunks and each pair of
    chunks is joined on its own, so no task gets all rows of a key.  Rows are copied
    for crowded keys only; each pair still comes once.  Null keys match nothing.
    Rows alike in all columns fall into one chunk: where there may be very many,
    give each a stored number.
    """
    known = " and ".join(f"`{c}` is not null" for c in on)
    left, right = left.where(known), right.where(known)
    sizes = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_nl"), F.lit(0).cast("long").alias("_nr")).unionByName(
        right.groupBy(*on).agg(F.lit(0).cast("long").alias("_nl"), F.count(F.lit(1)).alias("_nr")))
    crowded = sizes.groupBy(*on).agg(F.max("_nl").alias("_nl"), F.max("_nr").alias("_nr")).where(
        (F.greatest("_nl", "_nr") > dense) & (F.least("_nl", "_nr") > 0))
    grid = crowded.select(*on, *[F.greatest(F.ceil(F.col(n) / dense), F.lit(1)).cast("int").alias(c)
                                 for n, c in (("_nl", "_cl"), ("_nr", "_cr"))])

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        """The row's own chunk, and all chunks of the other side."""
        # chunks follow from the row's values alone, so a task that runs again deals alike
        mine = F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 20)).cast("int")
        chunks = rows.withColumn("_deal", mine).join(grid, list(on), "left")
        others = F.explode(F.sequence(F.lit(0), F.coalesce(f"_c{other}", F.lit(1)) - 1))
        return chunks.withColumn(f"_i{own}", F.pmod("_deal", F.coalesce(f"_c{own}", F.lit(1)))).withColumn(f"_i{other}", others) \
            .drop("_cl", "_cr", "_deal")

    return dealt(left, "l", "r").join(dealt(right, "r", "l"), [*on, "_il", "_ir"]).drop("_il", "_ir")
