"""Running totals, last known values, neighbours and row frames over a whole
input, without a window that puts all rows (or all rows of a key) into one task.

Rows are range-sorted once and numbered through; numbers are cut into blocks of
equal size (by default 32 for each shuffle partition, of at least 2^10 and at most
2^20 rows, so that tasks get about equally many).  Inside a block Spark's windows do the work.  What reaches over a
block's border is small: the value reached at the end of each earlier block (one
row per block), or, for frames and neighbours, copies of the few rows next to the
border.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import materialize

LEAST, MOST = 1 << 10, 1 << 20
_PLACE = (1 << 33) - 1  # rows of a partition in monotonically_increasing_id


def numbered(df: DataFrame, order: Sequence[Column], out: str = "_at") -> DataFrame:
    """``df`` with the place of each row (from 0) under ``order``.  Rows alike in
    ``order`` are spread over partitions too; their order among each other is fixed
    by the result, which is checkpointed (range bounds come from a sample)."""
    # the tie number is stored first: a task that runs again must not give a row another one, and so another range
    rows = materialize(df.withColumn("_tie", F.monotonically_increasing_id())).orderBy(*order, "_tie").drop("_tie")
    rows = materialize(rows.withColumn("_m", F.monotonically_increasing_id()))
    parts = rows.groupBy(F.shiftright("_m", 33).alias("_part")).count()
    # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    # so this broadcast is bounded by the number of partitions
    return rows.withColumn("_part", F.shiftright("_m", 33)).join(F.broadcast(starts), "_part") \
        .withColumn(out, F.col("_start") + F.col("_m").bitwiseAND(F.lit(_PLACE))).drop("_part", "_start", "_m")


def block_size(rows: DataFrame) -> int:
    """Rows of a block: 32 blocks for each shuffle partition, within the bounds.  Counts ``rows``, which should be stored."""
    blocks = 32 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(-(-rows.count() // blocks), LEAST), MOST)


def _blocked(rows: DataFrame, block: int | None, least: int = 1) -> tuple[DataFrame, int]:
    """The rows with the block of their place ``_at``, and the size of a block."""
    block = max(block_size(rows) if block is None else block, least)
    return rows.withColumn("_block", F.floor(F.col("_at") / block)), block


def _keyed(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return numbered(df, [*[F.col(c).asc_nulls_first() for c in by], *order])


def running(df: DataFrame, by: Sequence[str], order: Sequence[Column], sums: Mapping[str, Column] | None = None,
            lasts: Mapping[str, Column] | None = None, block: int | None = None, at: str | None = None) -> DataFrame:
    """``df`` with, per entry of ``sums``, the sum of that column over the rows of
    the same ``by`` up to and with this one, and, per entry of ``lasts``, its last
    value that is not null.  ``by`` may be empty (the whole input); null keys are a
    key.  Rows alike in ``order`` come in an order of their own, each with its own
    total.  ``at``: a column that already numbers the rows by (``by``, order) from 0,
    as ``numbered`` gives it; then nothing is sorted.
    """
    sums, lasts = dict(sums or {}), dict(lasts or {})
    df = df.select("*", *[c.alias(f"_v_{n}") for n, c in {**sums, **lasts}.items()])
    rows, _ = _blocked(_keyed(df, by, order) if at is None else df.withColumn("_at", F.col(at)), block)
    upto = Window.partitionBy("_block", *by).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select("*", *[F.sum(f"_v_{n}").over(upto).alias(f"_r_{n}") for n in sums],
                        *[F.last(f"_v_{n}", ignorenulls=True).over(upto).alias(f"_r_{n}") for n in lasts])
    # a block's first and last key, and the values reached at its end
    key = F.struct(F.lit(0).alias("_one"), *[F.col(c) for c in by])
    reached = [F.max_by(f"_r_{n}", "_at").alias(f"_e_{n}") for n in (*sums, *lasts)]
    ends = local.groupBy("_block").agg(F.min_by(key, "_at").alias("_first"), F.max_by(key, "_at").alias("_final"), *reached)
    # blocks with the same last key follow one another: all rows between belong to that key
    same = Window.partitionBy("_final").orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.select("_block", "_first", "_final", *[F.sum(f"_e_{n}").over(same).alias(f"_e_{n}") for n in sums],
                       *[F.last(f"_e_{n}", ignorenulls=True).over(same).alias(f"_e_{n}") for n in lasts])
    previous = Window.orderBy("_block")  # one row per block
    goes_on = F.lag("_final").over(previous).eqNullSafe(F.col("_first"))
    carry = ends.select("_block", F.when(goes_on, F.col("_first")).alias("_of"),
                        *[F.lag(f"_e_{n}").over(previous).alias(f"_c_{n}") for n in (*sums, *lasts)])
    out = local.join(carry, "_block")
    reaches = F.coalesce(key.eqNullSafe(F.col("_of")), F.lit(False))
    total = {n: F.when(reaches & F.col(f"_c_{n}").isNotNull(), F.col(f"_c_{n}") + F.coalesce(F.col(f"_r_{n}"), F.lit(0)))
             .otherwise(F.col(f"_r_{n}")) for n in sums}
    final = {n: F.coalesce(F.col(f"_r_{n}"), F.when(reaches, F.col(f"_c_{n}"))) for n in lasts}
    names = [c for c in df.columns if not c.startswith("_v_")]
    return out.select(*names, *[c.alias(n) for n, c in {**total, **final}.items()])


def row_frames(df: DataFrame, by: Sequence[str], order: Sequence[Column], frames: Mapping[str, tuple[Column, int, int]],
               block: int | None = None) -> DataFrame:
    """``df`` with, per entry ``name: (aggregate, first, last)``, the aggregate over
    the rows of the same ``by`` from ``first`` to ``last`` places away (negative:
    before; (-1, -1) with ``F.max`` is ``lag``, (1, 1) is ``lead``).

    The rows that a neighbouring block's frames reach are copied there.
    """
    reach = max([0, *(abs(x) for _, a, z in frames.values() for x in (a, z))])
    rows, block = _blocked(_keyed(df, by, order), block, max(reach, 1))
    place = F.pmod(F.col("_at"), F.lit(block))
    before = max([0, *(-a for _, a, _ in frames.values())])  # how far frames look back and ahead
    after = max([0, *(z for _, _, z in frames.values())])
    homes = F.array_compact(F.array(F.col("_block"), F.when(place >= block - before, F.col("_block") + 1),
                                    F.when((place < after) & (F.col("_block") > 0), F.col("_block") - 1)))
    copies = rows.withColumn("_home", F.explode(homes))
    near = Window.partitionBy("_home", *by).orderBy("_at")
    out = copies.select("*", *[agg.over(near.rowsBetween(a, z)).alias(n) for n, (agg, a, z) in frames.items()])
    return out.where(F.col("_home") == F.col("_block")).drop("_home", "_block", "_at")
