"""As-of join: for each left row, the last right row of the same key at or before its time.

Both sides are dealt out by their key once and sorted there by time, and the last
known right row is carried on by a window; neither side is stored or held in memory.
A key with many rows is cut by time into cells, which are dealt out one by one; what
a cell takes over from those before it is one row, which is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, VariantType

from quarry.operators.running import LEAST, MOST
from quarry.session import materialize

_DRAWN = 16  # sampled times of a block, from which cuts are chosen
_SPREAD = 1 << 20


def _full_buckets(sizes: DataFrame, keys: Sequence[str], block: int | None) -> tuple[DataFrame, list[tuple[int]], int]:
    """``sizes`` with a bucket ``_bucket`` for each key, the buckets with more than a block of rows, and the rows of a
    block: 32 blocks for each shuffle partition, within the bounds of ``running``.  There are four buckets for a block,
    so few are full unless a key has many rows, and only their keys need to be counted one by one."""
    blocks = 32 * int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = sizes.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(4 * blocks)))
    counts = rows.groupBy("_bucket").count().collect()  # bounded by the number of partitions
    if block is None:
        block = min(max(-(-sum(r["count"] for r in counts) // blocks), LEAST), MOST)
    return rows, [(r["_bucket"],) for r in counts if r["count"] > block], block


def _cuts(sizes: DataFrame, times: DataFrame, keys: Sequence[str], block: int | None) -> DataFrame | None:
    """For the keys with more than a block of rows, the sorted times ``_cuts`` that cut them into about a block each;
    None without such keys.  They are chosen among a sample of the times (as in a range sort) and stored, so that every
    use has the same.  There are as many as blocks at most, so they can be broadcast."""
    rows, full, block = _full_buckets(sizes, keys, block)
    if not full:
        return None
    full = sizes.sparkSession.createDataFrame(full, "_bucket long")
    large = materialize(rows.join(F.broadcast(full), "_bucket").groupBy(*keys).count().where(F.col("count") > block).drop("count"))
    if not large.head(1):
        return None
    share = min(1.0, _DRAWN / block)
    drawn = times.join(F.broadcast(large), list(keys)).where(F.rand(7) < share)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_time"))  # of some rows for each block
    picked = drawn.withColumn("_place", place).where(F.col("_place") % max(1, round(share * block)) == 0)
    return materialize(picked.groupBy(*keys).agg(F.array_sort(F.collect_set("_time")).alias("_cuts")))


def _celled(df: DataFrame, cuts: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """``df`` with the cell ``_cell`` of each row: 2 i + 1 at cut i of its key (from 0), 2 i just before it; null for
    keys without cuts.  ``most``: the most cuts of a key."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])
    earlier = F.aggregate(steps, F.lit(0), lambda n, s: F.when(F.get("_cuts", n + s - 1) < F.col("_time"), n + s).otherwise(n))
    out = df.join(F.broadcast(cuts), list(keys), "left").withColumn("_earlier", F.when(F.col("_cuts").isNotNull(), earlier))
    at = F.coalesce(F.get("_cuts", F.col("_earlier")) == F.col("_time"), F.lit(False))
    return out.withColumn("_cell", 2 * F.col("_earlier") + at.cast("int")).drop("_cuts", "_earlier")


def _taken_over(known: DataFrame, cuts: DataFrame, keys: Sequence[str], row: Column, strict: bool) -> DataFrame:
    """Per cell the last right row before it, and of a cell at a cut, all of whose rows have one time, the last up to
    it (``strict``: before it)."""
    best = known.where("_cell is not null").groupBy(*keys, "_cell").agg(F.max(row).alias("_best"))
    cells = cuts.select(*keys, F.explode(F.sequence(F.lit(0), 2 * F.size("_cuts"))).alias("_cell")).join(best, [*keys, "_cell"], "left")
    cell = Window.partitionBy(*keys).orderBy("_cell")  # one row per cell
    last = lambda end: F.last("_best", ignorenulls=True).over(cell.rowsBetween(Window.unboundedPreceding, end))
    return cells.select(*keys, "_cell", (last(-1) if strict else F.when(F.col("_cell") % 2 == 1, last(0)).otherwise(last(-1))).alias("_over"))


def as_of_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, values: Sequence[str],
               strict: bool = False, tolerance: Column | None = None, out_time: str | None = None, block: int | None = None,
               sizes: DataFrame | None = None) -> DataFrame:
    """All rows of ``left`` with the ``values`` of the matching right row (null
    without one), and its time as ``out_time`` if that is given.

    The match is the right row of the same ``on`` columns with the largest
    ``right_time`` that is not after ``left_time`` (``strict``: before it); of
    right rows with equal times, the one with the largest values in the given
    order.  ``tolerance``: an interval (or, for number times, a number) beyond
    which an older row does not count.  Null keys and times match nothing; a null
    value is a value.

    Keys with more than ``block`` rows are cut by time.  They are found in both
    sides, or, if those are dear to read, in ``sizes``: rows that have the ``on``
    columns about as often.  Only how rows are spread depends on it.
    """
    clash = {c.lower() for c in left.columns} & {c.lower() for c in (*values, *([out_time] if out_time else []))}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    keys = [f"_on{i}" for i in range(len(on))] or ["_on0"]
    by = lambda df: [F.col(c).alias(k) for c, k in zip(on, keys)] or [F.lit(0).alias("_on0")]
    asked = left.select(*by(left), F.col(left_time).alias("_time"), *[F.col(c).alias(f"_l{i}") for i, c in enumerate(left.columns)])
    known = right.select(*by(right), F.col(right_time).alias("_time"), F.col(right_time).alias("_at"),
                         *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)])
    known = known.where(" and ".join(f"{c} is not null" for c in (*keys, "_time")))
    times = asked.select(*keys, "_time").unionByName(known.select(*keys, "_time"))
    # what a key or time column holds already is not carried twice
    mine = {c: f"_l{i}" for i, c in enumerate(left.columns)}
    for c, k in (*zip(on, keys), (left_time, "_time")):
        if c in mine and times.schema[k].dataType == left.schema[c].dataType:
            asked, mine[c] = asked.drop(mine[c]), k
    at = "_at"
    if times.schema["_time"].dataType == known.schema["_at"].dataType:
        known, at = known.drop("_at"), "_time"
    row = F.struct(F.col(at).alias("time"), *[F.col(f"_v{i}").alias(f"v{i}") for i in range(len(values))])

    has_key = " and ".join(f"{k} is not null" for k in keys)
    cuts = _cuts((times if sizes is None else sizes.select(*by(sizes))).where(has_key), times.where(f"{has_key} and _time is not null"), keys, block)
    # rows that no right row of their group can match are spread
    alone, group = F.expr(f"not ({has_key} and _time is not null)"), [*keys, "_spread"]
    if cuts is not None:
        most = cuts.agg(F.max(F.size("_cuts"))).first()[0] or 0
        asked, known = _celled(asked, cuts, keys, most), _celled(known, cuts, keys, most)
        over = _taken_over(known, cuts, keys, row, strict)
        at_cut = F.coalesce(F.col("_cell") % 2 == 1, F.lit(False))
        known, alone, group = known.where(~at_cut), alone | at_cut, [*group, "_cell"]
    hashed = [f.name for f in asked.schema if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)]
    asked = asked.withColumn("_spread", F.when(alone, F.pmod(F.xxhash64(*hashed), F.lit(_SPREAD))).otherwise(F.lit(0)).cast("int"))
    known = known.withColumns({"_spread": F.lit(0), "_is_right": F.lit(True)})
    # dealt out before the right rows are gathered into a column, which would be carried beside them
    both = asked.unionByName(known, allowMissingColumns=True).repartition(*group).withColumn("_right", F.when(F.col("_is_right"), row))
    of_time = F.col("_right").asc_nulls_first() if strict else F.col("_right").asc_nulls_last()
    upto = Window.partitionBy(*group).orderBy(F.col("_time").asc_nulls_first(), of_time).rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("_known", F.last("_right", ignorenulls=True).over(upto)).where(F.col("_right").isNull())
    if cuts is not None:
        out = out.join(F.broadcast(over), [*keys, "_cell"], "left").withColumn("_known", F.coalesce("_known", "_over"))
    usable = F.col("_known").isNotNull()
    if tolerance is not None:
        usable = usable & (F.col("_known.time") >= F.col("_time") - tolerance)
    found = [F.when(usable, F.col(f"_known.v{i}")).alias(v) for i, v in enumerate(values)]
    if out_time:
        found.append(F.when(usable, F.col("_known.time")).alias(out_time))
    return out.select(*[F.col(m).alias(c) for c, m in mine.items()], *found)
