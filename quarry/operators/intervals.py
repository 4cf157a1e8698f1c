"""Interval joins: pairs of rows whose half-open intervals [start, end) overlap.

The time axis is cut into bins, several widths at once: an interval belongs to the
narrowest width (a power of four) that is not below its length, so it touches two
bins at most.  Two intervals meet at the wider one's width, in the bin where the
later of their starts lies; every pair is found there and nowhere else.  An
interval is copied once or twice for each wider width that the other side really
uses (measured), so short and long intervals mix without long ones being cut into
many pieces.

The join is an equi-join on (keys, width, bin).  Bins with very many rows are
split into a grid: each side's rows are dealt into chunks, and each pair of chunks
is joined on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.joins import grid_join
from quarry.session import materialize

#: rows of one side of a bin beyond which it is split
DENSE = 200_000


def _axis(df: DataFrame, name: str) -> Column:
    """A time as a whole number, in the order of the axis and free of time zones."""
    kind = df.schema[name].dataType.simpleString()
    c = F.col(name)
    if kind == "timestamp":
        return F.unix_micros(c)
    if kind == "timestamp_ntz":
        seconds = F.hour(c) * 3600 + F.minute(c) * 60 + F.extract(F.lit("SECOND"), c)
        return F.unix_date(c.cast("date")).cast("long") * 86_400_000_000 + (seconds * 1_000_000).cast("long")
    if kind == "date":
        return F.unix_date(c).cast("long")
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return c.cast("long")
    raise TypeError(f"{name}: interval bounds are dates, timestamps or whole numbers, not {kind}")


def _placed(df: DataFrame, span: tuple[str, str], on: Sequence[str], side: str) -> DataFrame:
    rows = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(on)], _axis(df, span[0]).alias(f"_s{side}"),
                     _axis(df, span[1]).alias(f"_e{side}"), F.struct(*[F.col(c) for c in df.columns]).alias(f"_{side}"))
    rows = rows.where(" and ".join([f"_s{side} < _e{side}", *[f"_k{i} is not null" for i in range(len(on))]]))
    # bits of the length, rounded up to an even number: 4^n is not below it
    bits = F.length(F.bin(F.col(f"_e{side}") - F.col(f"_s{side}") - 1))
    return rows.withColumn(f"_w{side}", F.when(F.col(f"_e{side}") - F.col(f"_s{side}") == 1, 0)
                           .otherwise(F.floor((bits + 1) / 2) * 2).cast("int"))


def _copied(rows: DataFrame, side: str, others: list[int]) -> DataFrame:
    """A copy for each width at which the row may meet one of the other side, and each bin it touches there."""
    own = F.col(f"_w{side}")
    widths = F.array_union(F.array(own), F.filter(F.array(*[F.lit(w) for w in others]).cast("array<int>"), lambda w: w > own))
    wide = rows.withColumn("_w", F.explode(widths))
    first, last = (F.expr(f"shiftright({x}, _w)") for x in (f"_s{side}", f"_e{side} - 1"))
    return wide.withColumn("_bin", F.explode(F.sequence(first, last)))


def overlap_join(left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str], on: Sequence[str] = (),
                 dense: int = DENSE) -> DataFrame:
    """``left`` and ``right`` as struct columns, one row for each pair that agrees in
    ``on`` and whose intervals overlap.

    Bounds are dates, timestamps or whole numbers, of the same kind on both sides.
    An interval that is empty or has a null bound overlaps nothing; null keys match
    nothing; repeated rows give repeated pairs.
    """
    kinds = {str(df.schema[c].dataType) for df, span in ((left, left_span), (right, right_span)) for c in span}
    if len(kinds) > 1 and not all("Long" in k or "Int" in k or "Short" in k or "Byte" in k for k in kinds):
        raise TypeError(f"bounds of different kinds: {sorted(kinds)}")
    # written once, as widths, bins and the join read them; a number tells equal rows apart when a bin is split
    a, b = (materialize(_placed(df, span, on, side).withColumn(f"_n{side}", F.monotonically_increasing_id()))
            for df, span, side in ((left, left_span, "l"), (right, right_span, "r")))
    # the widths in use, 32 a side at most
    used = {side: sorted(r[0] for r in rows.select(f"_w{side}").distinct().collect()) for side, rows in (("l", a), ("r", b))}
    a, b = _copied(a, "l", used["r"]), _copied(b, "r", used["l"])
    spot = [*[f"_k{i}" for i in range(len(on))], "_w", "_bin"]
    pairs = grid_join(a, b, spot, dense)
    here = (F.greatest("_wl", "_wr") == F.col("_w")) & (F.expr("shiftright(greatest(_sl, _sr), _w)") == F.col("_bin"))
    return pairs.where(here & (F.col("_sl") < F.col("_er")) & (F.col("_sr") < F.col("_el"))).select(
        F.col("_l").alias("left"), F.col("_r").alias("right"))
