"""Exact quantiles of groups of any size, by histogram refinement.

A wanted rank is narrowed from round to round: the values between the bounds
found so far are counted in equal bins (partial counts before the shuffle, at
most ``bins`` rows per wanted rank after it), and the smallest and largest
value of the bin that holds the rank are the next bounds.  Once no rank has more
than ``finish`` rows left, its few values are summed one by one.  The bounds of
groups with more than ``finish`` rows, of which there are few, are sent to the rows;
only smaller groups are joined by their keys.  So a group that holds most of the
rows is never sorted, shuffled or gathered in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import materialize

BINS, FINISH = 4096, 1 << 16


def narrowed(inside: DataFrame, by: Sequence[str], bins: int, last: bool) -> DataFrame:
    """One round: ``by``, need, _lo, _hi, _n, _below of the bin that holds each rank.  ``inside`` has the values ``_k``
    between the bounds ``_lo`` and ``_hi`` with their weights ``_w``, ``need``, and the weight ``_below`` the lower bound;
    in the last round every value is a bin of its own."""
    low, high = F.col("_lo").cast("double"), F.col("_hi").cast("double")
    if dict(inside.dtypes)["_k"] in ("double", "float"):  # halves, so that the difference stays finite
        # bounds next to each other have no number between them
        share = F.when(high / 2 == low / 2, (F.col("_k") > low).cast("double")) \
            .otherwise((F.col("_k") / 2 - low / 2) / F.nullif(high / 2 - low / 2, F.lit(0.0)))
    else:
        share = (F.col("_k") - F.col("_lo")).cast("double") / F.nullif((F.col("_hi") - F.col("_lo")).cast("double"), F.lit(0.0))
    cell = F.col("_k") if last else F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1))
    cells = inside.groupBy(*by, "need", "_below", cell.alias("_cell")).agg(
        F.sum("_w").alias("_w"), F.min("_k").alias("_lo"), F.max("_k").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*by, "need").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("_upto", F.col("_below") + F.sum("_w").over(upto))
    return cells.where((F.col("_upto") >= F.col("need")) & (F.col("_upto") - F.col("_w") < F.col("need"))) \
        .withColumn("_below", F.col("_upto") - F.col("_w"))


def locate(rows: DataFrame, by: Sequence[str], key: str, weight: Column | None, wanted: DataFrame,
           bins: int = BINS, finish: int = FINISH) -> DataFrame:
    """For each row of ``wanted`` (``by`` columns and ``need``): ``value``, the
    smallest ``key`` of the group up to which the weights add up to ``need``, and
    ``below``, the weight of all smaller keys.

    Keys must not be null; integer keys must stay within +-2^62.  Weights are
    integers (default: one a row).  A group without rows, and a ``need`` beyond
    the group's weight, give no row.
    """
    names, by = list(by), [f"_g{i}" for i in range(len(by))]
    rows = rows.select(*[F.col(c).alias(g) for c, g in zip(names, by)], F.lit(0).alias("_one"), F.col(key).alias("_k"),
                       (F.lit(1) if weight is None else weight).cast("long").alias("_w"))
    # null groups meet each other; the constant keeps the joins equi-joins without a group
    mine = [f"_s{i}" for i in range(len(by))]
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(m)) for g, m in zip(by, mine)], F.col("_one") == F.col("_same"))
    spans = rows.groupBy(*by, "_one").agg(F.min("_k").alias("_lo"), F.max("_k").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    wanted = wanted.select(*[F.col(c).alias(m) for c, m in zip(names, mine)], F.lit(0).alias("_same"),
                           F.col("need").cast("long").alias("need")).distinct()
    columns = [*mine, "_same", "need", "_lo", "_hi", "_n", "_below"]
    state = materialize(wanted.join(spans, same).withColumn("_below", F.lit(0).cast("long")).select(columns))

    def settled(rows: DataFrame, state: DataFrame, send: bool) -> DataFrame:
        while (most := state.where("_lo < _hi").agg(F.max("_n")).first()[0]) is not None:
            bounds = state.where("_lo < _hi")
            inside = rows.join(F.broadcast(bounds) if send else bounds, same & F.col("_k").between(F.col("_lo"), F.col("_hi")))
            found = narrowed(inside, [*mine, "_same"], bins, most <= finish)
            state = materialize(state.where("_lo = _hi").select(columns).unionByName(found.select(columns)))
        return state

    large = state.where(F.col("_n") > finish)  # of n rows, n / finish groups at most
    others = rows.join(F.broadcast(large.select(*mine, "_same").distinct()), same, "left_anti")
    state = settled(rows, large, True).unionByName(settled(others, state.where(F.col("_n") <= finish), False))
    return state.select(*[F.col(m).alias(c) for m, c in zip(mine, names)], "need", F.col("_lo").alias("value"),
                        F.col("_below").alias("below"))


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, fractions: Mapping[str, float],
                    bins: int = BINS, finish: int = FINISH) -> DataFrame:
    """``by`` and one column per entry of ``fractions`` (name -> share): the
    discrete quantile, the smallest value with at least that share of the group's
    values at or below it.

    Null values do not count (a group with nothing else has null quantiles); NaN
    is larger than all other values; a null group is a group.
    """
    if not all(0 <= q <= 1 for q in fractions.values()):
        raise ValueError("fractions lie between 0 and 1")
    by = list(by)
    kind = df.schema[value].dataType.simpleString()
    if kind in ("float", "double"):
        # NaN has no place in bins: it is counted apart, above all numbers
        known = df.where(F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf")))
        odd = df.where(F.isnan(value) | (F.abs(value) == float("inf")))
    else:
        known, odd = df.where(F.col(value).isNotNull()), None
    counts = df.groupBy(*by).agg(F.count(value).alias("_all"), *([] if odd is None else [
        F.count_if(F.col(value) == float("-inf")).alias("_low"), F.count_if(F.isnan(value)).alias("_nan"),
        F.count_if((F.col(value) == float("inf"))).alias("_high")]))
    if odd is None:
        counts = counts.select(*by, "_all", *[F.lit(0).alias(c) for c in ("_low", "_nan", "_high")])
    counts = materialize(counts)
    # the same rounding as n - floor(n - q n): exact shares give exact ranks
    ranks = {name: F.greatest(F.lit(1), F.col("_all") - F.floor(F.col("_all") - F.col("_all") * F.lit(float(q)))).cast("long")
             for name, q in fractions.items()}
    numbers = F.col("_all") - F.col("_low") - F.col("_nan") - F.col("_high")
    asked = counts.select(*by, "_low", numbers.alias("_numbers"), F.explode(F.array(*ranks.values())).alias("_rank")) \
        .select(*by, (F.col("_rank") - F.col("_low")).alias("need"), "_numbers").where("need between 1 and _numbers").drop("_numbers")
    found = locate(known, by, value, None, asked, bins, finish)
    out = counts
    for name, rank in ranks.items():
        need = rank - F.col("_low")
        right = found.select(*[F.col(c).alias(f"_{i}_{name}") for i, c in enumerate(by)], F.col("need").alias(f"_need_{name}"),
                             F.col("value").alias(f"_value_{name}"))
        on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{i}_{name}")) for i, c in enumerate(by)],
                    need == F.col(f"_need_{name}"))
        out = out.join(right, on, "left")
        if odd is not None:
            special = F.when(rank <= F.col("_low"), float("-inf")).when(need <= numbers, F.col(f"_value_{name}")) \
                .when(need <= numbers + F.col("_high"), float("inf")).when(F.col("_all") > 0, float("nan"))
        else:
            special = F.col(f"_value_{name}")
        out = out.withColumn(name, special.cast(kind)).drop(*[f"_{i}_{name}" for i in range(len(by))], f"_need_{name}", f"_value_{name}")
    return out.select(*by, *fractions)
