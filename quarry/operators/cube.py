"""Cube, rollup and grouping sets with sums and distinct counts.

The rows are first reduced to one for each (finest group, counted value), with
their sums; only that table is copied for the grouping sets, not the input, and a
group's distinct count is the number of its rows after a second reduction to
(group, value).  Both reductions are partial before their shuffles, so a group or
value that holds most of the rows collapses in each task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cube_sets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    """All subsets, the whole first."""
    return [s for n in range(len(dimensions), -1, -1) for s in combinations(dimensions, n)]


def rollup_sets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    """All beginnings, the whole first."""
    return [tuple(dimensions[:n]) for n in range(len(dimensions), -1, -1)]


def grouped_sets(df: DataFrame, dimensions: Sequence[str], sets: Sequence[Sequence[str]], sums: Mapping[str, Column],
                 distinct: str, out: str = "n_distinct", level: str = "grouping_id") -> DataFrame:
    """The dimensions (null where a set leaves one out), ``level`` (a bit for each
    dimension left out, the last one lowest, as ``grouping_id``), the ``sums`` and
    ``out``, the number of distinct non-null values of ``distinct``.

    Sums should be of whole numbers or decimals, so that their order does not
    matter.  A null in a dimension is a value of its own; an empty input gives no
    rows, not even the grand total's.
    """
    unknown = {c for s in sets for c in s} - set(dimensions)
    if unknown:
        raise ValueError(f"not among the dimensions: {sorted(unknown)}")
    fine = df.groupBy(*dimensions, F.col(distinct).alias("_value")).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(n) for n, c in sums.items()])
    number = {s: sum(1 << i for i, c in enumerate(reversed(dimensions)) if c not in s) for s in map(frozenset, sets)}
    copies = F.array(*[F.struct(F.lit(n).alias(level), *[(F.col(c) if c in s else F.lit(None).cast(df.schema[c].dataType)).alias(c)
                                                       for c in dimensions]) for s, n in number.items()])
    wide = fine.select(F.inline(copies), "_value", *sums)
    once = wide.groupBy(level, *dimensions, "_value").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(n).alias(n) for n in sums])
    return once.groupBy(level, *dimensions).agg(F.count("_value").alias(out), *[F.sum(n).alias(n) for n in sums]) \
        .select(*dimensions, level, *sums, out)
