"""Similarity join of strings by edit distance.

Two strings within k edits of each other differ in at most k q of their q-grams.
So if each has more than k q, and all grams are ordered by how rare they are, the
first k q + 1 grams of both share one (the second "an" of a string counts as
another gram than its first): only these are joined, together with the length, which
may differ by k.
Shorter strings, which have too few grams, are joined on what is left after up to
k deletions.  All candidates are checked by their exact distance.

For a single edit, strings of less than ``PLAIN`` characters need no grams, which
are all frequent in numbered names: strings with one character replaced agree in
its place and in all that stands before and after it, and one with a character
more is the other after one deletion.  So there are no candidates but the pairs.

Equal strings are one row, however often they stand.  Crowded grams are split
(``joins.grid_join``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.joins import grid_join

#: rows of a gram and length beyond which they are split
DENSE = 50_000
#: characters from which grams are used for a single edit, too
PLAIN = 64


def _grams(strings: DataFrame, q: int) -> DataFrame:
    """s, n, gram, nth: the gram's number among equal grams of the string tells them apart."""
    at = F.explode(F.sequence(F.lit(1), F.col("n") - (q - 1)))
    rows = strings.select("s", "n", at.alias("at")).withColumn("gram", F.expr(f"substring(s, at, {q})"))
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy("s", "gram").orderBy("at")))


def _prefixes(grams: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """Each string's ``size`` rarest grams."""
    ranked = grams.join(counts, ["gram", "nth"]).withColumn(
        "_r", F.row_number().over(Window.partitionBy("s").orderBy("count", "gram", "nth")))
    return ranked.where(F.col("_r") <= size).select("s", "n", "gram", "nth")


def _less(distance: int) -> Column:
    """All strings that ``distance`` deletions at most leave of ``s``."""
    left = F.array(F.col("s"))
    for _ in range(distance):
        shorter = F.flatten(F.transform(left, lambda t: F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1))),
            lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))))))
        left = F.array_distinct(F.concat(left, shorter))
    return left


def _around(string: str) -> list[Column]:
    """What stands before and after the place ``at``."""
    return [F.expr(f"substring({string}, 1, at - 1)"), F.expr(f"substring({string}, at + 1)")]


def _one_edit(left: DataFrame, right: DataFrame, least: int) -> DataFrame:
    """Pairs (s, t) within one edit, the shorter below ``least`` characters.  Each is found in one way only."""
    small = [df.where(F.col("n") < least) for df in (left, right)]
    same = small[0].select("s").join(small[1].select("s", F.col("s").alias("t")), "s")
    # a string of n characters has n places; the hash only brings rows together.  The rows are small when written and
    # many when joined, so their partitions are not made fewer
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a, b = (df.where("n > 0").withColumn("at", F.explode(F.sequence(F.lit(1), F.col("n"))))
            .select("s", "n", "at", F.xxhash64(*_around("s")).alias("rest")).repartition(parts, "n", "at", "rest") for df in small)
    replaced = a.join(b.withColumnRenamed("s", "t"), ["n", "at", "rest"]).where(F.col("s") != F.col("t"))
    for x, y in zip(_around("s"), _around("t")):
        replaced = replaced.where(x == y)

    def longer(more: DataFrame, less: DataFrame) -> DataFrame:
        """(more, s): strings with one character more than ``s``."""
        # lengths for which there is a shorter one, ``least`` at most
        lengths = F.broadcast(less.select((F.col("n") + 1).alias("n")).distinct())
        gone = F.array_distinct(F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.concat(
            F.substring("s", F.lit(1), i - 1), F.substring("s", i + 1, F.col("n")))))
        rows = more.where(F.col("n").between(1, least)).join(lengths, "n", "left_semi")
        return rows.select(F.col("s").alias("more"), F.explode(gone).alias("s")).join(less.select("s"), "s")

    return same.unionByName(replaced.select("s", "t")).unionByName(
        longer(left, small[1]).select(F.col("more").alias("s"), F.col("s").alias("t"))).unionByName(
        longer(right, small[0]).select("s", F.col("more").alias("t")))


def candidates(left: DataFrame, right: DataFrame, distance: int, q: int = 2, dense: int = DENSE, plain: int = PLAIN) -> DataFrame:
    """Distinct pairs (s, t) of strings that may be within ``distance``; ``left`` and ``right`` have distinct strings ``s``.
    ``plain``: characters from which grams are used for a single edit, without effect on the result."""
    few = distance * q  # grams that the edits may destroy
    sides = [df.select("s", F.length("s").alias("n")) for df in (left, right)]
    least = max(few + q, plain) if distance == 1 else few + q  # characters from which grams are used
    grams = [_grams(df.where(F.col("n") >= least), q) for df in sides]
    counts = grams[0].select("gram", "nth").unionAll(grams[1].select("gram", "nth")).groupBy("gram", "nth").count()
    a, b = (_prefixes(g, counts, few + 1) for g in grams)
    b = b.select(F.col("s").alias("t"), "gram", "nth", F.explode(F.sequence(F.col("n") - distance, F.col("n") + distance)).alias("n"))
    long = grid_join(a, b, ["gram", "nth", "n"], dense).select("s", "t")
    if distance == 1:
        return long.distinct().unionAll(_one_edit(*sides, least))
    # at least one of the two is short, the other no more than ``distance`` longer
    short = [df.where(F.col("n") < few + q + distance).withColumn("less", F.explode(_less(distance))) for df in sides]
    brief = grid_join(short[0].select("s", "less", F.col("n").alias("m")), short[1].select(F.col("s").alias("t"), "less", "n"), ["less"], dense)
    brief = brief.where((F.col("m") < few + q) | (F.col("n") < few + q)).select("s", "t")
    return long.unionAll(brief).distinct()


def similar_strings(left: DataFrame, right: DataFrame, left_col: str, right_col: str, distance: int = 1, q: int = 2,
                    dense: int = DENSE, plain: int = PLAIN) -> DataFrame:
    """left, right, distance: all pairs of distinct strings of the two columns within
    ``distance`` edits (equal ones too, at distance 0).

    Null strings match nothing; the empty string is a string.  Rows are found again
    by joining on the strings.
    """
    if distance < 0 or q < 1:
        raise ValueError("distance is not negative and q at least one")
    a = left.select(F.col(left_col).alias("s")).where("s is not null").distinct()
    b = right.select(F.col(right_col).alias("s")).where("s is not null").distinct()
    pairs = candidates(a, b, distance, q, dense, plain).withColumn("distance", F.levenshtein("s", "t", distance))
    return pairs.where("distance >= 0").select(F.col("s").alias("left"), F.col("t").alias("right"), "distance")
