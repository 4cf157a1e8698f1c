"""Statistics that are kept and merged instead of computed anew.

``summarise`` reduces rows to one state for each group (say, a day and a kind);
``merge`` joins states of any groups into those of coarser ones (all days of a
month, or two stores).  Merging is associative and commutative, so states may come
from any number of refreshes.  Counts, sums, sums of squares and extremes are
exact (decimals); distinct values and quantiles are sketches, whose errors are
stated below.  ``refresh`` keeps the states of a folder of files and reads only
files that it has not read before.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sinks.versions import current, publish, versions

#: layout of a state; states of another layout are refused
VERSION = 1
#: 2^12 registers: a relative standard error of 1.04 / 2^6 = 1.6 % for distinct counts
HLL_BITS = 12
#: KLL's k: a quantile's rank is off by less than 1.65 % of the rows (99 % of the time)
KLL_K = 200


def summarise(df: DataFrame, by: Sequence[str | Column], value: str, distinct: str | None = None, scale: int = 2) -> DataFrame:
    """``by`` and a state: state_version, n (values that are not null), total,
    squares, low, high, quantiles and, with ``distinct``, n_rows' distinct values as
    ``ids``.  Values count rounded to ``scale`` decimals."""
    exact = F.col(value).cast(f"decimal(18,{scale})")
    values = [F.count(value).alias("n"), F.sum(exact).cast(f"decimal(38,{scale})").alias("total"),
              F.sum(exact * exact).cast(f"decimal(38,{2 * scale})").alias("squares"), F.min(exact).alias("low"), F.max(exact).alias("high"),
              F.kll_sketch_agg_double(exact.cast("double"), F.lit(KLL_K)).alias("quantiles")]
    if distinct is not None:
        values.append(F.hll_sketch_agg(distinct, F.lit(HLL_BITS)).alias("ids"))
    return df.groupBy(*by).agg(F.lit(VERSION).alias("state_version"), *values)


def merge(states: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """The states of the groups ``by``, from states of finer or equal groups."""
    kinds = dict(states.dtypes)
    mine = F.when(F.col("state_version") == VERSION, F.col("n")).otherwise(
        F.raise_error(F.format_string("a state of version %d", "state_version")).cast("long"))
    values = [F.sum(mine).alias("n"), F.sum("total").cast(kinds["total"]).alias("total"), F.sum("squares").cast(kinds["squares"]).alias("squares"),
              F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("quantiles").alias("quantiles")]
    if "ids" in kinds:
        values.append(F.hll_union_agg("ids").alias("ids"))
    return states.groupBy(*by).agg(F.lit(VERSION).alias("state_version"), *values)


def finished(states: DataFrame, quantiles: Mapping[str, float] | None = None) -> DataFrame:
    """The groups with n, total, mean, stddev (of a sample), low, high, approx_distinct and the named quantiles."""
    state = {"state_version", "n", "total", "squares", "low", "high", "quantiles", "ids"}
    n, total = F.col("n").cast("double"), F.col("total").cast("double")
    out = [F.col("n"), F.col("total"), F.try_divide(total, n).alias("mean"),
           F.when(F.col("n") > 1, F.sqrt(F.greatest((F.col("squares").cast("double") - total * total / n) / (n - 1), F.lit(0.0)))).alias("stddev"),
           F.col("low"), F.col("high")]
    if "ids" in states.columns:
        out.append(F.hll_sketch_estimate("ids").alias("approx_distinct"))
    for name, q in (quantiles or {}).items():
        out.append(F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(q)))).alias(name))
    return states.select(*[c for c in states.columns if c not in state], *out)


def refresh(spark: SparkSession, source: str, store: str, state_of: Callable[[DataFrame], DataFrame], by: Sequence[str]) -> int:
    """Bring the states in ``store`` up to date with the Parquet files of ``source``;
    returns how many files were read.

    ``state_of`` gives the states of some of the rows (a ``summarise`` call), ``by``
    names their groups.  Files are known by their paths: they may be added, not
    changed.  The new states and the list of files become visible together, so a
    refresh that fails, or runs twice, counts nothing twice.
    """
    whole = spark.read.parquet(source)
    known = set()
    if versions(spark, store):
        known = {r[0] for r in spark.read.parquet(f"{current(spark, store)}/files").collect()}  # as many as the driver lists anyway
    new = sorted(set(whole.inputFiles()) - known)
    if not new:
        return 0
    states = state_of(spark.read.schema(whole.schema).parquet(*new))
    if known:
        states = merge(states.unionByName(spark.read.parquet(f"{current(spark, store)}/states")), by)

    def write(folder: str) -> None:
        states.write.parquet(f"{folder}/states")
        spark.createDataFrame([(f,) for f in sorted(known | set(new))], "path string").write.parquet(f"{folder}/files")

    publish(spark, store, write)
    return len(new)


def states(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(f"{current(spark, store)}/states")
