"""Text sinks.

Ordering: a globally sorted text output is an ``orderBy`` (range-partitioned
sort, no single reducer) followed by a text write; part files come out in
key order, so reading them in name order gives the sorted file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def write_kv_text(df: DataFrame, key: str, value: Column, path: str, mode: str = "errorifexists") -> None:
    """``key<TAB>value`` lines sorted by key; by default fails if ``path`` exists."""
    (df.select(F.col(key).alias("_k"), F.concat_ws("\t", F.col(key), value).alias("value"))
       .orderBy("_k").select("value").write.mode(mode).text(path))


def write_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    """Fields joined by ``sep``, no quoting, null as empty field."""
    (df.write.mode(mode).option("sep", sep).option("quote", "\u0000").option("escape", "\u0000")
       .option("nullValue", "").option("emptyValue", "").option("header", "false").csv(path))


def nested_bag_text(df: DataFrame, group_col: str, bag_col: str, fields: Sequence[str],
                    out: str = "line") -> DataFrame:
    """``group,{(f1,f2,...),(...)}`` -- the text form of a group with its bag
    (a null field prints as an empty field, so every tuple keeps its arity)."""
    def tup(s):
        parts = [F.coalesce(s[f].cast("string"), F.lit("")) for f in fields]
        return F.concat(F.lit("("), F.concat_ws(",", *parts), F.lit(")"))
    return df.select(F.concat(F.coalesce(F.col(group_col).cast("string"), F.lit("")), F.lit(",{"),
                              F.array_join(F.transform(bag_col, tup), ","), F.lit("}")).alias(out))


def report_lines(df: DataFrame, keys: Sequence[Column], line: Column, header: str | None = None,
                 separator: str | None = None, footer: Sequence[Column] | None = None,
                 footer_df: DataFrame | None = None) -> DataFrame:
    """A formatted report as rows (_part, _k0.._kn, _rank, line).

    One data line per row of ``df``, ordered by the ``keys`` expressions
    (ascending; negate a number for descending).  With ``separator``, one
    separator line precedes each new value of the first key: the first row of a
    section (a window over that key, whose rows are few next to the data they
    summarise) carries it, so ``df`` is computed once.  ``header`` is
    the first line; ``footer`` expressions, evaluated on ``footer_df`` (one row,
    e.g. a best-item result), become the last lines in the given order.
    No driver collect and no global window: ``write_lines`` restores the order
    with a distributed sort at write time.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    keyed = df.select(*[k.alias(n) for k, n in zip(keys, names)], line.alias("line"))
    if separator is not None:
        section = Window.partitionBy(names[0]).orderBy(*names[1:]) if names[1:] else Window.partitionBy(names[0]).orderBy(names[0])
        ruled = keyed.withColumn("_first", F.row_number().over(section) == 1)
        lines = F.when(F.col("_first"), F.array(F.struct(F.lit(0).alias("_rank"), F.lit(separator).alias("line")),
                                                F.struct(F.lit(1).alias("_rank"), F.col("line").alias("line")))
                       ).otherwise(F.array(F.struct(F.lit(1).alias("_rank"), F.col("line").alias("line"))))
        data = ruled.select(F.lit(1).alias("_part"), *names, F.inline(lines))
    else:
        data = keyed.select(F.lit(1).alias("_part"), *names, F.lit(1).alias("_rank"), "line")
    parts = [data]
    nulls = [F.lit(None).cast(keyed.schema[n].dataType).alias(n) for n in names]
    if header is not None:
        parts.append(df.sparkSession.range(1).select(F.lit(0).alias("_part"), *nulls, F.lit(0).alias("_rank"),
                                                     F.lit(header).alias("line")))
    if footer:
        src = footer_df if footer_df is not None else df
        lines = src.select(F.posexplode(F.array(*footer)).alias("_rank", "line"))
        parts.append(lines.select(F.lit(2).alias("_part"), *nulls, F.col("_rank").cast("int").alias("_rank"), "line"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ordered(report: DataFrame) -> DataFrame:
    """The report's lines in report order (a distributed sort)."""
    keys = sorted(c for c in report.columns if c.startswith("_k"))
    return report.orderBy("_part", *keys, "_rank").select("line")


def write_lines(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write ``report_lines`` output in order (part files in key order)."""
    ordered(report).write.mode(mode).text(path)


def write_outputs(df: DataFrame, path: str, output_col: str = "output", sep: str = ",", mode: str = "errorifexists") -> None:
    """Several outputs by one job: the rows of each value of ``output_col`` in a folder ``<output_col>=<value>`` of its own,
    as delimited lines.  The rows are dealt by output and value first, so that an output has few files but no single writer."""
    rest = [F.col(c) for c in df.columns if c != output_col]
    dealt = df.repartition(F.col(output_col), F.pmod(F.xxhash64(*rest), F.lit(8)))
    (dealt.write.mode(mode).partitionBy(output_col).option("sep", sep).option("quote", "\u0000").option("escape", "\u0000")
          .option("nullValue", "").option("emptyValue", "").option("header", "false").csv(path))
