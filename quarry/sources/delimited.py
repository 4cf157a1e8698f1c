"""Declared-schema delimited files and word lists.

``read_delimited`` behaves like a LOAD with a declared schema: no quoting,
short rows padded with nulls, extra fields dropped, an empty field is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REVIEW_COLUMNS = ("id", "comment", "dim3", "dim4", "sentiment")


def delimited_options(sep: str) -> dict[str, str]:
    """No quoting, nothing trimmed; shared by files, lines and streams."""
    return {"sep": sep, "quote": "\u0000", "escape": "\u0000", "mode": "PERMISSIVE", "header": "false",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def parse_delimited(lines: DataFrame, columns: Sequence[str] = REVIEW_COLUMNS, sep: str = ";") -> DataFrame:
    """Lines (a ``value`` column) -> the declared columns, as the file reader gives them (blank lines are skipped)."""
    schema = ", ".join(f"{c} string" for c in columns)
    kept = lines.where(F.trim("value") != "")
    return kept.select(F.from_csv("value", schema, delimited_options(sep)).alias("r")).select("r.*")


def read_delimited(spark: SparkSession, paths, columns: Sequence[str] = REVIEW_COLUMNS,
                   sep: str = ";") -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return (spark.read.schema(schema)
            .options(**delimited_options(sep)).option("multiLine", "false")
            .csv(paths))


def read_wordlist(spark: SparkSession, paths, column: str = "stopword") -> DataFrame:
    """One entry per line, as written (no trim, no case change)."""
    return spark.read.text(paths).select(F.col("value").alias(column))
