"""Schema report: the printSchema of several tables as one DataFrame."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("position", T.IntegerType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("data_type", T.StringType(), False),
    T.StructField("nullable", T.BooleanType(), False),
])


def schema_report(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, position, column_name, data_type, nullable), top-level fields.
    Built from the plans' resolved schemas (metadata only, no data pass)."""
    rows = [(name, i + 1, f.name, f.dataType.simpleString(), f.nullable)
            for name, df in tables.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, REPORT_SCHEMA)
