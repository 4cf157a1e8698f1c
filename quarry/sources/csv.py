"""Headered CSV tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path, sep: str = ";", schema: T.StructType | str | None = None,
             infer: bool = False, sampling_ratio: float = 1.0) -> DataFrame:
    """Explicit schema by default.  ``infer=True`` reproduces header+inferSchema
    reading; inference is an extra pass over the data (``sampling_ratio`` < 1
    bounds it on large inputs)."""
    reader = spark.read.option("header", "true").option("sep", sep)
    if schema is not None:
        return reader.schema(schema).csv(path)
    if infer:
        reader = reader.option("inferSchema", "true").option("samplingRatio", str(sampling_ratio))
    return reader.csv(path)
