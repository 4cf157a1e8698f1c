"""Types inferred in one pass, against Spark's own inference and by hand."""
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources.csv import read_csv
from quarry.sources.infer import infer_schema, kind_of, merged_type, read_inferred


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def test_files_of_different_columns(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.csv", 'id;name;price;day\n1;"x;y ""q""";2;2024-01-05\n2;;3.5;\n\n')
    put(folder, "b.csv", 'price;id;flag;day\n7;3000000000;true;2024-01-06 10:30:00\n-1e2;4;;2024-01-07\n')
    put(folder, "c.csv", "id;empty\n")
    df = read_inferred(spark, str(folder))
    assert [(f.name, f.dataType) for f in df.schema] == [
        ("id", T.LongType()), ("name", T.StringType()), ("price", T.DoubleType()), ("day", T.TimestampType()), ("flag", T.BooleanType()),
        ("empty", T.StringType())]
    assert sorted(map(tuple, df.collect())) == [
        (1, 'x;y "q"', 2.0, dt.datetime(2024, 1, 5), None, None), (2, None, 3.5, None, None, None),
        (4, None, -100.0, dt.datetime(2024, 1, 7), None, None), (3_000_000_000, None, 7.0, dt.datetime(2024, 1, 6, 10, 30), True, None)]


def test_one_scan_equals_sparks_own_inference(spark, tmp_path):
    path = str(tmp_path / "orders")
    spark.read.parquet("/root/testdata/sf0.001/orders.parquet").repartition(3).write.option("header", "true").option("sep", ";").csv(path)
    mine, own = read_inferred(spark, path), read_csv(spark, path, infer=True)
    assert [(f.name, f.dataType.simpleString().replace("_ntz", "")) for f in mine.schema] == [
        (f.name, f.dataType.simpleString().replace("_ntz", "")) for f in own.schema]
    assert sorted(map(str, mine.collect())) == sorted(map(str, own.collect()))


def test_headers_that_look_like_values(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "2023;true;2024-01-01\n1;x;2.5\n2;y;3\n")
    schema, headers = infer_schema(spark, str(tmp_path / "in"))
    assert [(f.name, f.dataType) for f in schema] == [("2023", T.IntegerType()), ("true", T.StringType()), ("2024-01-01", T.DoubleType())]
    put(tmp_path / "twice", "a.csv", "a;a\n1;2\n")
    with pytest.raises(ValueError):
        infer_schema(spark, str(tmp_path / "twice"))
    put(tmp_path / "none", "a.csv", "\n")
    assert read_inferred(spark, str(tmp_path / "none")).count() == 0


def test_kinds_and_lattice(spark):
    cells = {"": None, "12": "int", "-2147483648": "int", "2147483648": "long", "1.": "double", ".5": "double", "1e400x": "string", "NaN": "double",
             "TRUE": "boolean", "2024-02-30": "string", "2024-02-29": "date", "2024-02-29 25:00": "string", "2024-02-29T23:00:01.5": "timestamp",
             " 1": "string", "9" * 19: "double"}
    rows = spark.createDataFrame([(c,) for c in cells], "c string").select("c", kind_of(F.col("c")).alias("k")).collect()
    assert {r.c: r.k for r in rows} == cells
    assert merged_type({"int", "date"}) == T.StringType() and merged_type(set()) == T.StringType()
    assert merged_type({"date", "timestamp"}) == T.TimestampType() and merged_type({"long"}) == T.LongType()
