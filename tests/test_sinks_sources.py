import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quarry.sinks import write_delimited, write_kv_text
from quarry.sources import read_csv, read_delimited, schema_report, table


def read_parts(path):
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    return "".join(open(os.path.join(path, p), encoding="utf-8").read() for p in parts).splitlines()


def test_kv_text_sorted_and_refuses_existing(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "k string, v int")
    out = str(tmp_path / "kv")
    write_kv_text(df.repartition(3), "k", F.format_string("n=%d", "v"), out)
    assert read_parts(out) == ["a\tn=1", "b\tn=2", "c\tn=3"]
    with pytest.raises(AnalysisException):
        write_kv_text(df, "k", F.col("v").cast("string"), out)
    write_kv_text(df, "k", F.col("v").cast("string"), out, mode="overwrite")
    assert read_parts(out) == ["a\t1", "b\t2", "c\t3"]


def test_delimited_round_trip_without_quoting(spark, tmp_path):
    df = spark.createDataFrame([("1", 'say "hi"', None), ("2", "a;b", "x")], "id string, w string, z string")
    out = str(tmp_path / "d")
    write_delimited(df.coalesce(1), out, sep=",")
    assert sorted(read_parts(out)) == ['1,say "hi",', "2,a;b,x"]
    back = read_delimited(spark, out, columns=("id", "w", "z"), sep=",").orderBy("id").collect()
    assert [tuple(r) for r in back] == [("1", 'say "hi"', None), ("2", "a;b", "x")]


def test_csv_inference_and_schema_report(spark, tmp_path):
    p = tmp_path / "Orders.csv"
    p.write_text("Order_ID;Qty;Price\no1;3;2.5\no2;4;1.0\n", encoding="utf-8")
    inferred = read_csv(spark, str(p), infer=True)
    explicit = read_csv(spark, str(p), schema="Order_ID string, Qty string, Price string")
    rep = {(r.table_name, r.column_name): r.data_type for r in
           schema_report(spark, {"orders": inferred, "orders_text": explicit}).collect()}
    assert rep[("orders", "Qty")] == "int" and rep[("orders", "Price")] == "double"
    assert rep[("orders_text", "Qty")] == "string"


def test_schema_report_of_test_tables(spark):
    sf = "/root/testdata/sf0.001"
    names = ["region", "nation", "customer", "orders", "lineitem", "embeddings"]
    rep = schema_report(spark, {n: table(spark, sf, n) for n in names})
    got = {(r.table_name, r.column_name): r.data_type for r in rep.collect()}
    assert got[("orders", "o_orderdate")] == "timestamp_ntz"
    assert got[("embeddings", "embedding")] == "array<float>"
    assert rep.where("table_name = 'lineitem'").count() == 11
