import duckdb
import pytest

from quarry.llm import licenses, queries


def shown(df):
    return sorted(map(tuple, df.collect()), key=str)


def by_sql(documents):
    con = duckdb.connect()
    con.register("documents", documents)
    return sorted(con.execute(queries.ORACLE_SQL["op6_licenses"]).fetchall(), key=str)


def test_texts_against_sql(rows):
    texts = [None, "", "  ", "CC BY", "x CC-BY nc. cc by", "all rights reserved all rights reserved",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
             "permission is hereby granted free of charge. " + "q " * 50 + "obtaining a copy of this software",
             "obtaining a copy of this software permission is hereby granted free of charge", "General Public License",
             "general public licens\u212a general public \u212aicense", "ALL RIGHTS RESERVED\u00e9 all rights",
             "redistribution and use in source and binary forms are permitted provided that", "all all rights reserved reserved",
             "\x00cc\x00by\x7f", "lesser general public license", "provided as is. Without warranty of any kind", "cc", "cc cc by by",
             "word " * 20_000 + "cc by"]
    data = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "cc by", "y"), (3, "CC BY", "z")]
    docs = rows(data, "doc_id long, text string, labels string")
    assert shown(licenses.scan(docs)) == by_sql(docs.toArrow())
    assert licenses.scan(docs.limit(0)).count() == 0


def test_odd_documents(odd_documents):
    assert shown(licenses.scan(odd_documents)) == by_sql(odd_documents.toArrow())


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    got = shown(queries.op6_licenses(spark, sf))
    assert got == sorted(con.execute(queries.ORACLE_SQL["op6_licenses"]).fetchall(), key=str)
    assert {r[5] for r in got} >= {"", "gpl", "reserved", "cc-by"}


def test_plan_is_native(spark):
    df = licenses.scan(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_templates_have_one_or_two_phrases():
    with pytest.raises(ValueError):
        licenses.phrases({"x": "[a] [b] [c]"})
    assert [k for k in licenses.phrases({"y": "one [two three] four [five]"}) if k[0] == "y"] == [
        ("y", 0, 1, ["two", "three"]), ("y", 1, 4, ["five"])]
