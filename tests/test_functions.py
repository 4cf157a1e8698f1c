import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quarry.functions import (
    bucketize,
    epoch_year,
    field,
    java_trim,
    middle_join,
    split_fields,
    strict_number,
    to_timestamp_any,
    tokenize,
    try_number,
)
from quarry.functions.text import explode_tokens


def one(spark, col, value="x", schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first().r


@pytest.mark.parametrize("line,java,python", [
    ("1,T,", ["1", "T"], ["1", "T", ""]),
    ("a,,b", ["a", "", "b"], ["a", "", "b"]),
    ("", [""], [""]),
    (",,", [], ["", "", ""]),
    (",a", ["", "a"], ["", "a"]),
])
def test_split_dialects(spark, line, java, python):
    assert one(spark, split_fields("v", ",", drop_trailing_empty=True), line) == java
    assert one(spark, split_fields("v", ",", drop_trailing_empty=False), line) == python


def test_field_access_and_trim(spark):
    parts = split_fields("v", ",")
    assert one(spark, field(parts, 1, trim=True), "1, \tToy Story ,x") == "Toy Story"
    assert one(spark, field(parts, 5), "1,2") is None
    assert one(spark, java_trim(F.col("v")), "\t a b \r") == "a b"


def test_middle_join_keeps_commas(spark):
    assert one(spark, middle_join(split_fields("v", ",")), "7,Crouching Tiger, Hidden Dragon (2000),Action") \
        == "Crouching Tiger, Hidden Dragon (2000)"
    assert one(spark, middle_join(split_fields("v", ",")), "7,Action") == ""


def test_numbers(spark):
    assert one(spark, try_number("v"), " 4.5 ") == 4.5
    assert one(spark, try_number("v"), "abc") is None
    assert one(spark, try_number("v", "int"), "4.5") is None
    with pytest.raises(PySparkException):
        one(spark, strict_number("v", what="rating"), "abc")


def test_epoch_year(spark):
    assert one(spark, epoch_year("v"), "1577836800") == 2020
    assert one(spark, epoch_year("v"), "1577836799") == 2019
    assert one(spark, epoch_year("v"), "-1") == 1969
    assert one(spark, epoch_year("v"), "abc") is None
    assert one(spark, epoch_year("v"), "99999999999999") is None


def test_timestamps(spark):
    df = spark.createDataFrame([("2024-03-01 10:30",), ("2024-03-01 10:30:15",), ("bad",)], "v string")
    got = [r.t for r in df.select(to_timestamp_any(df, "v").alias("t")).collect()]
    assert [g.minute if g else None for g in got] == [30, 30, None]
    ts = df.select(F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")).alias("v"))
    assert ts.select(to_timestamp_any(ts, "v").alias("t")).schema["t"].dataType.simpleString() == "timestamp_ntz"


@pytest.mark.parametrize("v,right,left", [
    (17, "0-18", "a"), (18, "0-18", "b"), (19, "18-35", "b"), (35, "18-35", "c"),
    (36, "35-50", "c"), (50, "35-50", "c"), (51, "50+", "c"), (-3, "0-18", "a"), (None, None, "U"),
])
def test_bucketize(spark, v, right, left):
    df = spark.createDataFrame([(v,)], "v int")
    r = bucketize("v", (18, 35, 50), ("0-18", "18-35", "35-50", "50+"), closed="right")
    l_ = bucketize("v", (18, 25), ("a", "b", "c"), closed="left", default="U")
    row = df.select(r.alias("r"), l_.alias("l")).first()
    assert (row.r, row.l) == (right, left)


def test_tokenize_delimiters(spark):
    text = 'Phòng  "đẹp",(rất)*sạch sẽ. tốt!\nok'
    assert one(spark, tokenize("v"), text) == ["phòng", "đẹp", "rất", "sạch", "sẽ.", "tốt!\nok"]
    assert one(spark, tokenize("v"), ' ,,(( ') == []
    df = spark.createDataFrame([(1, text), (2, None), (3, ' * ')], "id int, v string")
    rows = explode_tokens(df, ["id"], "v").collect()
    assert [r.word for r in rows] == ["phòng", "đẹp", "rất", "sạch", "sẽ.", "tốt!\nok"]


def test_java_rating_readers_agree(spark, tmp_path):
    """The CSV-source reader and the line parser apply the same skip rules."""
    from quarry.sources.ratings_text import JAVA, parse_ratings, read_ratings
    text = ("1, 10, 4.5, 100\n2, 11,\n3, 12, abc, 5\n\n4,13,2.0\n5, 14, 3.5, 7, extra\n , 15, 1.0, 8\n"
            "6,16, 2.5 \t,9\r\n,,,\n7, 17, , 1\n")
    p = tmp_path / "r.txt"
    p.write_text(text, encoding="utf-8")
    a = [tuple(r) for r in read_ratings(spark, str(p), JAVA).collect()]
    lines = spark.read.text(str(p))
    b = [tuple(r) for r in parse_ratings(lines, JAVA).collect()]
    norm = lambda rows: sorted((tuple(x if x != "" else None for x in r) for r in rows),
                               key=lambda r: tuple((x is not None, str(x)) for x in r))
    assert norm(a) == norm(b)
    assert sorted((r[0] or "", r[2]) for r in norm(a)) == [("", 1.0), ("1", 4.5), ("4", 2.0), ("5", 3.5), ("6", 2.5)]
