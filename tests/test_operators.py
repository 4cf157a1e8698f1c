"""Operators without a dedicated analytic test."""

from pyspark.sql import functions as F

import pytest

from quarry.operators import ORDER, dedup_last, lookup_inner, tagged_union, unique_dimension


def test_dedup_last_keeps_latest_row(spark):
    dim = spark.createDataFrame([("1", "Old", 1), ("1", "New", 3), ("2", "Only", 1), ("1", "Mid", 2)],
                                "movie_id string, title string, line int")
    got = {r.movie_id: r.title for r in dedup_last(dim, "movie_id", "line").collect()}
    assert got == {"1": "New", "2": "Only"}
    fact = spark.createDataFrame([("1", 4.0), ("1", 2.0), ("3", 5.0)], "movie_id string, rating double")
    joined = lookup_inner(fact, dedup_last(dim, "movie_id", "line").drop("line"), "movie_id")
    assert sorted(tuple(r) for r in joined.collect()) == [("1", 2.0, "New"), ("1", 4.0, "New")]


def test_tagged_union_marks_the_source(spark):
    pos = spark.createDataFrame([("HOTEL", 2)], "value string, total int")
    neg = spark.createDataFrame([("ROOMS", 2)], "value string, total int")
    got = sorted(tuple(r) for r in tagged_union({"positive": pos, "negative": neg}, "sentiment").collect())
    assert got == [("HOTEL", 2, "positive"), ("ROOMS", 2, "negative")]


def test_approx_distinct_is_opt_in(spark):
    from quarry.plans import reviews as V
    rows = [(str(i % 997), "c" if i % 2 else "d") for i in range(20000)]
    df = spark.createDataFrame(rows, "id string, dim4 string")
    exact = {r.dim4: r.num_comments for r in V.comments_per_value(df).collect()}
    approx = {r.dim4: r.num_comments for r in V.comments_per_value(df, approx_distinct=True).collect()}
    assert exact == {"c": 997, "d": 997}  # 997 is odd: both halves see every id
    assert all(abs(approx[k] - exact[k]) <= 0.05 * exact[k] for k in exact)


def test_spread_only_narrow_inputs(spark):
    from quarry.operators import spread
    wide = spark.range(0, 1000, numPartitions=16)
    assert spread(wide, "id", min_partitions=8) is wide          # already split wider: untouched
    narrow = spark.range(0, 1000, numPartitions=1)
    spread_df = spread(narrow, "id", min_partitions=8)
    assert spread_df.rdd.getNumPartitions() == 8
    assert sorted(r.id for r in spread_df.collect()) == list(range(1000))


def test_unique_dimension_rules(spark):
    dim = spark.createDataFrame([("1", "Old", 1), ("1", "New", 3), ("2", "Only", 1)], f"id string, title string, {ORDER} int")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(unique_dimension(dim, "id", ["title"])) == [("1", "New"), ("2", "Only")]
    assert len(rows(unique_dimension(dim, "id", ["title"], "none"))) == 3
    assert rows(unique_dimension(dim.where("title <> 'Old'"), "id", ["title"], "assert")) == [("1", "New"), ("2", "Only")]
    with pytest.raises(Exception, match="repeated id: 1"):
        unique_dimension(dim, "id", ["title"], "assert").collect()


def test_checkpoint_folder_must_be_named(spark):
    from quarry.session import checkpoint_dir

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_tables_see_rows_added_between_calls(spark, scratch):
    from quarry.sources.tables import table
    path = f"{scratch}/t.parquet"
    spark.range(10).write.parquet(path)
    assert table(spark, scratch, "t").count() == 10
    spark.range(5).write.mode("append").parquet(path)
    assert table(spark, scratch, "t").count() == 15
