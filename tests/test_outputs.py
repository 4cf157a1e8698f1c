"""Versioned overwrite, and several outputs from one job."""
import os

import pytest
from pyspark.sql import functions as F

from quarry.plans import reviews as V
from quarry.sinks.text import write_delimited, write_outputs
from quarry.sinks.versions import current, publish, versions


def test_a_failed_write_leaves_the_old_version(spark, scratch):
    path = f"{scratch}/out"
    with pytest.raises(FileNotFoundError):
        current(spark, path)
    publish(spark, path, lambda f: spark.range(5).write.parquet(f))
    assert spark.read.parquet(current(spark, path)).count() == 5

    def half(folder):
        spark.range(3).write.parquet(folder)  # some files are there already
        spark.range(3).select(F.raise_error(F.lit("lost"))).write.mode("append").parquet(folder)

    with pytest.raises(Exception, match="lost"):
        publish(spark, path, half)
    assert spark.read.parquet(current(spark, path)).count() == 5
    with pytest.raises(FileNotFoundError):
        publish(spark, path, lambda f: None)
    assert spark.read.parquet(current(spark, path)).count() == 5


def test_old_versions_are_swept_and_readers_keep_theirs(spark, scratch):
    path = f"{scratch}/out"
    held = None
    for n in range(1, 5):
        publish(spark, path, lambda f: spark.range(n).write.parquet(f))
        if held is not None:  # opened before this version was published
            assert held.count() == n - 1
        held = spark.read.parquet(current(spark, path))
    assert len(versions(spark, path)) == 2
    assert sorted(x for x in os.listdir(path) if x.startswith("v-")) == sorted(versions(spark, path))
    publish(spark, path, lambda f: write_delimited(spark.range(2), f), keep=0)
    assert len(versions(spark, path)) == 1 and len([x for x in os.listdir(path) if x.startswith("v-")]) == 1


REVIEWS = [("1", "good food, good view", "room", "hotel"), ("2", "Good the bad", "room", "beach"), ("2", None, None, "beach"),
           (None, "good", "food", None), ("3", "", "food", "hotel"), ("3", "view", "food", "hotel")]


def test_outputs_equal_the_single_reports(spark, scratch):
    reviews = spark.createDataFrame(REVIEWS, "id string, comment string, dim3 string, dim4 string")
    stop = spark.createDataFrame([("the",), ("room",), (None,)], "stopword string")
    got = V.review_outputs(reviews, stop, threshold=1)
    want = [(V.WORDS, r.word, r.word_count) for r in V.frequent_words(V.clean_tokens(reviews, stop), 1).collect()]
    want += [(V.CATEGORY, r.dim4, r.num_comments) for r in V.comments_per_value(reviews, "dim4").collect()]
    want += [(V.ASPECT, r.dim3, r.num_comments) for r in V.comments_per_value(reviews, "dim3").collect()]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    write_outputs(got, f"{scratch}/many")
    back = spark.read.schema("value string, total long, output string").csv(f"{scratch}/many")
    assert sorted(map(tuple, back.select("output", "value", "total").collect()), key=str) == sorted(want, key=str)


def test_one_scan(spark, scratch):
    path = f"{scratch}/reviews"
    spark.createDataFrame(REVIEWS, "id string, comment string, dim3 string, dim4 string").write.parquet(path)
    stop = spark.range(1).select(F.lit("the").alias("stopword"))
    plan = V.review_outputs(spark.read.parquet(path), stop)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") + plan.count("Relation[") == 1
