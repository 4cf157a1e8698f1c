"""Sums that lose nothing, and rounding against Python's own."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quarry.functions import round_half_up, round_python, round_ratio
from quarry.functions.parsing import strict_field
from quarry.operators.aggregates import finish_avg, partial_sums, pivot_avg
from quarry.plans import ratings as R
from quarry.plans.reports import py2
from quarry.sources import PYTHON
from quarry.sources.ratings_text import parse_occupations, parse_ratings, parse_users


@pytest.mark.parametrize("values, mean", [
    ([3.335, 3.334], 3.3345), ([3.0, math.nan], math.nan), ([3.0, math.inf], math.inf), ([1e17, 1.0], (1e17 + 1.0) / 2),
    ([1e300, 1e300], 1e300), ([0.1, 0.2], 0.15), ([5e-324], 5e-324)])
def test_average_keeps_every_value(spark, values, mean):
    df = spark.createDataFrame([("a", v) for v in values], "k string, v double")
    got = finish_avg(partial_sums(df, ["k"], "v")).first()
    assert got.n_ratings == len(values)
    assert got.avg_rating == pytest.approx(mean, rel=1e-15, nan_ok=True)


def test_pivot_keeps_every_value(spark):
    df = spark.createDataFrame([("i", "M", 3.335), ("i", "M", 3.334), ("i", "F", math.nan), ("i", "F", 1.0)],
                               "item string, g string, v double")
    got = pivot_avg(partial_sums(df, ["item", "g"], "v"), "item", "g", ["M", "F", "X"], ["m", "f", "x"]).first()
    assert got.m == pytest.approx(3.3345) and math.isnan(got.f) and got.x == 0.0


def _values():
    rng = random.Random(11)
    ties = [k / 1000 + 0.005 for k in range(0, 6000, 10)] + [2.675, 3.675, 0.125, 0.375, 1.005, 1e9 + 0.125, -2.675, -0.125]
    means = [rng.randint(1, 400) / rng.choice([8, 20, 40, 80, 200]) for _ in range(800)]
    return ties + means + [rng.uniform(-1e6, 1e6) for _ in range(800)] + [0.0, 1e15, 12345678.905]


def test_python_rounding_matches_format(spark):
    values = _values()
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [(r.x, r.t) for r in df.select("x", py2("x").alias("t")).collect()]
    wrong = [(x, t, format(x, ".2f")) for x, t in got if t != format(x, ".2f") and not (float(t) == 0 == float(format(x, ".2f")))]
    assert not wrong, wrong[:5]
    odd = spark.createDataFrame([(math.nan,), (math.inf,), (-math.inf,), (None,)], "x double")
    assert [r.t for r in odd.select(py2("x").alias("t")).collect()] == ["nan", "inf", "-inf", "None"]


def test_half_up_is_one_step(spark):
    df = spark.createDataFrame([(1.00499999999999,), (2.675,), (-2.675,), (0.125,)], "x double")
    got = [r.y for r in df.select(round_half_up("x").alias("y")).collect()]
    assert got == [1.0, 2.68, -2.68, 0.13]
    assert [r.y for r in df.select(round_python("x").alias("y")).collect()] == [1.0, 2.67, -2.67, 0.12]


def test_ratio_rounds_the_true_quotient(spark):
    rows = [(5999.94, None, 12, 500.0), (1.0, None, 3, 0.33), (-0.01, None, 2, -0.01), (2.0, None, 0, None), (0.01, 0.125, 1, 0.14)]
    df = spark.createDataFrame([(e, r, n) for e, r, n, _ in rows], "e double, r double, n long") \
        .select(F.col("e").cast("decimal(28,2)").alias("e"), "r", "n")
    assert [x.y for x in df.select(round_ratio("e", "r", "n").alias("y")).collect()] == [w for *_, w in rows]


def _lines(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_python_lines_without_a_named_field_fail(spark):
    with pytest.raises(Exception, match="missing timestamp"):
        parse_ratings(_lines(spark, "1,2,3.0,4", "1,2,3.0"), PYTHON, ("rating", "ts")).collect()
    assert parse_ratings(_lines(spark, "1,2,3.0"), PYTHON, ("movie_id", "rating")).count() == 1
    with pytest.raises(Exception, match="missing occupation_id"):
        parse_users(_lines(spark, "1,M,30,5,x", "7"), PYTHON, ("user_id", "occupation_id")).collect()
    with pytest.raises(Exception, match="missing occupation"):
        parse_occupations(_lines(spark, "1,Doctor", "2")).collect()
    short = spark.createDataFrame([(["a"],)], "p array<string>")
    assert short.select(strict_field("p", 0).alias("x")).first().x == "a"


def test_item_ids_that_are_not_numbers_fail(spark):
    ratings = spark.createDataFrame([("1", "10", 4.0), ("1", "9", 2.0)], "user_id string, movie_id string, rating double")
    users = spark.createDataFrame([("1", "M")], "user_id string, gender string")
    got = [(r.movie_id, r.avg_rating) for r in R.item_by_group_long(ratings, users).collect()]
    assert got == [(9, 2.0), (10, 4.0)]  # as numbers
    bad = ratings.union(spark.createDataFrame([("1", "abc", 1.0)], ratings.schema))
    with pytest.raises(Exception, match="cannot parse item"):
        R.item_by_group_long(bad, users).collect()


def test_last_line_of_a_key_wins(spark, scratch):
    from quarry.sources import JAVA, read_movies, read_occupations, read_ratings, read_users

    def write(name, *lines):
        path = f"{scratch}/{name}"
        with open(path, "w", encoding="utf-8") as f:
            f.write("\n".join(lines))
        return path

    movies = read_movies(spark, write("movies", "10,Old,Drama", "11,Other,War", "10,New,Comedy"), JAVA)
    ratings = read_ratings(spark, write("ratings", "1,10,4,0", "2,10,2,0"), JAVA)
    users = read_users(spark, write("users", "1,F,20,5,z", "2,F,20,6,z", "1,M,40,6,z"), JAVA)
    assert [tuple(r) for r in R.item_rating_stats(ratings, movies).collect()] == [("New", 3.0, 2)]
    assert [tuple(r) for r in R.tag_rating_stats(ratings, movies).collect()] == [("Comedy", 3.0, 2)]
    assert [tuple(r) for r in R.item_by_two_groups(ratings, users, movies).collect()] == [("New", 4.0, 2.0)]
    buckets = R.item_by_bucket(ratings, users, movies).first()
    assert (buckets.avg_18_35, buckets.avg_35_50) == (2.0, 4.0)
    occupations = read_occupations(spark, write("occ", "5,Doctor", "6,Lawyer", "6,Judge"))
    py = read_users(spark, f"{scratch}/users", PYTHON, ("user_id", "occupation_id"))
    assert [tuple(r) for r in R.occupation_stats(ratings, py, occupations).collect()] == [("Judge", 3.0, 2)]
