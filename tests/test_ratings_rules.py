"""Rating-job rules the original data never exercises, on hand-made lines."""

from quarry.plans import ratings as R
from quarry.sources import JAVA, PYTHON, parse_ratings
from quarry.sources.ratings_text import parse_movies, parse_users


def lines(spark, *xs):
    return spark.createDataFrame([(x,) for x in xs], "value string")


def test_java_suite_rules(spark):
    movies = parse_movies(lines(spark, "1, A, x", "2, A, y", "3, B, z", "4"), JAVA)
    users = parse_users(lines(spark, "u1, m, 18", "u2, F, 40", "u3, X, 30", "u4, F, old", "u5, M, 51"), JAVA)
    ratings = parse_ratings(lines(spark, "u1, 1, 4", "u2, 2, 2", "u3, 3, 5", "u1, 9, 3", "u4, 3, 1",
                                  "u5, 2, 3.5", "u2, 1"), JAVA)
    stats = {r.title: (r.avg_rating, r.n_ratings) for r in R.item_rating_stats(ratings, movies).collect()}
    assert stats == {"A": (3.1666666666666665, 3), "B": (3.0, 2)}          # ids 1 and 2 merge under "A"
    two = {r.title: (r.avg_male, r.avg_female) for r in R.item_by_two_groups(ratings, users, movies).collect()}
    assert two == {"A": (3.75, 2.0), "B": (0.0, 1.0)}                       # 'm' upper-cased; X ignored
    ages = {r.title: tuple(r)[1:] for r in R.item_by_bucket(ratings, users, movies).collect()}
    assert ages == {"A": (4.0, 0.0, 2.0, 3.5), "B": (0.0, 5.0, 0.0, 0.0)}   # 18 -> 0-18; 'old' dropped


def test_python_suite_rules(spark):
    movies = parse_movies(lines(spark, "1,Crouching Tiger, Hidden Dragon (2000),Action|Drama", "2,Up (2009),"), PYTHON)
    ratings = parse_ratings(lines(spark, "7,1,4.0,1577836800", "8,1,3.0, 1577836800 ", "9,2,5.0,bad"), PYTHON)
    got = R.item_stats_min_ratings(ratings, movies, min_count=1).orderBy("movie_id").collect()
    assert [tuple(r) for r in got] == [("1", "Crouching Tiger, Hidden Dragon (2000)", 3.5, 2), ("2", "Up (2009)", 5.0, 1)]
    tags = {r.genre: r.avg_rating for r in R.tag_avg_sorted(ratings, movies).collect()}
    assert tags == {"Action": 3.5, "Drama": 3.5, "": 5.0}                   # Python split keeps the empty genre
    years = [tuple(r) for r in R.year_stats(ratings).collect()]
    assert years == [(2020, 3.5, 2)]                                        # 'bad' timestamp dropped
