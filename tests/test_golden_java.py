"""Key/value outputs of the MapReduce-style jobs on their original data."""

from pyspark.sql import functions as F

from conftest import FIXTURES
from quarry.plans import ratings as R
from quarry.plans import reports as P
from quarry.sinks.text import ordered, write_lines
from quarry.sources import JAVA, read_movies, read_ratings, read_users

D = FIXTURES / "ratings_java"
RATINGS = [str(D / "ratings_1.txt"), str(D / "ratings_2.txt")]


def expected(name):
    return (D / name).read_text(encoding="utf-8").splitlines()


def lines(df):
    return [r.line for r in ordered(df).collect()]


def test_title_stats(spark):
    stats = R.item_rating_stats(read_ratings(spark, RATINGS, JAVA), read_movies(spark, str(D / "movies.txt"), JAVA))
    best = R.best_item(stats, min_count=5)
    assert best.count() == 0  # every title has two ratings: no summary line
    assert lines(P.title_stats_lines(stats, best)) == expected("expected_title_stats.txt")


def test_title_stats_written_in_order(spark, scratch):
    stats = R.item_rating_stats(read_ratings(spark, RATINGS, JAVA), read_movies(spark, str(D / "movies.txt"), JAVA))
    out = scratch + "/title_stats"
    write_lines(P.title_stats_lines(stats, R.best_item(stats)), out)
    parts = sorted(p for p in __import__("os").listdir(out) if p.startswith("part-"))
    text = "".join(open(f"{out}/{p}", encoding="utf-8").read() for p in parts)
    assert text.splitlines() == expected("expected_title_stats.txt")


def test_best_title_line_when_one_qualifies(spark):
    stats = R.item_rating_stats(read_ratings(spark, RATINGS, JAVA), read_movies(spark, str(D / "movies.txt"), JAVA))
    best = R.best_item(stats, min_count=2)
    got = lines(P.title_stats_lines(stats, best, min_count=2))
    top = stats.orderBy(F.desc("avg_rating"), "title").first()
    assert got[-1] == (f"\n{top.title}\tis the highest rated movie with an average rating of "
                       f"{top.avg_rating:.2f} among movies with at least 2 ratings.")


def test_genre_stats(spark):
    stats = R.tag_rating_stats(read_ratings(spark, RATINGS, JAVA), read_movies(spark, str(D / "movies.txt"), JAVA))
    assert lines(P.genre_stats_lines(stats)) == expected("expected_genre_stats.txt")


def test_gender_stats(spark):
    stats = R.item_by_two_groups(read_ratings(spark, RATINGS, JAVA), read_users(spark, str(D / "users.txt"), JAVA),
                                 read_movies(spark, str(D / "movies.txt"), JAVA))
    assert lines(P.two_groups_lines(stats)) == expected("expected_gender_stats.txt")


def test_age_bucket_stats(spark):
    stats = R.item_by_bucket(read_ratings(spark, RATINGS, JAVA), read_users(spark, str(D / "users.txt"), JAVA),
                             read_movies(spark, str(D / "movies.txt"), JAVA))
    assert lines(P.age_buckets_lines(stats)) == expected("expected_age_stats.txt")
