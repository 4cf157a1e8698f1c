"""Command-line jobs: the original jobs, file in -> file out, in their output
formats.  ``python -m quarry.jobs <job> [args]`` or ``spark-submit``.

Ratings (key/value text):  title-stats, genre-stats, gender-stats, age-stats
Reviews (delimited text):  clean-words, review-stats, top-aspect, top-words-sentiment, top-words
Ratings (reports):         item-report, genre-report, gender-report, age-report,
                           occupation-report, year-report
E-commerce (CSV folder):   commerce <question 1..10>
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans import commerce as C
from quarry.plans import ratings as R
from quarry.plans import reports as P
from quarry.plans import reviews as V
from quarry.operators.sets import spread
from quarry.plans.shared import materialize
from quarry.sinks.text import nested_bag_text, write_delimited, write_lines
from quarry.sources import (
    JAVA,
    PYTHON,
    read_csv,
    read_delimited,
    read_movies,
    read_occupations,
    read_ratings,
    read_users,
    read_wordlist,
    schema_report,
)

# The stop words of the review jobs.
DEFAULT_STOPWORDS = __file__.rsplit("/", 1)[0] + "/data/stopwords_vi.txt"


def _reviews(spark, path, tokenised=True):
    """The review file; spread over the cluster when its texts are to be tokenised
    and it arrives in few splits."""
    df = read_delimited(spark, path)
    if not tokenised:
        return df
    return spread(df, F.xxhash64(F.coalesce(F.col("id"), F.lit("")), F.coalesce(F.col("comment"), F.lit(""))))


# ------------------------------------------------------------ ratings, k/v

def title_stats(spark, ratings, movies, out, min_count=5, mode="errorifexists"):
    stats = R.item_rating_stats(read_ratings(spark, ratings, JAVA), read_movies(spark, movies, JAVA))
    write_lines(P.title_stats_lines(stats, R.best_item(stats, min_count=min_count), min_count=min_count), out, mode)


def genre_stats(spark, ratings, movies, out, mode="errorifexists"):
    stats = R.tag_rating_stats(read_ratings(spark, ratings, JAVA), read_movies(spark, movies, JAVA))
    write_lines(P.genre_stats_lines(stats), out, mode)


def gender_stats(spark, ratings, users, movies, out, mode="errorifexists"):
    stats = R.item_by_two_groups(read_ratings(spark, ratings, JAVA), read_users(spark, users, JAVA),
                                 read_movies(spark, movies, JAVA))
    write_lines(P.two_groups_lines(stats), out, mode)


def age_stats(spark, ratings, users, movies, out, mode="errorifexists"):
    stats = R.item_by_bucket(read_ratings(spark, ratings, JAVA), read_users(spark, users, JAVA),
                             read_movies(spark, movies, JAVA))
    write_lines(P.age_buckets_lines(stats), out, mode)


# ------------------------------------------------------------------ reviews

def clean_words(spark, reviews, out, stopwords=DEFAULT_STOPWORDS, mode="errorifexists"):
    """(id, word) lines."""
    write_delimited(V.clean_tokens(_reviews(spark, reviews), read_wordlist(spark, stopwords)), out, mode=mode)


def review_stats(spark, reviews, out_dir, cleaned=None, stopwords=DEFAULT_STOPWORDS, threshold=500,
                 mode="errorifexists"):
    """Three outputs: frequent words, comments per category (4th column) and
    per aspect (3rd column).  ``cleaned``: a stored clean-words output to read
    instead of re-tokenising."""
    if cleaned:
        clean = read_delimited(spark, cleaned, columns=("id", "word"), sep=",")
    else:
        clean = V.clean_tokens(_reviews(spark, reviews), read_wordlist(spark, stopwords))
    # the counts per value read neither the texts nor anything but their columns: one small
    # (dim3, dim4, id) table serves both
    raw = materialize(_reviews(spark, reviews, tokenised=False).select("id", "dim3", "dim4"))
    write_delimited(V.frequent_words(clean, threshold), f"{out_dir}/frequent_words", mode=mode)
    write_delimited(V.comments_per_value(raw, "dim4"), f"{out_dir}/per_category", mode=mode)
    write_delimited(V.comments_per_value(raw, "dim3"), f"{out_dir}/per_aspect", mode=mode)


def top_aspect(spark, reviews, out, mode="errorifexists"):
    """``value,total`` for the positive then the negative top value."""
    best = V.top_value_by_sentiment(_reviews(spark, reviews, tokenised=False), "dim4")
    ordered = best.orderBy(F.when(F.col("sentiment") == V.POSITIVE, 0).otherwise(1)).select("dim4", "total")
    write_delimited(ordered, out, mode=mode)


def _nested(df, k_col="dim3"):
    return nested_bag_text(df, k_col, "top_words", [k_col, "word", "cnt"])


def top_words_sentiment(spark, reviews, out_pos, out_neg, stopwords=DEFAULT_STOPWORDS, k=5, mode="errorifexists"):
    """Positive and negative top words per 3rd column, from one tokenisation."""
    raw, stop = _reviews(spark, reviews), read_wordlist(spark, stopwords)
    counts = materialize(V.word_counts(raw, stop, "dim3", "sentiment"))
    for sentiment, out in ((V.POSITIVE, out_pos), (V.NEGATIVE, out_neg)):
        nested = V.top_words_nested(raw, stop, "dim3", sentiment, k, counts=counts)
        _nested(nested).write.mode(mode).text(out)


def top_words(spark, reviews, out, stopwords=DEFAULT_STOPWORDS, k=5, mode="errorifexists"):
    nested = V.top_words_nested(_reviews(spark, reviews), read_wordlist(spark, stopwords), "dim3", None, k)
    _nested(nested).write.mode(mode).text(out)


# ----------------------------------------------------------- ratings, reports

def _py_inputs(spark, ratings, movies=None, users=None, fields=("user_id", "movie_id", "rating"), user_field=None):
    """The inputs of a fail-fast job; a line without a field it names fails it."""
    return (read_ratings(spark, ratings, PYTHON, fields), movies and read_movies(spark, movies, PYTHON),
            users and read_users(spark, users, PYTHON, ("user_id", user_field)))


def item_report(spark, ratings, movies, out, min_count=5, mode="errorifexists"):
    r, m, _ = _py_inputs(spark, ratings, movies, fields=("movie_id", "rating"))
    stats = R.item_stats_min_ratings(r, m, min_count=min_count)
    write_lines(P.item_stats_report(stats, R.best_item_by_id(stats), min_count=min_count), out, mode)


def genre_report(spark, ratings, movies, out, mode="errorifexists"):
    r, m, _ = _py_inputs(spark, ratings, movies, fields=("movie_id", "rating"))
    write_lines(P.genre_avg_report(R.tag_avg_sorted(r, m, ordered=False)), out, mode)


def gender_report(spark, ratings, users, movies, out, mode="errorifexists"):
    r, m, u = _py_inputs(spark, ratings, movies, users, user_field="gender")
    write_lines(P.gender_report(R.item_by_group_long(r, u, m, ordered=False)), out, mode)


def age_report(spark, ratings, users, movies, out, mode="errorifexists"):
    r, m, u = _py_inputs(spark, ratings, movies, users, user_field="age")
    write_lines(P.age_report(R.item_by_bin_long(r, u, m, ordered=False)), out, mode)


def occupation_report(spark, ratings, users, occupations, out, mode="errorifexists"):
    r, _, u = _py_inputs(spark, ratings, None, users, fields=("user_id", "rating"), user_field="occupation_id")
    stats = R.occupation_stats(r, u, read_occupations(spark, occupations), ordered=False)
    write_lines(P.occupation_report(stats), out, mode)


def year_report(spark, ratings, out, mode="errorifexists"):
    r, _, _ = _py_inputs(spark, ratings, fields=("rating", "ts"))
    write_lines(P.year_report(R.year_stats(r, ordered=False)), out, mode)


# --------------------------------------------------------------- e-commerce

# The table names (files) of the e-commerce set.
COMMERCE_FILES = ("Customer_List", "Order_Items", "Order_Reviews", "Orders", "Products")


class _Tables(dict):
    """Tables of the e-commerce folder, read (and schema-inferred: one pass over
    the file) only when a question uses them."""

    def __init__(self, spark: SparkSession, folder: str, infer: bool):
        super().__init__()
        self.spark, self.folder, self.infer = spark, folder.rstrip("/"), infer

    def __missing__(self, name: str) -> DataFrame:
        df = read_csv(self.spark, f"{self.folder}/{name}.csv", infer=self.infer)
        self[name] = df
        return df


def commerce_tables(spark: SparkSession, folder: str, infer: bool = True) -> dict[str, DataFrame]:
    return _Tables(spark, folder, infer)


def commerce_question(spark: SparkSession, folder: str, question: int) -> dict[str, DataFrame]:
    """Result tables of one question (1..10) of the e-commerce set."""
    t = commerce_tables(spark, folder)
    answers = {
        1: lambda: {"schemas": schema_report(spark, {n: t[n] for n in COMMERCE_FILES})},
        2: lambda: {"totals": C.entity_totals(t["Orders"], t["Customer_List"], t["Order_Items"])},
        3: lambda: {"orders_by_country": C.orders_by_country(t["Orders"], t["Customer_List"])},
        4: lambda: {"orders_by_year_month": C.orders_by_year_month(t["Orders"])},
        5: lambda: {"review_average": C.review_average(t["Order_Reviews"]),
                    "review_distribution": C.review_distribution(t["Order_Reviews"])},
        6: lambda: {"revenue_by_category": C.revenue_by_category(t["Order_Items"], t["Orders"], t["Products"])},
        7: lambda: {"category_sales_and_score": C.category_sales_and_score(t["Order_Items"], t["Products"],
                                                                           t["Order_Reviews"])},
        8: lambda: {"delivery_performance": C.delivery_performance(t["Orders"], t["Order_Items"])},
        9: lambda: {"customer_segments": C.customer_segments(t["Orders"], t["Order_Items"])},
        10: lambda: {"seller_ranking": C.seller_ranking(t["Order_Items"])},
    }
    return answers[question]()


def commerce(spark, folder, question, out_dir, mode="errorifexists"):
    for name, df in commerce_question(spark, folder, int(question)).items():
        df.write.mode(mode).option("header", "true").option("sep", ";").csv(f"{out_dir}/{name}")


JOBS = {
    "title-stats": (title_stats, ["ratings", "movies", "out"]),
    "genre-stats": (genre_stats, ["ratings", "movies", "out"]),
    "gender-stats": (gender_stats, ["ratings", "users", "movies", "out"]),
    "age-stats": (age_stats, ["ratings", "users", "movies", "out"]),
    "clean-words": (clean_words, ["reviews", "out"]),
    "review-stats": (review_stats, ["reviews", "out_dir"]),
    "top-aspect": (top_aspect, ["reviews", "out"]),
    "top-words-sentiment": (top_words_sentiment, ["reviews", "out_pos", "out_neg"]),
    "top-words": (top_words, ["reviews", "out"]),
    "item-report": (item_report, ["ratings", "movies", "out"]),
    "genre-report": (genre_report, ["ratings", "movies", "out"]),
    "gender-report": (gender_report, ["ratings", "users", "movies", "out"]),
    "age-report": (age_report, ["ratings", "users", "movies", "out"]),
    "occupation-report": (occupation_report, ["ratings", "users", "occupations", "out"]),
    "year-report": (year_report, ["ratings", "out"]),
    "commerce": (commerce, ["folder", "question", "out_dir"]),
}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="quarry.jobs", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("args", nargs="+", help="inputs then outputs; 'ratings' accepts a comma-separated list")
    ap.add_argument("--overwrite", action="store_true")
    ns = ap.parse_args(argv)
    fn, names = JOBS[ns.job]
    if len(ns.args) != len(names):
        ap.error(f"{ns.job} takes: {' '.join(names)}")
    kwargs = {n: (v.split(",") if n == "ratings" else v) for n, v in zip(names, ns.args)}
    from quarry.session import build_session
    # keep whatever master and shuffle sizing the launcher (spark-submit) configured
    spark = SparkSession.getActiveSession() or build_session(master=None, shuffle_partitions=None,
                                                             app=f"quarry-{ns.job}")
    fn(spark, **kwargs, mode="overwrite" if ns.overwrite else "errorifexists")


if __name__ == "__main__":
    main(sys.argv[1:])
