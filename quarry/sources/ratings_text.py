"""Positional comma-separated text files of the ratings datasets.

Two dialects, matching the two families of jobs:

``JAVA``   fields split with Java rules (trailing empty fields dropped) and
           trimmed; a line with too few fields or an unparsable number is
           skipped; the title is field 1 only (a comma cuts it).
``PYTHON`` fields split with Python rules, not trimmed (the timestamp is);
           the title is everything between the first and the last field;
           an unparsable rating, or a line without a field that a job
           names, fails the job.

Every reader accepts one path, a directory or a list (read as UNION ALL).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.parsing import (
    field,
    last_field,
    middle_join,
    parsed_once,
    split_fields,
    strict_field,
    strict_number,
    try_number,
)
from quarry.operators.joins import ORDER

JAVA = "java"
PYTHON = "python"


def _lines(spark: SparkSession, paths: str | Sequence[str], ordered: bool = False) -> DataFrame:
    """The lines (``value``); ``ordered`` adds their place: file, then position."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(paths)
    if not ordered:
        return lines
    return lines.select("value", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                                          F.monotonically_increasing_id().alias("line")).alias(ORDER))


def _split(lines: DataFrame, dialect: str) -> DataFrame:
    return lines.select(split_fields("value", ",", drop_trailing_empty=dialect == JAVA).alias("p"), *_place(lines))


def _place(lines: DataFrame) -> list[Column]:
    return [F.col(ORDER)] if ORDER in lines.columns else []


def _records(df: DataFrame, *fields: Column) -> DataFrame:
    # One parsed record per line; later filters on its fields (skip rules,
    # join keys not null) do not re-run the split and the trims.
    return parsed_once(df, *fields, *_place(df))


RATING_COLUMNS = ("user_id", "movie_id", "rating", "ts")
USER_COLUMNS = ("user_id", "gender", "age", "occupation_id", "zip")


def parse_ratings(lines: DataFrame, dialect: str = JAVA, fields: Sequence[str] | None = None) -> DataFrame:
    """Rating lines (a ``value`` column, batch or streaming) -> user_id,
    movie_id, rating (double), ts (string).  ``fields`` names the columns the
    caller needs (the rating is always parsed: the skip / fail rules depend on
    it); the parsed record is emitted once, so unnamed fields cost nothing.  In
    the Python dialect a line without a named field fails the job."""
    wanted = [c for c in RATING_COLUMNS if fields is None or c in fields or c == "rating"]
    if dialect == JAVA:
        # A line with fewer than 3 fields (trailing empty fields dropped) has
        # no non-empty third field, so the rating test alone applies both skip
        # rules and fields 0-2 are the same under either split rule.
        df = lines.select(F.split(F.col("value"), ",").alias("p"))
        ts = field("p", 3, True)
        exprs = {"user_id": field("p", 0, True), "movie_id": field("p", 1, True),
                 "rating": try_number(field("p", 2, True)), "ts": F.when(ts != F.lit(""), ts)}
        out = _records(df, *[exprs[c].alias(c) for c in wanted])
        return out.where(F.col("rating").isNotNull())
    df = _split(lines, dialect)
    ts = field("p", 3) if fields is None else strict_field("p", 3, "timestamp")
    exprs = {"user_id": field("p", 0), "movie_id": field("p", 1),
             "rating": strict_number(field("p", 2), what="rating"), "ts": F.trim(ts)}
    return _records(df, *[exprs[c].alias(c) for c in wanted])


def read_ratings(spark: SparkSession, paths, dialect: str = JAVA, fields: Sequence[str] | None = None) -> DataFrame:
    """user_id, movie_id, rating (double), ts (string) -- or the named ``fields``."""
    return parse_ratings(_lines(spark, paths), dialect, fields)


def parse_movies(lines: DataFrame, dialect: str = JAVA) -> DataFrame:
    """Movie lines -> movie_id, title, genres (raw text of the last field)."""
    df = _split(lines, dialect)
    if dialect == JAVA:
        return _records(df.where(F.size("p") >= 2),
                        field("p", 0, True).alias("movie_id"), field("p", 1, True).alias("title"),
                        F.when(F.size("p") >= 3, last_field("p", True)).alias("genres"))
    return _records(df, field("p", 0).alias("movie_id"), middle_join("p").alias("title"),
                    last_field("p").alias("genres"))


def read_movies(spark: SparkSession, paths, dialect: str = JAVA) -> DataFrame:
    """movie_id, title, genres (raw text of the last field); in the Java dialect
    also the line's place, so that lookups let the last line of an id win."""
    return parse_movies(_lines(spark, paths, ordered=dialect == JAVA), dialect)


def parse_users(lines: DataFrame, dialect: str = JAVA, fields: Sequence[str] | None = None) -> DataFrame:
    """User lines -> user_id, gender, age (text), occupation_id, zip -- or the
    named ``fields``; in the Python dialect a line without one fails the job."""
    df = _split(lines, dialect)
    t = dialect == JAVA
    if t:
        df = df.where(F.size("p") >= 2)
    wanted = [c for c in USER_COLUMNS if fields is None or c in fields]
    strict = fields is not None and not t
    return _records(df, *[(strict_field("p", i, c) if strict else field("p", i, t)).alias(c)
                          for i, c in enumerate(USER_COLUMNS) if c in wanted])


def read_users(spark: SparkSession, paths, dialect: str = JAVA, fields: Sequence[str] | None = None) -> DataFrame:
    """user_id, gender, age (text), occupation_id, zip, and the line's place."""
    return parse_users(_lines(spark, paths, ordered=True), dialect, fields)


def parse_occupations(lines: DataFrame) -> DataFrame:
    """Occupation lines (Python rules; a short line fails the job) -> occupation_id, occupation."""
    df = _split(lines, PYTHON)
    return df.select(field("p", 0).alias("occupation_id"), strict_field("p", 1, "occupation").alias("occupation"),
                     *_place(df))


def read_occupations(spark: SparkSession, paths) -> DataFrame:
    return parse_occupations(_lines(spark, paths, ordered=True))
