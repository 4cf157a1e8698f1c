"""Readers.  Each returns a typed DataFrame; nothing is collected."""

from quarry.sources.bucketed import bucketed_table, write_bucketed
from quarry.sources.csv import read_csv
from quarry.sources.delimited import read_delimited, read_wordlist
from quarry.sources.ratings_text import (
    JAVA,
    PYTHON,
    read_movies,
    parse_movies,
    parse_ratings,
    parse_users,
    read_occupations,
    read_ratings,
    read_users,
)
from quarry.sources.schema import schema_report
from quarry.sources.tables import table

__all__ = [
    "JAVA", "PYTHON", "bucketed_table", "write_bucketed", "parse_movies", "parse_ratings", "parse_users", "read_csv", "read_delimited", "read_movies", "read_occupations",
    "read_ratings", "read_users", "read_wordlist", "schema_report", "table",
]
