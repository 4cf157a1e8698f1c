"""Text forms of the rating analytics, as Spark DataFrames of lines.

Numbers are formatted at this edge only; the analytics return raw doubles.
Two rounding rules exist: the key/value outputs use Java ``%.2f`` (HALF_UP,
``format_string``), the formatted reports use Python ``.2f``, which rounds the
exact binary value (``round_python`` first).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import round_python
from quarry.sinks.text import report_lines

# Line formats of the outputs.
TITLE_STATS_FMT = "AverageRating: %.2f (TotalRatings: %d)"
BEST_TITLE_FMT = "is the highest rated movie with an average rating of %.2f among movies with at least %d ratings."
GENRE_STATS_FMT = "Avg: %.2f, Count: %d"
TWO_GROUPS_FMT = "Male: %.2f, Female: %.2f"
AGE_BUCKETS_FMT = "[0-18: %.2f, 18-35: %.2f, 35-50: %.2f, 50+: %.2f]"

STATS_HEADER = "--- DANH SACH THONG KE (>= {n} DANH GIA) ---"
BEST_BLOCK = ("", "=" * 50, "PHIM CO DIEM TRUNG BINH CAO NHAT (>= {n} danh gia):", "Ten phim: {title}",
              "Diem trung binh: {avg}", "So luot danh gia: {n_ratings}")
GENRE_HEADER = "--- DIEM TRUNG BINH THEO TUNG THE LOAI ---"
GENDER_HEADER = "--- DIEM TRUNG BINH PHIM THEO GIOI TINH ---"
GENDER_SEPARATOR = "-" * 40
AGE_HEADER = "--- DIEM TRUNG BINH PHIM THEO NHOM TUOI ---"
AGE_SEPARATOR = "-" * 50
OCC_HEADER = "--- THONG KE DANH GIA THEO NGHE NGHIEP ---"
YEAR_HEADER = "--- THONG KE DANH GIA THEO NAM ---"


def _s(c) -> Column:
    """Text of a value as a Python f-string prints it (a missing value is None)."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("None"))


def left(c, width: int, cut: int | None = None) -> Column:
    """Python ``{x[:cut]:<width}``: optional cut, then pad on the right to at
    least ``width`` (never truncates, unlike a bare ``rpad``)."""
    v = _s(c)
    if cut is not None:
        v = F.substring(v, 1, cut)
    return F.rpad(v, F.greatest(F.length(v), F.lit(width)), " ")


def py2(c) -> Column:
    """Python ``format(x, '.2f')``; a missing value is None."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    text = F.when(F.isnan(x), "nan").when(x == float("inf"), "inf").when(x == float("-inf"), "-inf")
    return F.when(x.isNull(), "None").otherwise(F.coalesce(text, F.format_string("%.2f", round_python(x))))


def java2(c) -> Column:
    return F.format_string("%.2f", F.col(c) if isinstance(c, str) else c)


# ------------------------------------------------------------ key TAB value

def title_stats_lines(stats: DataFrame, best: DataFrame | None = None, title: str = "title",
                      min_count: int = 5) -> DataFrame:
    """``title<TAB>AverageRating: ...`` sorted by title, plus the best-title
    line at the end when there is one."""
    line = F.concat_ws("\t", F.col(title), F.format_string(TITLE_STATS_FMT, "avg_rating", "n_ratings"))
    footer = None
    if best is not None:
        footer = [F.concat(F.lit("\n"), F.col(title), F.lit("\t"),
                           F.format_string(BEST_TITLE_FMT, F.col("avg_rating"), F.lit(min_count)))]
    return report_lines(stats, [F.col(title)], line, footer=footer, footer_df=best)


def genre_stats_lines(stats: DataFrame, genre: str = "genre") -> DataFrame:
    line = F.concat_ws("\t", F.col(genre), F.format_string(GENRE_STATS_FMT, "avg_rating", "n_ratings"))
    return report_lines(stats, [F.col(genre)], line)


def two_groups_lines(stats: DataFrame, title: str = "title", names=("avg_male", "avg_female")) -> DataFrame:
    line = F.concat_ws("\t", F.col(title), F.format_string(TWO_GROUPS_FMT, *names))
    return report_lines(stats, [F.col(title)], line)


def age_buckets_lines(stats: DataFrame, title: str = "title",
                      names=("avg_0_18", "avg_18_35", "avg_35_50", "avg_50_plus")) -> DataFrame:
    line = F.concat_ws("\t", F.col(title), F.format_string(AGE_BUCKETS_FMT, *names))
    return report_lines(stats, [F.col(title)], line)


# ------------------------------------------------------- formatted reports

def item_stats_report(stats: DataFrame, best: DataFrame, item_key: str = "movie_id", title: str = "title",
                      min_count: int = 5) -> DataFrame:
    line = F.concat(F.lit("ID: "), _s(item_key), F.lit(" | Phim: "), _s(title), F.lit(" | Diem TB: "),
                    py2("avg_rating"), F.lit(" | So luot: "), _s("n_ratings"))
    footer = [F.lit(""), F.lit(BEST_BLOCK[1]), F.lit(BEST_BLOCK[2].format(n=min_count)),
              F.concat(F.lit("Ten phim: "), _s(title)), F.concat(F.lit("Diem trung binh: "), py2("avg_rating")),
              F.concat(F.lit("So luot danh gia: "), _s("n_ratings"))]
    return report_lines(stats, [F.col(item_key)], line, header=STATS_HEADER.format(n=min_count),
                        footer=footer, footer_df=best)


def genre_avg_report(stats: DataFrame, genre: str = "genre") -> DataFrame:
    line = F.concat(F.lit("The loai: "), left(genre, 15), F.lit(" | Diem TB: "), py2("avg_rating"))
    return report_lines(stats, [-F.col("avg_rating"), F.col(genre)], line, header=GENRE_HEADER)


def gender_report(stats: DataFrame, item_key: str = "movie_id", title: str = "title",
                  group: str = "gender") -> DataFrame:
    line = F.concat(F.lit("ID: "), left(item_key, 4), F.lit(" | Phim: "), left(title, 25, 25),
                    F.lit(" | Giới tính: "), _s(group), F.lit(" | Điểm TB: "), py2("avg_rating"))
    return report_lines(stats, [F.col(item_key), F.col(group)], line, header=GENDER_HEADER,
                        separator=GENDER_SEPARATOR)


def age_report(stats: DataFrame, item_key: str = "movie_id", title: str = "title",
               group: str = "age_group") -> DataFrame:
    line = F.concat(F.lit("ID: "), left(item_key, 4), F.lit(" | Phim: "), left(title, 20, 20),
                    F.lit(" | Nhóm tuổi: "), left(group, 8), F.lit(" | Điểm TB: "), py2("avg_rating"))
    return report_lines(stats, [F.col(item_key), F.col(group)], line, header=AGE_HEADER,
                        separator=AGE_SEPARATOR)


def occupation_report(stats: DataFrame, occupation: str = "occupation") -> DataFrame:
    line = F.concat(F.lit("Nghe nghiep: "), left(occupation, 15), F.lit(" | Diem TB: "), py2("avg_rating"),
                    F.lit(" | Tong luot danh gia: "), _s("n_ratings"))
    return report_lines(stats, [-F.col("avg_rating"), F.col(occupation)], line, header=OCC_HEADER)


def year_report(stats: DataFrame) -> DataFrame:
    line = F.concat(F.lit("Năm: "), _s("year"), F.lit(" | Điểm TB: "), py2("avg_rating"),
                    F.lit(" | Tổng số lượt đánh giá: "), _s("n_ratings"))
    return report_lines(stats, [F.col("year")], line, header=YEAR_HEADER)
