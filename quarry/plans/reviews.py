"""Review-text analytics over (id, comment, dim3, dim4, sentiment) rows.

The two label columns are called ``dim3`` and ``dim4`` (their position in
the file): the source jobs give them contradicting names, so every function
takes the column to group on as a parameter, with the source job's choice as
default.

Counting follows bag-COUNT semantics: a row is counted when the *first*
field of the counted relation is not null -- the id for the token and
comment counts, the category for the per-category word counts.

Scale notes: tokens are produced by ``explode`` (one row per token, no
collect; callers reading a few large files first ``operators.spread`` the
scan so tokenising uses every core), stop words leave through a broadcast anti join when the list is
small, and every count is a grouped aggregation with map-side partials, so
frequent words ("the") and large categories collapse before the shuffle.
Top-k runs as ``row_number() <= k`` (partial WindowGroupLimit before the
exchange), the nested form collects at most k rows per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import PIG_DELIMITERS, explode_tokens, tokenize
from quarry.operators.aggregates import distinct_count
from quarry.operators.joins import anti_join_words
from quarry.operators.ranking import nested_top_k, top_k_per_group

POSITIVE = "positive"
NEGATIVE = "negative"


def tokens(reviews: DataFrame, keep: Sequence[str], text_col: str = "comment",
           delimiters: str = PIG_DELIMITERS) -> DataFrame:
    """``keep`` columns + one ``word`` row per token of the lower-cased text."""
    return explode_tokens(reviews, keep, text_col, delimiters)


def clean_tokens(reviews: DataFrame, stop: DataFrame, id_col: str = "id", text_col: str = "comment",
                 stop_col: str = "stopword", delimiters: str = PIG_DELIMITERS) -> DataFrame:
    """(id, word) for every token that is not a stop word; duplicates kept."""
    return anti_join_words(tokens(reviews, [id_col], text_col, delimiters), stop, "word", stop_col)


def frequent_words(clean: DataFrame, threshold: int = 500, id_col: str = "id",
                   out: str = "word_count") -> DataFrame:
    """Words counted more than ``threshold`` times (rows with a null id
    are not counted)."""
    return (clean.groupBy("word").agg(F.count(id_col).alias(out))
                 .where(F.col(out) > threshold))


def comments_per_value(reviews: DataFrame, value_col: str = "dim4", id_col: str = "id",
                       out: str = "num_comments", approx_distinct: bool = False) -> DataFrame:
    """N8 (dim4) / N9 (dim3): distinct comment ids per value (null value is a
    group of its own; null ids are not counted).  ``approx_distinct`` trades
    exactness for a sketch per group."""
    return reviews.groupBy(value_col).agg(distinct_count(id_col, approx_distinct).cast("bigint").alias(out))


def _count(first_col: str, weight: str | None):
    """Bag COUNT: rows whose first field is not null; with ``weight``, each
    row stands for ``weight`` identical rows (pre-aggregated input)."""
    if weight is None:
        return F.count(first_col)
    return F.coalesce(F.sum(F.when(F.col(first_col).isNotNull(), F.col(weight))), F.lit(0)).cast("bigint")


def top_value_by_sentiment(reviews: DataFrame, value_col: str = "dim4", sentiment_col: str = "sentiment",
                           id_col: str = "id", sentiments: Sequence[str] = (POSITIVE, NEGATIVE),
                           out: str = "total", weight: str | None = None) -> DataFrame:
    """For each listed sentiment (case-insensitive), the value with the
    most rows (ties: smallest value).  One pass: group by (sentiment, value),
    then top-1 per sentiment."""
    s = F.lower(F.col(sentiment_col))
    counted = (reviews.where(s.isin(list(sentiments)))
                      .groupBy(s.alias("sentiment"), F.col(value_col))
                      .agg(_count(id_col, weight).alias(out)))
    best = top_k_per_group(counted, ["sentiment"], [F.col(out).desc(), F.col(value_col).asc_nulls_first()], 1)
    return best.select("sentiment", value_col, out)


def word_counts(reviews: DataFrame, stop: DataFrame, category_col: str = "dim3",
                sentiment_col: str | None = "sentiment", text_col: str = "comment",
                stop_col: str = "stopword", delimiters: str = PIG_DELIMITERS,
                weight: str | None = None) -> DataFrame:
    """(sentiment, category, word, cnt) with sentiment lower-cased -- the one
    table the three top-words reports are cut from -- or (category, word, cnt)
    when ``sentiment_col`` is None.  ``weight``: each input
    row stands for that many identical rows."""
    keep = [F.col(category_col).alias("_cat")]
    keys = ["_cat", "word"]
    if sentiment_col:
        keep.append(F.lower(F.col(sentiment_col)).alias("sentiment"))
        keys.insert(0, "sentiment")
    if weight:
        keep.append(F.col(weight).alias("_w"))
    words = explode_tokens(reviews, keep, text_col, delimiters)
    clean = anti_join_words(words, stop, "word", stop_col)
    return (clean.groupBy(*keys).agg(_count("_cat", "_w" if weight else None).alias("cnt"))
                 .withColumnRenamed("_cat", category_col))


def _pick(counts: DataFrame, category_col: str, sentiment: str | None) -> DataFrame:
    if sentiment is None:
        if "sentiment" not in counts.columns:
            return counts
        return counts.groupBy(category_col, "word").agg(F.sum("cnt").alias("cnt"))
    return counts.where(F.col("sentiment") == sentiment).select(category_col, "word", "cnt")


def _order():
    return [F.col("cnt").desc(), F.col("word").asc()]


def top_words(reviews: DataFrame, stop: DataFrame, category_col: str = "dim3", sentiment: str | None = None,
              k: int = 5, counts: DataFrame | None = None, **kw) -> DataFrame:
    """N11 (sentiment='positive'), N12 ('negative'), N13 (None: all rows):
    per category the k most frequent non-stop words (ties: word ascending),
    flat rows (category, word, cnt)."""
    counts = counts if counts is not None else word_counts(
        reviews, stop, category_col, "sentiment" if sentiment else None, **kw)
    return top_k_per_group(_pick(counts, category_col, sentiment), [category_col], _order(), k)


def top_words_nested(reviews: DataFrame, stop: DataFrame, category_col: str = "dim3",
                     sentiment: str | None = None, k: int = 5, counts: DataFrame | None = None,
                     out: str = "top_words", **kw) -> DataFrame:
    """Same as ``top_words`` as (category, array<struct<category, word, cnt>>),
    the nested-bag shape of the original output."""
    counts = counts if counts is not None else word_counts(
        reviews, stop, category_col, "sentiment" if sentiment else None, **kw)
    picked = _pick(counts, category_col, sentiment).withColumn("_c", F.col(category_col))
    nested = nested_top_k(picked, [category_col], ["_c", "word", "cnt"], _order(), k, out=out)
    return nested.select(category_col, F.transform(out, lambda s: F.struct(
        s["_c"].alias(category_col), s["word"].alias("word"), s["cnt"].alias("cnt"))).alias(out))


def top_words_all(reviews: DataFrame, stop: DataFrame, category_col: str = "dim3", k: int = 5,
                  materialize=None, **kw) -> dict[str, DataFrame]:
    """The three reports from one tokenisation: ``materialize`` (e.g.
    ``plans.shared.materialize``) may cut the shared count table to storage
    so the three outputs do not re-tokenise."""
    counts = word_counts(reviews, stop, category_col, "sentiment", **kw)
    if materialize is not None:
        counts = materialize(counts)
    return {name: top_words(reviews, stop, category_col, s, k, counts=counts)
            for name, s in ((POSITIVE, POSITIVE), (NEGATIVE, NEGATIVE), ("all", None))}


#: the outputs of ``review_outputs``
WORDS, CATEGORY, ASPECT = "frequent_words", "per_category", "per_aspect"


def review_outputs(reviews: DataFrame, stop: DataFrame, threshold: int = 500, id_col: str = "id", text_col: str = "comment",
                   category_col: str = "dim4", aspect_col: str = "dim3", stop_col: str = "stopword",
                   delimiters: str = PIG_DELIMITERS) -> DataFrame:
    """N7, N8 and N9 from one scan: rows (output, value, total) of three outputs.

    Each review gives a row for each token and one for each of its two labels,
    marked with the output they are for.  Tokens are counted and comments made
    distinct by one pre-aggregation (output, value, id), which collapses most
    tokens before the shuffle; a second one adds up.  A null label is a value of
    its own; null ids are not counted.
    """
    text = F.transform(tokenize(text_col, delimiters), lambda w: F.struct(F.lit(WORDS).alias("output"), w.alias("value")))
    labels = [F.struct(F.lit(o).alias("output"), F.col(c).cast("string").alias("value")) for o, c in ((CATEGORY, category_col), (ASPECT, aspect_col))]
    empty = F.array().cast("array<struct<output: string, value: string>>")
    marked = reviews.select(F.col(id_col).alias("_id"), F.inline(F.concat(F.coalesce(text, empty), F.array(*labels))))
    is_word = F.col("output") == WORDS
    kept = marked.join(stop.select(F.lit(WORDS).alias("output"), F.col(stop_col).alias("value")).distinct(), ["output", "value"], "left_anti")
    once = kept.groupBy("output", "value", F.when(~is_word, F.col("_id")).alias("_id")).agg(F.count("_id").alias("_n"))
    total = F.sum(F.when(is_word, F.col("_n")).otherwise(F.least("_n", F.lit(1)))).cast("bigint")
    return once.groupBy("output", "value").agg(total.alias("total")).where(~is_word | (F.col("total") > threshold))
