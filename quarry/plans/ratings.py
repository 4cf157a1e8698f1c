"""Rating analytics over (user, item, rating) facts with item and user dimensions.

Where the next join's key is the reporting key (items, users alone), the fact
table is first reduced to partial sums on it (map-side partial aggregation
shrinks a hot key to one row per task), then joined, then merged.  Where a user's
group is reported per item, raw ratings meet the users first -- a (user, item)
pair is almost unique, so summing by it would shuffle all ratings for nothing --
and are summed by (item, group); titles are joined to those few rows.

Joins follow the source semantics: an inner lookup drops ratings whose key is
missing from the dimension.  The lookups of N1, N3, N4, N5 and N19 are maps
filled in file order (``unique_dimension``: the last row of a key wins if the
reader gives the rows' order); in the others a repeated key multiplies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.binning import bucketize
from quarry.functions.parsing import epoch_year, java_trim, split_fields, strict_number
from quarry.operators.aggregates import CNT, REST, SUM, finish_avg, merge_partials, partial_sums, pivot_avg
from quarry.operators.joins import lookup_inner, lookup_with_default, unique_dimension
from quarry.operators.ranking import argmax_row

# Bins of the two age-group schemes.
# Scheme A (inclusive upper bounds): <=18, <=35, <=50, above.
AGE_EDGES_A = (18, 35, 50)
AGE_LABELS_A = ("0-18", "18-35", "35-50", "50+")
# Scheme B (half-open): <18, 18-24, 25-34, 35-44, 45-54, 55+; unparsable -> Unknown.
AGE_EDGES_B = (18, 25, 35, 45, 55)
AGE_LABELS_B = ("Dưới 18", "18-24", "25-34", "35-44", "45-54", "55+")
UNKNOWN = "Unknown"


def item_rating_stats(ratings: DataFrame, items: DataFrame, item_key: str = "movie_id",
                      title: str = "title", rating: str = "rating", scale: int = 2) -> DataFrame:
    """Per *title*: avg_rating, n_ratings.  Ratings of unknown items are
    dropped; items sharing a title are merged."""
    per_item = partial_sums(ratings, [item_key], rating, scale)
    named = lookup_inner(per_item, unique_dimension(items, item_key, [title]), item_key)
    return finish_avg(merge_partials(named, [title]))


def best_item(stats: DataFrame, title: str = "title", min_count: int = 5,
              avg: str = "avg_rating", count: str = "n_ratings") -> DataFrame:
    """The title with the highest average among those with at least
    ``min_count`` ratings; ties go to the smallest title; empty if none."""
    return argmax_row(stats.where(F.col(count) >= min_count), [F.col(avg).desc(), F.col(title).asc()])


def tag_rating_stats(ratings: DataFrame, items: DataFrame, item_key: str = "movie_id",
                     tags: str = "genres", rating: str = "rating", sep: str = "|",
                     trim: bool = True, drop_trailing_empty: bool = True, tag_out: str = "genre",
                     scale: int = 2, dedup: str | None = None) -> DataFrame:
    """N3 (and N16 with ``trim=False, drop_trailing_empty=False``): per tag of
    the item's tag list: avg_rating, n_ratings."""
    per_item = partial_sums(ratings, [item_key], rating, scale)
    tagged = lookup_inner(per_item, unique_dimension(items, item_key, [tags], dedup).where(F.col(tags).isNotNull()), item_key)
    parts = split_fields(tags, sep, drop_trailing_empty=drop_trailing_empty)
    exploded = tagged.select(F.explode(parts).alias(tag_out), SUM, REST, CNT)
    if trim:
        exploded = exploded.withColumn(tag_out, java_trim(tag_out))
    return finish_avg(merge_partials(exploded, [tag_out]))


def tag_avg_sorted(ratings: DataFrame, items: DataFrame, item_key: str = "movie_id",
                   tags: str = "genres", rating: str = "rating", sep: str = "|",
                   tag_out: str = "genre", scale: int = 2, ordered: bool = True) -> DataFrame:
    """Per tag (Python split, no trim): avg_rating, highest first
    (``ordered=False``: unsorted, for a report that sorts its lines)."""
    stats = tag_rating_stats(ratings, items, item_key, tags, rating, sep, trim=False,
                             drop_trailing_empty=False, tag_out=tag_out, scale=scale, dedup="none")
    out = stats.select(tag_out, "avg_rating")
    return out.orderBy(F.col("avg_rating").desc(), F.col(tag_out).asc()) if ordered else out


def _title_of(df: DataFrame, items: DataFrame | None, item_key: str, title: str, dedup: str | None = None) \
        -> tuple[DataFrame, str]:
    if items is None:
        return df, item_key
    return lookup_inner(df, unique_dimension(items, item_key, [title], dedup), item_key), title


def _by_group(ratings: DataFrame, members: DataFrame, user_key: str, item_key: str, group: str, rating: str,
              scale: int) -> DataFrame:
    """Partial sums by (item, the user's group): raw ratings meet the users, so a
    hot user is split by AQE, and the sums shrink before the shuffle."""
    joined = lookup_inner(ratings.select(user_key, item_key, rating), members, user_key)
    return partial_sums(joined, [item_key, group], rating, scale)


def item_by_two_groups(ratings: DataFrame, users: DataFrame, items: DataFrame | None = None,
                       user_key: str = "user_id", item_key: str = "movie_id", title: str = "title",
                       group: str = "gender", rating: str = "rating",
                       groups: Sequence[str] = ("M", "F"), names: Sequence[str] = ("avg_male", "avg_female"),
                       upper: bool = True, fill: float = 0.0, scale: int = 2) -> DataFrame:
    """Per title, one average per listed group value (others ignored; a
    missing group -> ``fill``).  Both lookups must hit; a title none of whose
    raters is in a listed group is not output.  ``items=None``: the item key is
    its own title."""
    g = F.upper(F.col(group)) if upper else F.col(group)
    members = unique_dimension(users, user_key, [group]).select(user_key, g.alias("_grp")).where(F.col("_grp").isin(list(groups)))
    grouped = _by_group(ratings, members, user_key, item_key, "_grp", rating, scale)
    grouped, title_col = _title_of(grouped, items, item_key, title)
    return pivot_avg(grouped, title_col, "_grp", groups, names, fill=fill)


def item_by_bucket(ratings: DataFrame, users: DataFrame, items: DataFrame | None = None,
                   user_key: str = "user_id", item_key: str = "movie_id", title: str = "title",
                   value: str = "age", rating: str = "rating",
                   edges: Sequence[float] = AGE_EDGES_A, labels: Sequence[str] = AGE_LABELS_A,
                   names: Sequence[str] = ("avg_0_18", "avg_18_35", "avg_35_50", "avg_50_plus"),
                   value_type: str = "int", fill: float = 0.0, scale: int = 2) -> DataFrame:
    """Per title, one average per bin of the user's value (right-closed
    bins); users whose value does not parse are dropped."""
    v = F.col(value).try_cast(value_type)
    members = (unique_dimension(users, user_key, [value])
               .select(user_key, bucketize(v, edges, labels, closed="right").alias("_grp"))
               .where(F.col("_grp").isNotNull()))
    grouped = _by_group(ratings, members, user_key, item_key, "_grp", rating, scale)
    grouped, title_col = _title_of(grouped, items, item_key, title)
    return pivot_avg(grouped, title_col, "_grp", labels, names, fill=fill)


def item_stats_min_ratings(ratings: DataFrame, items: DataFrame, item_key: str = "movie_id",
                           title: str = "title", rating: str = "rating", min_count: int = 5,
                           scale: int = 2) -> DataFrame:
    """Per item id: title, avg_rating, n_ratings, for items with at least
    ``min_count`` ratings (aggregate first, then join the titles)."""
    per_item = finish_avg(partial_sums(ratings, [item_key], rating, scale)).where(F.col("n_ratings") >= min_count)
    return lookup_inner(per_item, items.select(item_key, title), item_key) \
        .select(item_key, title, "avg_rating", "n_ratings")


def best_item_by_id(stats: DataFrame, item_key: str = "movie_id") -> DataFrame:
    """The row of N14 with the highest average (ties: smallest id)."""
    return argmax_row(stats, [F.col("avg_rating").desc(), F.col(item_key).asc()])


def _long_form(ratings, members, items, user_key, item_key, title, rating, group_out, numeric_item, scale,
               ordered):
    stats = finish_avg(_by_group(ratings, members, user_key, item_key, group_out, rating, scale), count_name=None)
    stats, title_col = _title_of(stats, items, item_key, title, dedup="none")
    key = strict_number(item_key, "bigint", "item").alias(item_key) if numeric_item else F.col(item_key)
    cols = [key] + ([F.col(title_col)] if title_col != item_key else []) + [F.col(group_out), F.col("avg_rating")]
    out = stats.select(*cols)
    return out.orderBy(item_key, group_out) if ordered else out


def item_by_group_long(ratings: DataFrame, users: DataFrame, items: DataFrame | None = None,
                       user_key: str = "user_id", item_key: str = "movie_id", title: str = "title",
                       group: str = "gender", rating: str = "rating", numeric_item: bool = True,
                       scale: int = 2, ordered: bool = True) -> DataFrame:
    """Long form (item, title, group value, avg_rating) for every group
    value present, sorted by item (as a number; other text fails the job) then
    group (``ordered=False``: unsorted, for a report that sorts its lines)."""
    members = users.select(user_key, F.col(group))
    return _long_form(ratings, members, items, user_key, item_key, title, rating, group, numeric_item, scale, ordered)


def item_by_bin_long(ratings: DataFrame, users: DataFrame, items: DataFrame | None = None,
                     user_key: str = "user_id", item_key: str = "movie_id", title: str = "title",
                     value: str = "age", rating: str = "rating", edges: Sequence[float] = AGE_EDGES_B,
                     labels: Sequence[str] = AGE_LABELS_B, unknown: str | None = UNKNOWN,
                     value_type: str = "int", group_out: str = "age_group", numeric_item: bool = True,
                     scale: int = 2, ordered: bool = True) -> DataFrame:
    """Long form per (item, half-open bin of the user's value); a value
    that does not parse goes to ``unknown`` (None drops the user)."""
    v = F.col(value).try_cast(value_type)
    members = users.select(user_key, bucketize(v, edges, labels, closed="left", default=unknown).alias(group_out))
    if unknown is None:
        members = members.where(F.col(group_out).isNotNull())
    return _long_form(ratings, members, items, user_key, item_key, title, rating, group_out, numeric_item, scale, ordered)


def occupation_stats(ratings: DataFrame, users: DataFrame, occupations: DataFrame,
                     user_key: str = "user_id", occ_key: str = "occupation_id",
                     occ_name: str = "occupation", rating: str = "rating",
                     missing_key="-1", missing_name: str = UNKNOWN, scale: int = 2,
                     ordered: bool = True) -> DataFrame:
    """Two-hop lookup with defaults (user -> occupation id, default
    ``missing_key``; id -> name, default ``missing_name``), so no rating is
    dropped; per name: avg_rating, n_ratings, highest average first."""
    per_user = partial_sums(ratings, [user_key], rating, scale)
    with_occ = lookup_with_default(per_user, unique_dimension(users, user_key, [occ_key]), user_key, user_key, occ_key, missing_key, out="_occ")
    named = lookup_with_default(with_occ, unique_dimension(occupations, occ_key, [occ_name]), "_occ", occ_key, occ_name, missing_name, out=occ_name)
    out = finish_avg(merge_partials(named, [occ_name]))
    return out.orderBy(F.col("avg_rating").desc(), F.col(occ_name).asc()) if ordered else out


def year_stats(ratings: DataFrame, ts: str = "ts", rating: str = "rating", scale: int = 2, ordered: bool = True) -> DataFrame:
    """Per calendar year (UTC) of an epoch-seconds text: avg_rating,
    n_ratings; unparsable timestamps dropped; by year."""
    dated = ratings.select(epoch_year(ts).alias("year"), rating).where(F.col("year").isNotNull())
    out = finish_avg(partial_sums(dated, ["year"], rating, scale))
    return out.orderBy("year") if ordered else out
