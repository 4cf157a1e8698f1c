"""Review jobs on a hand-made ';' file with the awkward cases; answers worked
out by hand."""

from collections import Counter

import pytest

from quarry.plans import reviews as V
from quarry.sinks.text import nested_bag_text
from quarry.sources import read_delimited, read_wordlist

ROWS = """1;Phòng đẹp, sạch sẽ (rất) tốt;PRICES;HOTEL;positive
2;Phòng   "bẩn" và ồn*;COMFORT;ROOMS;NEGATIVE
3;Nhân viên thân thiện;PRICES;SERVICE;Positive
3;Nhân viên thân thiện;COMFORT;HOTEL;positive
4;;GENERAL;HOTEL;neutral
;phòng tốt;PRICES;HOTEL;positive
5;chúng tôi thích phòng;QUALITY;ROOMS;negative
6;short row
"""
STOP = "và\nvà\nchúng tôi\nrất\n"


@pytest.fixture
def data(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text(ROWS, encoding="utf-8")
    (tmp_path / "stop.txt").write_text(STOP, encoding="utf-8")
    return (read_delimited(spark, str(tmp_path / "reviews.csv")),
            read_wordlist(spark, str(tmp_path / "stop.txt")))


def test_load_pads_short_rows(data):
    reviews, stop = data
    rows = reviews.collect()
    assert len(rows) == 8 and stop.count() == 4
    assert rows[-1].asDict() == {"id": "6", "comment": "short row", "dim3": None, "dim4": None, "sentiment": None}
    assert rows[4].comment is None and rows[5].id is None


def test_clean_tokens(data):
    reviews, stop = data
    got = Counter(tuple(r) for r in V.clean_tokens(reviews, stop).collect())
    exp = Counter([("1", "phòng"), ("1", "đẹp"), ("1", "sạch"), ("1", "sẽ"), ("1", "tốt"),
                   ("2", "phòng"), ("2", "bẩn"), ("2", "ồn"),
                   *[("3", w) for w in ("nhân", "viên", "thân", "thiện")] * 2,
                   (None, "phòng"), (None, "tốt"),
                   ("5", "chúng"), ("5", "tôi"), ("5", "thích"), ("5", "phòng"),
                   ("6", "short"), ("6", "row")])
    assert got == exp


def test_frequent_words_skips_null_ids(data):
    reviews, stop = data
    got = {r.word: r.word_count for r in V.frequent_words(V.clean_tokens(reviews, stop), threshold=1).collect()}
    assert got == {"phòng": 3, "nhân": 2, "viên": 2, "thân": 2, "thiện": 2}


def test_comments_per_value(data):
    reviews, _ = data
    by4 = {r.dim4: r.num_comments for r in V.comments_per_value(reviews, "dim4").collect()}
    by3 = {r.dim3: r.num_comments for r in V.comments_per_value(reviews, "dim3").collect()}
    assert by4 == {"HOTEL": 3, "ROOMS": 2, "SERVICE": 1, None: 1}
    assert by3 == {"PRICES": 2, "COMFORT": 2, "GENERAL": 1, "QUALITY": 1, None: 1}


def test_top_value_by_sentiment(data):
    reviews, _ = data
    got = {r.sentiment: (r.dim4, r.total) for r in V.top_value_by_sentiment(reviews).collect()}
    assert got == {"positive": ("HOTEL", 2), "negative": ("ROOMS", 2)}


def test_top_words_positive_ties_by_word(data):
    reviews, stop = data
    got = [(r.dim3, r.word, r.cnt) for r in V.top_words(reviews, stop, sentiment="positive")
           .orderBy("dim3", "cnt", "word").collect()]
    prices = [g for g in got if g[0] == "PRICES"]
    assert sorted(prices, key=lambda g: (-g[2], g[1].encode())) == [
        ("PRICES", "phòng", 2), ("PRICES", "tốt", 2), ("PRICES", "nhân", 1), ("PRICES", "sạch", 1),
        ("PRICES", "sẽ", 1)]
    assert sorted(g[1] for g in got if g[0] == "COMFORT") == sorted(["nhân", "viên", "thân", "thiện"])


def test_top_words_negative(data):
    reviews, stop = data
    got = {(r.dim3, r.word): r.cnt for r in V.top_words(reviews, stop, sentiment="negative").collect()}
    assert got == {("COMFORT", "phòng"): 1, ("COMFORT", "bẩn"): 1, ("COMFORT", "ồn"): 1,
                   ("QUALITY", "chúng"): 1, ("QUALITY", "tôi"): 1, ("QUALITY", "thích"): 1,
                   ("QUALITY", "phòng"): 1}


def test_top_words_all_counts_null_category_as_zero(data):
    reviews, stop = data
    got = {(r.dim3, r.word): r.cnt for r in V.top_words(reviews, stop).collect()}
    assert got[(None, "row")] == 0 and got[(None, "short")] == 0
    assert got[("PRICES", "phòng")] == 2


def test_three_reports_from_one_count_table(data):
    from quarry.plans.shared import materialize
    reviews, stop = data
    outs = V.top_words_all(reviews, stop, materialize=materialize)
    for name, sentiment in (("positive", "positive"), ("negative", "negative"), ("all", None)):
        alone = V.top_words(reviews, stop, sentiment=sentiment)
        assert sorted(map(tuple, outs[name].collect()), key=str) == sorted(map(tuple, alone.collect()), key=str)


def test_nested_bag_text(data):
    reviews, stop = data
    nested = V.top_words_nested(reviews, stop, sentiment="negative")
    lines = {r.line for r in nested_bag_text(nested, "dim3", "top_words", ["dim3", "word", "cnt"]).collect()}
    assert "COMFORT,{(COMFORT,bẩn,1),(COMFORT,phòng,1),(COMFORT,ồn,1)}" in lines


def test_nested_bag_text_keeps_null_fields(data):
    reviews, stop = data
    nested = V.top_words_nested(reviews, stop)  # all sentiments: the null category has cnt 0 words
    lines = {r.line for r in nested_bag_text(nested, "dim3", "top_words", ["dim3", "word", "cnt"]).collect()}
    assert ",{(,row,0),(,short,0)}" in lines
