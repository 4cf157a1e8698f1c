"""Analytics against brute-force Python models of the original semantics on
random small inputs (unknown keys, unparsable values, duplicate dimension
keys, null categories, ties)."""

import random
import re
from collections import defaultdict

import pytest

from quarry.plans import commerce as C
from quarry.plans import ratings as R
from quarry.plans import reviews as V
from quarry.sources import JAVA, PYTHON, parse_ratings
from quarry.sources.ratings_text import parse_movies

SEEDS = [1, 2, 3]


def approx_rows(rows, nd=9):
    return sorted(tuple(round(x, nd) if isinstance(x, float) else x for x in r) for r in rows)


@pytest.mark.parametrize("seed", SEEDS)
def test_title_stats_java_lines(spark, seed):
    """Java mapper/reducer model: split on ',', >= 3 fields, trim, parseDouble
    or skip, title lookup (last duplicate wins -> unique here), group by title."""
    rnd = random.Random(seed)
    movies = [f"{i}, Title {rnd.randint(0, 5)}, G" for i in range(12)]
    lines = []
    for _ in range(300):
        kind = rnd.random()
        mid = rnd.randint(0, 15)  # 12..15 are unknown
        if kind < 0.8:
            lines.append(f"{rnd.randint(1, 9)}, {mid}, {rnd.choice([1, 1.5, 2, 3.5, 4, 5])}, 100")
        elif kind < 0.9:
            lines.append(f"{rnd.randint(1, 9)}, {mid}, x{rnd.randint(0, 9)}, 100")  # bad rating
        else:
            lines.append(f"{rnd.randint(1, 9)}, {mid}")  # too short
    title = {}
    for m in movies:
        p = m.split(",")
        if len(p) >= 2:
            title[p[0].strip()] = p[1].strip()
    acc = defaultdict(list)
    for ln in lines:
        p = ln.split(",")
        if len(p) < 3:
            continue
        try:
            r = float(p[2].strip())
        except ValueError:
            continue
        t = title.get(p[1].strip())
        if t is not None:
            acc[t].append(r)
    expected = [(t, sum(v) / len(v), len(v)) for t, v in acc.items()]
    rl = spark.createDataFrame([(x,) for x in lines], "value string")
    ml = spark.createDataFrame([(x,) for x in movies], "value string")
    got = R.item_rating_stats(parse_ratings(rl, JAVA), parse_movies(ml, JAVA)).collect()
    assert approx_rows(got) == approx_rows(expected)


@pytest.mark.parametrize("seed", SEEDS)
def test_occupation_two_hop_defaults(spark, seed):
    """dict.get chains: user -> occupation id (default "-1") -> name (default
    Unknown); every rating is kept."""
    rnd = random.Random(seed)
    users = {str(u): str(rnd.randint(0, 6)) for u in range(10)}           # occupation 5, 6 unknown
    occ = {str(o): f"job{o}" for o in range(5)}
    ratings = [(str(rnd.randint(0, 13)), rnd.choice([1.0, 2.5, 3.0, 4.5])) for _ in range(200)]  # users 10..13 unknown
    acc = defaultdict(list)
    for u, r in ratings:
        acc[occ.get(users.get(u, "-1"), "Unknown")].append(r)
    expected = [(k, sum(v) / len(v), len(v)) for k, v in acc.items()]
    got = R.occupation_stats(spark.createDataFrame(ratings, "user_id string, rating double"),
                             spark.createDataFrame(list(users.items()), "user_id string, occupation_id string"),
                             spark.createDataFrame(list(occ.items()), "occupation_id string, occupation string"))
    assert approx_rows(got.collect()) == approx_rows(expected)


@pytest.mark.parametrize("seed", SEEDS)
def test_top_words_bag_count_model(spark, seed):
    """Tokenise, drop stop words, count rows whose category is not null, top 5
    per category by count then word."""
    rnd = random.Random(seed)
    vocab = ["a", "b", "c", "d", "e", "f", "g", "và", "(h)", "i*j"]
    stop = ["và", "c"]
    rows = [(str(i), " ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 6))),
             rnd.choice(["X", "Y", None]), "H", rnd.choice(["positive", "NEGATIVE"])) for i in range(60)]
    counts = defaultdict(int)
    for _, text, cat, _, sent in rows:
        for w in [t for t in re.split(r'[ ",()*]+', text.lower()) if t]:
            if w not in stop and sent.lower() == "positive":
                counts[(cat, w)] += 1 if cat is not None else 0
    per_cat = defaultdict(list)
    for (cat, w), n in counts.items():
        per_cat[cat].append((-n, w.encode(), w, n))
    expected = [(cat, w, n) for cat, lst in per_cat.items() for _, _, w, n in sorted(lst)[:5]]
    reviews = spark.createDataFrame(rows, "id string, comment string, dim3 string, dim4 string, sentiment string")
    stop_df = spark.createDataFrame([(w,) for w in stop], "stopword string")
    got = V.top_words(reviews, stop_df, "dim3", "positive").collect()
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("seed", SEEDS)
def test_category_sales_fan_out_model(spark, seed):
    """Row-level join model: items x products (inner) left-joined to valid
    reviews of the order; count item ids and average scores over the rows."""
    rnd = random.Random(seed)
    items = [(f"o{rnd.randint(0, 9)}", rnd.choice([1, 2, None]), f"p{rnd.randint(0, 5)}") for _ in range(80)]
    products = [(f"p{i}", rnd.choice(["toys", "books"])) for i in range(5)] + [("p0", "games")]  # p5 unknown, p0 twice
    reviews = [(f"o{rnd.randint(0, 12)}", rnd.choice(["1", "3", "5", "0", "9", "x", None])) for _ in range(30)]
    valid = [(o, int(s)) for o, s in reviews if s is not None and s.isdigit() and 1 <= int(s) <= 5]
    acc = defaultdict(lambda: [0, 0, 0])
    for o, item, p in items:
        for pid, cat in products:
            if pid != p:
                continue
            matches = [s for ro, s in valid if ro == o] or [None]
            for s in matches:
                a = acc[cat]
                a[0] += item is not None
                if s is not None:
                    a[1] += s
                    a[2] += 1
    expected = [(c, n, round(s / k, 2) if k else None) for c, (n, s, k) in acc.items()]
    got = C.category_sales_and_score(
        spark.createDataFrame(items, "Order_ID string, Order_Item_ID int, Product_ID string"),
        spark.createDataFrame(products, "Product_ID string, Product_Category_Name string"),
        spark.createDataFrame(reviews, "Order_ID string, Review_Score string")).collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_python_dialect_fails_on_bad_rating(spark):
    from pyspark.errors import PySparkException
    lines = spark.createDataFrame([("1,10,4.5,100",), ("2,11,oops,100",)], "value string")
    with pytest.raises(PySparkException):
        parse_ratings(lines, PYTHON).collect()
