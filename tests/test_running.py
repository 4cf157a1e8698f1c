"""Running totals, frames and quantiles against plain Python, with tiny blocks so that every border is crossed."""
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators.quantiles import exact_quantiles, locate
from quarry.operators.running import numbered, row_frames, running


def made(n, seed, hot=0.4):
    rng = random.Random(seed)
    return [(i, None if rng.random() < 0.05 else "hot" if rng.random() < hot else rng.choice("abc"), rng.randint(0, 40),
             None if rng.random() < 0.2 else rng.randint(-5, 9)) for i in range(n)]


SCHEMA = "id long, k string, t int, v long"


@pytest.mark.parametrize("block", [1, 7])
def test_running(spark, block):
    data = made(120, 1)
    got = running(spark.createDataFrame(data, SCHEMA), ["k"], [F.col("t"), F.col("id")], {"total": F.col("v"), "n": F.lit(1)},
                  {"known": F.col("v")}, block).collect()
    want = {}
    for i, k, t, v in sorted(data, key=lambda r: (r[1] or "", r[2], r[0])):
        total, n, known = want.get(k, (None, 0, None))
        want[k] = state = (total if v is None else (total or 0) + v, n + 1, known if v is None else v)
        row = next(r for r in got if r.id == i)
        assert (row.total, row.n, row.known) == state
    assert len(got) == len(data)


def test_running_without_key_and_empty(spark):
    df = spark.range(50).select(F.col("id"))
    got = running(df, [], [F.col("id").desc()], {"s": F.col("id")}, block=4).collect()
    assert {r.id: r.s for r in got} == {i: sum(range(i, 50)) for i in range(50)}
    assert running(df.limit(0), [], [F.col("id")], {"s": F.col("id")}).count() == 0
    assert sorted(r._at for r in numbered(df.withColumn("x", F.lit(1)), [F.col("x")]).collect()) == list(range(50))


@pytest.mark.parametrize("block", [1, 40])
def test_row_frames(spark, block):
    data = made(90, 2)
    got = row_frames(spark.createDataFrame(data, SCHEMA), ["k"], [F.col("t"), F.col("id")],
                     {"near": (F.sum("v"), -3, 2), "before": (F.max("id"), -1, -1), "after": (F.max("id"), 1, 1),
                      "far": (F.count(F.lit(1)), -6, -4)}, block).collect()
    assert len(got) == len(data)
    for k in {r[1] for r in data}:
        rows = sorted((r for r in data if r[1] == k), key=lambda r: (r[2], r[0]))
        for j, r in enumerate(rows):
            row = next(g for g in got if g.id == r[0])
            values = [x[3] for x in rows[max(0, j - 3):j + 3] if x[3] is not None]
            assert row.near == (sum(values) if values else None)
            assert row.before == (rows[j - 1][0] if j else None)
            assert row.after == (rows[j + 1][0] if j + 1 < len(rows) else None)
            assert row.far == len(rows[max(0, j - 6):max(0, j - 3)])


def test_large_groups_are_not_shuffled_by_their_keys(spark, monkeypatch):
    from quarry.operators import quantiles

    plans, store = [], quantiles.materialize
    monkeypatch.setattr(quantiles, "materialize", lambda df: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or store(df))
    data = [(k, v) for k in "abc" for v in range(90)] + [("few", 3), ("few", 1)]
    got = exact_quantiles(spark.createDataFrame(data, "k string, v long"), ["k"], "v", {"m": 0.5, "top": 1.0}, 5, 20).collect()
    assert sorted(map(tuple, got)) == [("a", 44, 89), ("b", 44, 89), ("c", 44, 89), ("few", 1, 3)]
    rounds = [p for p in plans if "_cell" in p]
    joined = ["SortMergeJoin" in p for p in rounds]
    assert joined == [False] * (len(rounds) - 1) + [True]  # the last one is that of the small group
    assert len(rounds) == 3


@pytest.mark.parametrize("bins,finish", [(2, 1), (5, 4), (4096, 1 << 16)])
def test_quantiles(spark, bins, finish):
    rng = random.Random(4)
    special = [float("nan"), float("inf"), float("-inf"), 1e308, -1e308, 0.0, 5e-324]
    data = [(k, rng.choice(special) if rng.random() < 0.1 else round(rng.gauss(0, 100), rng.randint(0, 3)))
            for k in ["hot"] * 200 + ["b"] * 30 + [None] * 7 + ["one"]] + [("none", None), ("b", None)]
    qs = {"low": 0.0, "tenth": 0.1, "half": 0.5, "most": 0.99, "top": 1.0}
    got = {r.k: r for r in exact_quantiles(spark.createDataFrame(data, "k string, v double"), ["k"], "v", qs, bins, finish).collect()}
    assert set(got) == {"hot", "b", None, "one", "none"}
    for k, row in got.items():
        values = sorted((v for x, v in data if x == k and v is not None), key=lambda v: (v != v, v))
        for name, q in qs.items():
            n = len(values)
            want = values[max(1, n - int((n - q * n) // 1)) - 1] if values else None
            assert str(row[name]) == str(want), (k, name)


def test_quantiles_of_integers_and_ties(spark):
    data = [(1, 7)] * 500 + [(1, 2**61), (1, -2**61)] + [(2, i) for i in range(101)]
    got = {r.k: r.m for r in exact_quantiles(spark.createDataFrame(data, "k int, v long"), ["k"], "v", {"m": 0.5}, 3, 2).collect()}
    assert got == {1: 7, 2: 50}
    rows = spark.createDataFrame([(5, 10), (7, 1), (9, 30)], "v long, w long")
    found = locate(rows, [], "v", F.col("w"), spark.createDataFrame([(10,), (11,), (12,), (41,), (42,)], "need long"), 2, 1).collect()
    assert sorted(tuple(r) for r in found) == [(10, 5, 0), (11, 7, 10), (12, 9, 11), (41, 9, 11)]
    with pytest.raises(ValueError):
        exact_quantiles(rows, [], "v", {"m": 1.5})
