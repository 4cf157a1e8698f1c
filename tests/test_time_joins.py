"""As-of and interval joins against plain Python."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators.asof import as_of_join
from quarry.operators.intervals import overlap_join


def made(n, seed, prefix):
    rng = random.Random(seed)
    return [(f"{prefix}{i}", None if rng.random() < 0.05 else "hot" if rng.random() < 0.5 else rng.choice("ab"),
             None if rng.random() < 0.05 else rng.randint(0, 30)) for i in range(n)]


@pytest.mark.parametrize("strict,block", [(False, 1), (True, 1000)])
def test_as_of(spark, strict, block):
    asked, known = made(60, 1, "l"), made(50, 2, "r")
    got = as_of_join(spark.createDataFrame(asked, "id string, k string, t long"),
                     spark.createDataFrame(known, "rid string, rk string, rt long").withColumnRenamed("rk", "k"), ["k"], "t", "rt", ["rid"],
                     strict=strict, out_time="seen", block=block).collect()
    assert len(got) == len(asked)
    for i, k, t in asked:
        fit = [(rt, rid) for rid, rk, rt in known if None not in (k, t, rk, rt) and rk == k and (rt < t if strict else rt <= t)]
        row = next(r for r in got if r.id == i)
        assert (row.seen, row.rid) == (max(fit) if fit else (None, None))


def test_as_of_tolerance_null_values_and_empty(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    left = spark.createDataFrame([("a", day(5)), ("a", day(9)), ("b", day(5))], "k string, t timestamp_ntz")
    right = spark.createDataFrame([("a", day(4), None), ("a", day(1), 7)], "k string, rt timestamp_ntz, v int")
    got = as_of_join(left, right, ["k"], "t", "rt", ["v"], tolerance=F.expr("interval 2 days"), out_time="at").collect()
    assert sorted((r.k, r.t.day, r.v, r["at"] and r["at"].day) for r in got) == [("a", 5, None, 4), ("a", 9, None, None), ("b", 5, None, None)]
    assert as_of_join(left, right.limit(0), ["k"], "t", "rt", ["v"]).where("v is null").count() == 3
    assert as_of_join(left.limit(0), right, ["k"], "t", "rt", ["v"]).count() == 0
    with pytest.raises(ValueError):
        as_of_join(left, right, ["k"], "t", "rt", ["k"])


def spans(n, seed, longest):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        s = rng.randint(-50, 200)
        out.append((i, rng.choice(["hot", "hot", "x", None]), s, None if rng.random() < 0.05 else s + int(rng.random() ** 4 * longest)))
    return out


@pytest.mark.parametrize("dense", [3, 10**6])
def test_overlap(spark, dense):
    a, b = spans(120, 1, 300), spans(100, 2, 30)
    df = lambda rows: spark.createDataFrame(rows, "id int, k string, s long, e long")
    for on in (["k"], []):
        got = overlap_join(df(a), df(b), ("s", "e"), ("s", "e"), on, dense)
        want = sorted((x[0], y[0]) for x in a for y in b if None not in (x[3], y[3]) and x[2] < x[3] and y[2] < y[3]
                      and (not on or (x[1] is not None and x[1] == y[1])) and x[2] < y[3] and y[2] < x[3])
        assert sorted((r["left"]["id"], r["right"]["id"]) for r in got.collect()) == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_overlap_of_dates_and_times(spark):
    day = lambda d, h=0: dt.datetime(2024, 1, d, h, 30, 15, 250)
    left = spark.createDataFrame([(1, day(1), day(3)), (2, day(3), day(4)), (3, day(9), day(9))], "id int, s timestamp_ntz, e timestamp_ntz")
    right = spark.createDataFrame([(1, day(2), day(3)), (2, day(3), day(3, 1))], "id int, s timestamp_ntz, e timestamp_ntz")
    pairs = lambda df: sorted((r["left"]["id"], r["right"]["id"]) for r in df.collect())
    assert pairs(overlap_join(left, right, ("s", "e"), ("s", "e"))) == [(1, 1), (2, 2)]
    cast = lambda df, k: df.select("id", F.col("s").cast(k).alias("s"), F.col("e").cast(k).alias("e"))
    assert pairs(overlap_join(cast(left, "timestamp"), cast(right, "timestamp"), ("s", "e"), ("s", "e"))) == [(1, 1), (2, 2)]
    assert pairs(overlap_join(cast(left, "date"), cast(right, "date"), ("s", "e"), ("s", "e"))) == [(1, 1)]
    assert overlap_join(left.limit(0), right, ("s", "e"), ("s", "e")).count() == 0
    with pytest.raises(TypeError):
        overlap_join(left, cast(right, "date"), ("s", "e"), ("s", "e"))
    with pytest.raises(TypeError):
        overlap_join(cast(left, "string"), cast(right, "string"), ("s", "e"), ("s", "e"))


def test_deliveries_are_summed_by_day_before_the_join(spark, scratch, monkeypatch):
    from quarry.plans import catalog_time

    start = dt.datetime(1995, 1, 1)
    parts = [(i, ["A", "B", None][i % 3], [1, 3, 0, None, 9][i % 5]) for i in range(30)]
    rng = random.Random(7)
    lines = [(rng.randrange(32), rng.choice([0, 1, 2, 5]), rng.choice([None, 0.5, 12.25, 3.0]),
              rng.choice([None, start + dt.timedelta(days=rng.randint(-3, 40), hours=rng.choice([0, 0, 5, 23]))])) for _ in range(3000)]
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_size int").write.parquet(f"{scratch}/part.parquet")
    spark.createDataFrame(lines, "l_partkey long, l_linenumber int, l_extendedprice double, l_shipdate timestamp_ntz").write.parquet(
        f"{scratch}/lineitem.parquet")
    joined = []

    def seen(left, right, *rest):
        joined.append(right.count())
        return overlap_join(left, right, *rest)

    monkeypatch.setattr(catalog_time, "overlap_join", seen)
    got = {r.promo_id: (r.brand, r.n_lines, r.cents) for r in catalog_time.q_deliveries_in_promotions(spark, scratch).collect()}
    want = {}
    for i, brand, size in parts:
        fit = [] if brand is None or not size else [
            c for p, n, c, at in lines if n and at and p < 30 and parts[p][1] == brand
            and at < start + dt.timedelta(days=i + size) and start + dt.timedelta(days=i) < at + dt.timedelta(days=n)]
        if fit:
            known = [round(c * 100) for c in fit if c is not None]
            want[i] = (brand, len(fit), sum(known) if known else None)
    assert got == want and want
    assert joined[0] <= 2 * 44 * 6  # brands, days of shipment and whole days up to the delivery, not lines


@pytest.mark.parametrize("strict,block", [(False, 1), (True, 1), (False, 20), (True, 20), (False, None)])
def test_as_of_cuts_keys_by_time(spark, strict, block):
    """Keys and moments with most rows of both sides, null values, times of other types and a second key."""
    rng = random.Random(3)
    nan = float("nan")
    time = lambda: rng.choice([None, 7, 7, 7, 7, *range(20)])
    asked = [(i, *rng.choice([("hot", 1), ("hot", 1), ("hot", 2), ("b", None), (None, 1)]), time()) for i in range(150)]
    known = [(*rng.choice([("hot", 1), ("hot", 1), ("hot", 2), ("b", None)]), time(), rng.choice([None, 1.5, 2.5, nan]), rng.randint(0, 3)) for _ in range(120)]
    left = spark.createDataFrame(asked, "id int, k string, n int, t long")
    right = spark.createDataFrame(known, "k string, n long, rt int, v double, w int")
    out = as_of_join(left, right, ["k", "n"], "t", "rt", ["v", "w"], strict=strict, out_time="seen", block=block)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [("id", "int"), ("k", "string"), ("n", "int"), ("t", "bigint"), ("v", "double"),
                                                                          ("w", "int"), ("seen", "int")]
    got = {r.id: r for r in out.collect()}
    rank = lambda v: (v is not None, v is not None and v != v, v if v is not None and v == v else 0)
    for i, k, n, t in asked:
        fit = [(rt, rank(v), w, v) for rk, rn, rt, v, w in known if None not in (k, n, t, rt) and (rk, rn) == (k, n) and (rt < t if strict else rt <= t)]
        at, _, w, v = max(fit, key=lambda f: f[:3]) if fit else (None, None, None, None)
        assert str(tuple(got[i])) == str((i, k, n, t, v, w, at))
    assert len(got) == len(asked)


def test_as_of_without_keys(spark):
    left, right = spark.range(9).selectExpr("id", "id * 10 as t"), spark.range(20).selectExpr("id * 5 as rt", "id as v")
    for block in (1, None):
        got = as_of_join(left, right, [], "t", "rt", ["v"], strict=True, block=block).collect()
        assert sorted(map(tuple, got)) == [(i, 10 * i, 2 * i - 1 if i else None) for i in range(9)]


def test_large_keys_are_cut_into_cells_of_about_a_block(spark):
    from quarry.operators import asof

    rows = spark.range(4000).selectExpr("if(id < 3000, 'hot', concat('k', id % 100)) as _on0", "if(id % 3 = 0, 50, id) as _time")
    cuts = asof._cuts(rows, rows, ["_on0"], 100)
    assert [r._on0 for r in cuts.collect()] == ["hot"]
    counts = {(r._on0, r._cell): r["count"] for r in asof._celled(rows, cuts, ["_on0"], 100).groupBy("_on0", "_cell").count().collect()}
    assert counts.pop(("hot", 2 * cuts.first()._cuts.index(50) + 1)) >= 1000  # a cell of one moment, whose rows are spread
    assert max(n for (k, _), n in counts.items() if k == "hot") <= 300 and sum(n for (k, _), n in counts.items() if k == "hot") <= 2000
    assert asof._cuts(rows, rows, ["_on0"], 5000) is None


def test_price_as_of_order_stores_no_rows(spark, scratch, monkeypatch):
    from quarry.operators import asof, running
    from quarry.plans import catalog_time

    rng = random.Random(5)
    day = lambda: rng.choice([None, *(dt.datetime(1995, 1, 1) + dt.timedelta(days=d) for d in range(30))])
    lines = [(rng.choice([None, *range(80)]), i % 7, rng.choice([None, *range(12)]), rng.choice([None, 0.0, 1.0, 4.0]),
              rng.choice([None, 8.0, 10.0, 20.0]), day()) for i in range(400)]
    orders = [(rng.choice([None, *range(90)]), day()) for _ in range(100)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, "
                          "l_shipdate timestamp_ntz").write.parquet(f"{scratch}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp_ntz").write.parquet(f"{scratch}/orders.parquet")
    stored = []
    for module in (asof, running):
        monkeypatch.setattr(module, "materialize", lambda df: stored.append(df) or df, raising=False)
    out = catalog_time.q_price_as_of_order(spark, scratch)
    assert not stored  # no key has over a block of rows
    got = sorted(map(str, map(tuple, out.collect())))
    want = []
    for o, number, p, *_ in lines:
        for date in (d for k, d in orders if k == o and k is not None):
            seen = [s for _, _, q, _, _, s in lines if None not in (p, q, s, date) and q == p and s <= date]
            prices = [e / n for _, _, q, n, e, s in lines if seen and q == p and s == max(seen) and e is not None and n]
            want.append(str((o, number, p, date, max(prices, default=None), max(seen, default=None))))
    assert got == sorted(want) and len(got) > 300
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 3 and plan.count("Exchange") <= 1  # each side is dealt out by its key once, beside the join
