"""Kept statistics equal those computed anew; cubes equal Spark's own."""
import random
import statistics

import pytest
from pyspark.sql import functions as F

from quarry.operators import summaries
from quarry.operators.cube import cube_sets, grouped_sets, rollup_sets

SCHEMA = "day int, kind string, v double, who long"


def made(n, seed):
    rng = random.Random(seed)
    return [(rng.randint(1, 6), rng.choice(["hot", "hot", "a", None]), None if rng.random() < 0.1 else round(rng.gauss(50, 20), 2),
             rng.randint(1, 400)) for _ in range(n)]


def state_of(df):
    return summaries.summarise(df, ["day", "kind"], "v", "who")


def test_refreshes_equal_one_computation(spark, scratch):
    source, store, rows = f"{scratch}/in", f"{scratch}/store", []
    for n in range(3):
        more = made(2_000, n)
        rows += more
        spark.createDataFrame(more, SCHEMA).coalesce(2).write.mode("append").parquet(source)
        assert summaries.refresh(spark, source, store, state_of, ["day", "kind"]) == 2
    assert summaries.refresh(spark, source, store, state_of, ["day", "kind"]) == 0
    whole = spark.createDataFrame(rows, SCHEMA)
    exact = ["n", "total", "squares", "low", "high"]
    kept, anew = (sorted(map(tuple, df.select("day", "kind", *exact).collect()), key=str) for df in
                  (summaries.states(spark, store), state_of(whole)))
    assert kept == anew
    # coarser groups from the kept states
    got = {r.kind: r for r in summaries.finished(summaries.merge(summaries.states(spark, store).where("day <= 4"), ["kind"]),
                                                 {"median": 0.5, "high_end": 0.95}).collect()}
    for kind in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == kind and r[0] <= 4]
        values = sorted(r[2] for r in mine if r[2] is not None)
        row = got[kind]
        assert row.n == len(values) and float(row.low) == values[0] and float(row.high) == values[-1]
        assert row.mean == pytest.approx(statistics.fmean(values)) and row.stddev == pytest.approx(statistics.stdev(values))
        people = len({r[3] for r in mine})
        assert abs(row.approx_distinct - people) <= 5 * 1.04 / 2 ** (summaries.HLL_BITS / 2) * people
        for name, q in (("median", 0.5), ("high_end", 0.95)):
            rank = sum(v <= row[name] for v in values) / len(values)
            assert abs(rank - q) < 0.0165 + 1 / len(values)


def test_merging_is_associative(spark):
    parts = [state_of(spark.createDataFrame(made(300, s), SCHEMA)) for s in range(3)]
    both = lambda a, b: summaries.merge(a.unionByName(b), ["day", "kind"])
    shown = lambda df: sorted(map(tuple, summaries.finished(df).drop("approx_distinct").collect()), key=str)
    assert shown(both(both(parts[0], parts[1]), parts[2])) == shown(both(parts[0], both(parts[2], parts[1])))


def test_odd_states(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert summaries.finished(summaries.merge(state_of(empty), ["kind"])).count() == 0
    one = summaries.finished(state_of(spark.createDataFrame([(1, "a", 2.5, 1), (2, "a", None, None)], SCHEMA)), {"q": 0.5}).collect()
    assert sorted((r.day, r.n, r.stddev, r.q) for r in one) == [(1, 1, None, 2.5), (2, 0, None, None)]
    other = state_of(spark.createDataFrame(made(5, 1), SCHEMA)).withColumn("state_version", F.lit(0))
    with pytest.raises(Exception, match="version 0"):
        summaries.merge(other, ["kind"]).collect()


def test_a_failed_refresh_counts_nothing(spark, scratch):
    source, store = f"{scratch}/in", f"{scratch}/store"
    spark.createDataFrame(made(100, 1), SCHEMA).coalesce(1).write.parquet(source)
    bad = lambda df: state_of(df).withColumn("n", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        summaries.refresh(spark, source, store, bad, ["day", "kind"])
    assert summaries.refresh(spark, source, store, state_of, ["day", "kind"]) == 1
    assert summaries.states(spark, store).agg(F.sum("n")).first()[0] == sum(r[2] is not None for r in made(100, 1))


@pytest.mark.parametrize("sets", [cube_sets, rollup_sets])
def test_grouped_sets(spark, sets):
    rng = random.Random(9)
    rows = [(rng.choice(["x", "y", None]), rng.choice([1, 2, None]), rng.choice("pq"), rng.choice([None, 1, 2, 3, 4]), rng.randint(-5, 50))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "a string, b int, c string, v long, n long")
    got = grouped_sets(df, ["a", "b", "c"], sets(["a", "b", "c"]), {"n": F.col("n"), "rows": F.lit(1)}, "v")
    own = (df.cube if sets is cube_sets else df.rollup)("a", "b", "c").agg(
        F.grouping_id().cast("int").alias("g"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"), F.countDistinct("v").alias("d"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, own.select("a", "b", "c", "g", "n", "rows", "d").collect()), key=str)
    # the input is read once and copied only after its first reduction
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.rindex("Aggregate") and "Expand" not in plan
    assert grouped_sets(df.limit(0), ["a"], sets(["a"]), {}, "v").count() == 0
    with pytest.raises(ValueError):
        grouped_sets(df, ["a"], [["b"]], {}, "v")
