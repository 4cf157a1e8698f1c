"""The edit-distance join against all pairs, and the split join against a plain one."""
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators.joins import grid_join
from quarry.operators.similar import candidates, similar_strings


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def made(n, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(0, 14))) for _ in range(n // 3)]
    out = list(base)
    while len(out) < n:
        s = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(s))
            s[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "c"])
        out.append("".join(s))
    return out + ["", "a", "ab", None]


@pytest.mark.parametrize("distance,q,dense", [(0, 2, 10**6), (1, 2, 2), (2, 3, 5)])
def test_against_all_pairs(spark, distance, q, dense):
    a, b = made(60, 1), made(60, 2) + made(60, 1)[:10]
    df = lambda x: spark.createDataFrame([(s,) for s in x], "name string")
    got = sorted(map(tuple, similar_strings(df(a), df(b), "name", "name", distance, q, dense).collect()))
    assert got == sorted((s, t, edits(s, t)) for s in set(a) - {None} for t in set(b) - {None} if edits(s, t) <= distance)


def test_few_candidates_and_empty(spark):
    names = spark.range(400).select(F.format_string("Customer#%09d", F.col("id") * 37).alias("s"))
    n = candidates(names, names, 1).count()
    assert n < 0.1 * 400 * 400
    assert similar_strings(names.limit(0), names, "s", "s").count() == 0
    with pytest.raises(ValueError):
        similar_strings(names, names, "s", "s", -1)


def test_one_edit_finds_pairs_only(spark):
    # names whose grams are all frequent: 100 with 9 replacements at each of two places
    names = spark.range(100).select(F.format_string("Customer#%09d", "id").alias("s"))
    assert candidates(names, names, 1).count() == 100 * (1 + 2 * 9)


@pytest.mark.parametrize("plain", [0, 9, 64])
def test_one_edit_with_and_without_grams(spark, plain):
    rng = random.Random(5)
    long = ["".join(rng.choice("ab") for _ in range(n)) for n in (61, 62, 63, 64, 65, 66)]
    long += [s[:i] + c + s[i + 1:] for s in long for i in (0, 30, len(s) - 1) for c in ("", "a", "bé")]
    a, b = long + made(40, 3), long[::2] + made(40, 4) + made(40, 3)[:10]
    df = lambda x: spark.createDataFrame([(s,) for s in x], "name string")
    got = sorted(map(tuple, similar_strings(df(a), df(b), "name", "name", 1, plain=plain).collect()))
    assert got == sorted((s, t, edits(s, t)) for s in set(a) - {None} for t in set(b) - {None} if edits(s, t) <= 1)


@pytest.mark.parametrize("dense", [1, 7])
def test_grid_join(spark, dense):
    rng = random.Random(3)
    a = [(rng.choice(["hot", "hot", "x", None]), i % 5) for i in range(40)]
    b = [(rng.choice(["hot", "hot", "x", "y", None]), i % 3) for i in range(30)]
    got = grid_join(spark.createDataFrame(a, "k string, v int"), spark.createDataFrame(b, "k string, w int"), ["k"], dense)
    assert sorted(map(tuple, got.collect())) == sorted((k, v, w) for k, v in a for j, w in b if k is not None and k == j)
