import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, anchor, relabel=None, scale=256, positives=5, most=3, low=50, high=95):
    data = []
    for i, x, label in rows:
        if x is None or label is None or any(v is None or not np.isfinite(v) for v in x):
            continue
        data.append((i, label if relabel is None else relabel(i, label), [int(np.floor(float(np.float32(v)) * scale)) for v in x]))
    out = []
    for n, (a, label, x) in enumerate(data):
        if not anchor(a):
            continue
        scored = sorted(((-sum(p * q for p, q in zip(x, y)), 2**63 if i is None else i, lab) for m, (i, lab, y) in enumerate(data) if m != n),
                        key=lambda t: t[:2])
        for s, p, _ in [t for t in scored if t[2] == label][:positives]:
            ps = -s
            found = [t for t in scored if t[2] != label and low * ps <= 100 * -t[0] <= high * ps][:most]
            out += [(a, p, r + 1, t[1], ps, -t[0]) for r, t in enumerate(found)]
    return sorted(out, key=str)


def shown(df):
    big = 2**63
    return sorted(((r.anchor_id, big if r.positive_id is None else r.positive_id, r.rank, big if r.negative_id is None else r.negative_id,
                    r.positive_score, r.negative_score) for r in df.collect()), key=str)


def clustered(n, seed, dimension=8, centres=12, labels=4):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dimension))
    x = c[rng.integers(0, centres, n)] + 0.1 * rng.normal(size=(n, dimension)) * rng.choice([1, 1, 4], (n, 1))
    return [(i, [float(np.float32(v)) for v in r], int(rng.integers(0, labels))) for i, r in enumerate(x)]


def test_many_leaves(spark, monkeypatch):
    """Small leaves and two levels, so that cells are pruned, split and searched on their own."""
    monkeypatch.setattr(negatives, "LEAF_ROWS", (8, 8))
    monkeypatch.setattr(negatives, "FAN", 5)
    data = clustered(400, 1)
    got = negatives.mine(spark.createDataFrame(data, SCHEMA), anchors=F.col("vec_id") % 10 == 0)
    assert shown(got) == plain(data, lambda i: i % 10 == 0)


def test_odd_vectors(spark):
    rng = random.Random(2)
    data = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.5, 1.0]) for _ in range(3)], rng.choice([0, 1, -1])) for i in range(60)]
    data += [(100, None, 1), (101, [1.0, None, 0.0], 1), (102, [1.0, float("nan"), 0.0], 1), (103, [float("inf"), 0.0, 0.0], 1),
             (104, [1.0, 1.0, 1.0], None), (5, [1.0, 1.0, 0.5], 0), (5, [1.0, 1.0, 0.5], 0), (None, [1.0, 1.0, 0.5], 1),
             (None, [1.0, 0.5, 0.5], 0), (106, [0.0, 0.0, 0.0], 1), (107, [1.0], 1), (108, [], 0), (109, [0.001, 300.0, -200.0], 1)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in data], SCHEMA + ", vec string, uid int, leaf int")
    assert shown(negatives.mine(df, positives=3)) == plain(data, lambda i: True, positives=3)
    assert negatives.mine(df.limit(0)).count() == 0
    assert negatives.mine(spark.createDataFrame([(1, [], 1), (2, [], 2)], SCHEMA)).count() == 0


def test_large_components(spark):
    data = [(i, [float(np.float32(x)) for x in (i * 1e5, 3e6 - i, 7.0)], i % 2) for i in range(12)]
    assert shown(negatives.mine(spark.createDataFrame(data, SCHEMA))) == plain(data, lambda i: True)


def test_one_long_vector_among_many(spark):
    """Its products need whole numbers, the others' do not."""
    data = clustered(150, 5) + [(500, [1e6] * 8, 1), (501, [-2e6, 3e6] * 4, 2), (502, [2e7, 0.0] * 4, 0)]
    assert shown(negatives.mine(spark.createDataFrame(data, SCHEMA))) == plain(data, lambda i: True)
    far = [(1, [1e30, 1.0], 1), (2, [1e30, 0.0], 1), (3, [1.0, 1.0], 2)]
    assert [tuple(r) for r in negatives.mine(spark.createDataFrame(far, SCHEMA)).collect()] == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = shown(queries.op11_gnat(spark, sf))
    assert got == plain(rows, lambda i: i % 50 == 0, lambda i, label: (label + 1) % 10 if i % 7 == 0 else label) and got


def test_siblings_are_pruned_and_none_is_lost():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 100
    x = centres[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 16))
    space = negatives.Space("<f8", 16, float((x * x).sum(axis=1).max()))
    lifted = space.lifted(x)
    tree = negatives.Tree(lifted, 2)
    cell, met = tree.descend(lifted)
    for points in tree.points:
        tree.low.append(None), tree.high.append(None)
    for node, far, child in met:
        tree.low[node], tree.high[node] = negatives.ranges(far, child)
    a = x[:60]
    flat, own2 = np.hstack([a, np.zeros((60, 1))]), (a * a).sum(axis=1)
    scores = a @ x.T
    top = np.sort(scores, axis=1)[:, -30]
    visits = tree.visits(flat, np.zeros(60), space.radius(own2, top), space.slack)
    seen = np.zeros((60, tree.cells), bool)
    for rows, c in visits:
        seen[rows, c] = True
    assert all(seen[i, cell[scores[i] >= top[i]]].all() for i in range(60))
    assert seen.mean() < 0.3


@pytest.mark.parametrize("k", [1, 3, 9])
def test_best(k):
    s = np.array([[1.0, 3.0, 3.0, -np.inf], [-np.inf] * 4])
    found = [(r, c) for rows, columns in negatives.best(s.copy(), k) for r, c in zip(rows.tolist(), columns.tolist())]
    assert found == [(0, 1), (0, 2), (0, 0)][:k]
