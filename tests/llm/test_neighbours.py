import numpy as np

from quarry.llm import neighbours, queries


def exact(rows, k=20, every=20):
    ok = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        ok[i] = min(ok.get(i, v), v)
    out = {}
    for q in ok:
        if q % every == 0:
            a = np.array(ok[q], dtype=float)
            near = sorted(((-float((a * np.array(v, dtype=float)).sum()), i) for i, v in ok.items() if i != q))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def shown(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_small_tables_are_exact(rows):
    rng = np.random.default_rng(0)
    data = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(300)]
    data += [(i, data[7][1]) for i in range(300, 340)]  # ties
    data += [(400, None), (420, []), (440, [0.0] * 8), (460, [float("nan")] + [1.0] * 7), (480, [float("inf")] + [1.0] * 7),
             (500, [None] + [1.0] * 7), (None, [1.0] * 8), (20, data[20][1])]
    df = rows(data, "vec_id long, embedding array<float>")
    assert shown(neighbours.search(df)) == exact(data)
    few = data[:5]
    assert shown(neighbours.search(rows(few, "vec_id long, embedding array<float>"))) == exact(few)
    assert shown(neighbours.search(df.limit(0))) == {}
    assert shown(neighbours.search(df.filter("vec_id = 440"))) == {}


def test_shorter_vectors_are_filled_up(rows):
    data = [(i, [float(i + 1), 1.0]) for i in range(30)] + [(40, [1.0, 2.0, 3.0]), (60, [5.0])]
    found = shown(neighbours.search(rows(data, "vec_id long, embedding array<double>")))
    assert found == exact([(i, v + [0.0] * (3 - len(v))) for i, v in data]) and 40 in found and 60 in found


def test_parts_of_one_bucket(rows):
    """Many equal vectors fall into one bucket, which is split over parts."""
    data = [(i, [1.0, 0.5, 0.25]) for i in range(5_000)] + [(i, [0.1, float(i % 7), 1.0]) for i in range(5_000, 5_200)]
    found = shown(neighbours.search(rows(data, "vec_id long, embedding array<double>"), part_rows=700))
    want = exact(data[:60] + data[-200:])
    for q in (0, 20, 40):
        assert [s for _, s in found[q]] == [s for _, s in want[q]]
    assert found[0][0][0] >= 5_000 or [i for i, _ in found[0]] == list(range(1, 21))


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    data = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    ids, x = np.array([i for i, _ in data]), np.array([v for _, v in data], dtype=float)
    found, hit = shown(queries.op2_multiprobe(spark, sf)), 0
    for q in ids[ids % 20 == 0]:
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        hit += len(set(ids[np.argsort(-s)[:20]]) & {i for i, _ in found[q]})
    assert hit / (20 * len(found)) >= 0.9


def test_directory_and_order_of_visits():
    d = neighbours.Directory(np.array([5, 2, 9]), np.array([10, 50, 3]), 20)
    assert d.cells.tolist() == [2, 5, 9] and d.chunks.tolist() == [3, 1, 1]
    assert set(d.part(np.array([2, 2, 2]), np.array([0, 1, 2])).tolist()) == {0, 1, 2}
    assert d.parts_of(np.array([0, 2])).tolist() == [0, 1, 2, d.first[2]]
    h = neighbours.Hashes(4, 2.0)
    x = np.random.default_rng(1).standard_normal((200, 4))
    x *= 2 / np.linalg.norm(x, axis=1)[:, None]
    cells = h.cells(x)
    costs = h.costs(x, np.unique(cells))
    own = np.searchsorted(np.unique(cells), cells)
    assert np.allclose(np.take_along_axis(costs, own, axis=1), 0)  # a vector's own buckets come first
