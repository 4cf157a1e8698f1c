import random
import zlib
from collections import defaultdict

import pytest

from quarry.llm import queries, sharding


def plain(nodes, shards, first=0):
    """The same tree by sorting: name -> shard.  Nodes have a place along each dimension, tie, bytes and name."""
    if shards == 1 or not nodes:
        return {n["name"]: first for n in nodes}
    width = {d: max(n[d] for n in nodes) - min(n[d] for n in nodes) for d in sharding.DIMENSIONS}
    along = max(sharding.DIMENSIONS, key=lambda d: width[d])
    nodes = sorted(nodes, key=lambda n: (n[along], n["tie"]))
    goal, total, half = max(1, -(-sum(n["bytes"] for n in nodes) * (shards // 2) // shards)), 0, shards // 2
    for i, n in enumerate(nodes):
        total += n["bytes"]
        if total >= goal:
            break
    if i and goal - (total - n["bytes"]) < total - goal:
        i -= 1
    return plain(nodes[:i + 1], half, first) | plain(nodes[i + 1:], shards - half, first + half)


def check(got, texts, shards):
    """Every row once, slots without gaps, sizes and sums of the whole text."""
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (i is not None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))


@pytest.mark.parametrize("shards,bins,finish", [(3, 2, 1), (8, 4096, 1 << 16)])
def test_tree_against_sorting(spark, monkeypatch, shards, bins, finish):
    monkeypatch.setattr(sharding, "BINS", bins)
    monkeypatch.setattr(sharding, "FINISH", finish)
    rng = random.Random(shards)
    data = [(i, rng.choice([1, 5, 100, 3000]), rng.randint(0, 2**31 - 1), rng.choice([3, 3, 9, 11]), 7, rng.randint(1, 10**6), i)
            for i in range(150)]
    nodes = spark.createDataFrame(data, "unit long, bytes long, tie long, in_source long, in_lang long, in_size long, in_id long")
    names = ["name", "bytes", "tie", *sharding.DIMENSIONS]
    want = [dict(zip(names, r)) for r in data]
    for d in sharding.DIMENSIONS:
        low, high = min(n[d] for n in want), max(n[d] for n in want)
        for n in want:
            n[d] = int((n[d] - low) / max(high - low, 1) * (sharding.STEPS - 1))
    got = {r.unit: r.shard for r in sharding.cut(nodes, shards).collect()}
    assert got == plain(want, shards)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_kd_shards(spark, sf).collect()
    check(got, texts, 8)
    total, of = defaultdict(int), defaultdict(set)
    for r in got:
        total[r.shard] += r.size
        of[r.text_crc32, r.size].add(r.shard)
    largest = max(r.size for r in got)
    assert len(total) == 8 and max(total.values()) - min(total.values()) <= 3 * largest
    # copies stay together unless they are too many for one shard
    copies = defaultdict(int)
    for r in got:
        copies[r.text_crc32, r.size] += r.size
    limit = sum(total.values()) * sharding.UNIT / 8
    assert all(len(s) == 1 for k, s in of.items() if copies[k] <= limit)


def test_hot_unit_is_cut(rows):
    texts = [(i, "copy " * 40) for i in range(400)] + [(400 + i, f"text {i} " * 20) for i in range(400)]
    got = sharding.shard(rows(texts, "doc_id long, text string"), 8).collect()
    check(got, texts, 8)
    total = defaultdict(int)
    for r in got:
        total[r.shard] += r.size
    assert max(total.values()) < 1.05 * min(total.values())


def test_odd_documents(odd_documents, no_documents, rows):
    texts = [(r.doc_id, r.text) for r in odd_documents.collect()]
    check(sharding.shard(odd_documents, 8).collect(), texts, 8)
    check(sharding.shard(odd_documents, target_bytes=200_000).collect(), texts, 4)
    assert sharding.shard(no_documents, 8).count() == 0
    same = [(1, "a")] * 20
    check(sharding.shard(rows(same, "doc_id long, text string"), 8).collect(), same, 8)
    with pytest.raises(ValueError):
        sharding.shard(odd_documents, 0)


def test_no_python_on_the_path(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = sharding.shard(docs, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
