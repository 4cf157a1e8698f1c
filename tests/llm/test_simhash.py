import re

import numpy as np
import pytest
import xxhash

from quarry.llm import queries, simhash
from quarry.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    words = WORD.findall((text or "").translate(ASCII))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def expected(rows):
    fps = np.array([fingerprint(t) for _, t in rows], np.uint64)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps) <= 3).tolist():
            parent[max(find(i), find(j))] = min(find(i), find(j))
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, f"{fps[i]:016x}", low.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def shown(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_odd_documents(odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert shown(simhash.near_duplicates(odd_documents)) == expected(rows)
    assert shown(simhash.near_duplicates(no_documents)) == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert shown(queries.op4_simhash(spark, sf)) == expected(rows)


def clustered(seed, centres, members, spread):
    rng = np.random.default_rng(seed)
    out = set()
    for c in rng.integers(0, 2**63, centres).tolist():
        for _ in range(members):
            x = int(c)
            for k in rng.integers(0, 64, rng.integers(0, spread)).tolist():
                x ^= 1 << k
            out.add(x)
    return np.array(sorted(out), np.uint64)


def ranks(codes):
    for s in (1, 2, 4, 8, 16, 32):
        codes = codes ^ (codes >> np.uint64(s))
    return codes


@pytest.mark.parametrize("groups, budget", [(1, 3_000), (9, 1 << 21), (700, 50)])
def test_index_finds_exactly_the_close_pairs(groups, budget):
    codes = clustered(5, 30, 60, 6)
    keys = np.random.default_rng(2).integers(0, groups, len(codes))
    order = np.lexsort([ranks(codes), keys])
    codes, keys = codes[order], keys[order]
    got = [p for a, b in simhash.linked(keys, codes, 3, budget) for p in zip(a.tolist(), b.tolist())]
    near = (np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 3) & (keys[:, None] == keys[None, :])
    assert len(got) == len(set(got))
    assert set(got) == {(i, j) for i, j in zip(*np.nonzero(near)) if i < j}


@pytest.mark.parametrize("chunk", [1 << 14, 20])
def test_links_connect_what_is_close(rows, chunk):
    """Also when roots are cut into chunks (``chunk`` = 20)."""
    codes = clustered(8, 12, 50, 5)
    nodes = rows([(int(c),) for c in codes.view(np.int64)], "fp long")
    edges = simhash.links(nodes, chunk=chunk)
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") for a, b in edges.collect())
    roots = {r.node: r.root for r in components(edges).collect()}
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 3
    label = np.arange(len(codes))
    while True:
        after = np.array([label[n].min() for n in near])
        if (after == label).all():
            break
        label = after
    signed = codes.view(np.int64)
    mine = {int(c): roots.get(int(c), int(c)) for c in signed}
    for group in np.unique(label):
        members = signed[label == group].tolist()
        assert {mine[m] for m in members} == {min(members)} or len(members) == 1


def test_components_of_paths_stars_and_loops(rows):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (301, 300), (300, 301)]
    got = {r.node: r.root for r in components(rows(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 300: 300, 301: 300}
    assert components(rows([], "a long, b long")).count() == 0


def test_one_row_of_each_component_stays(odd_documents, no_documents):
    kept = simhash.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    # 1, 2 and 3 have no words; 4 and 5 are alike; 6 and 7 nearly so; a null id without words is linked to 1
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    want = sorted({r.component_id for r in simhash.near_duplicates(odd_documents).collect()}, key=str)
    assert ids == want and ids.count(4) == 1 and None in ids and 5 not in ids
    assert simhash.keep_one(no_documents).count() == 0


def test_limit_is_what_the_blocks_cover(rows):
    with pytest.raises(ValueError):
        simhash.links(rows([(1,)], "fp long"), limit=4)


def test_repeated_ids_lose_no_component(rows):
    """Ids that stand for different texts: one row stays of each component, and the same at each run."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    data = [(1, a), (1, b), (2, b), (3, c), (1, c), (3, c), (4, "lone text of its own words"), (None, a), (None, "no id at all here now")]
    docs = rows(data, "doc_id long, text string")
    kept = [tuple(r) for r in simhash.keep_one(docs).collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (1, b), (1, c), data[6], data[8]], key=str)
    assert sorted(map(tuple, simhash.keep_one(docs.repartition(5)).collect()), key=str) == sorted(kept, key=str)
