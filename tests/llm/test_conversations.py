import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from quarry.llm import conversations, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows, group=20, heads=4):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        whole = tuple(own.get(c - int(np.fmod(c, group)), [])[:h] + t[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].add(c)
        ends[whole].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)

    def words(k):
        return len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0

    out = {}
    for k in sorted(members, key=len, reverse=True):
        leaves, saved = int(not children[k]), (len(members[k]) - 1) * words(k)
        for x in children[k]:
            leaves, saved = leaves + out[x][0], saved + out[x][1]
        out[k] = leaves, saved
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), *out[k],
                   hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items())


def shown(df):
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in df.collect())


def test_against_plain(spark):
    rng = random.Random(3)
    rows = []
    for c in [*range(0, 70), -5, -40, 1000, 1001]:
        if c % 23 == 20:
            continue
        for t in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, rng.choice([t, t, t, None]) if t == 0 else t, rng.choice(["user", "bot", None]),
                         rng.choice(["hi", "hello there you", "", None, "ok  then", "x\x0by"])))
    rows += [(None, 1, "user", "no id"), (7, 1, "user", "tie"), (7, 1, "user", "tie"), (7, 1, "bot", "tie")]
    # long copies of one another, so that deep stretches are shared
    rows += [(c, t, "user", f"w {t}") for c in (2000, 2020, 2040) for t in range(60 - (c == 2040) * 25)]
    assert shown(conversations.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_empty_and_extra_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert conversations.prefix_trie(none).count() == 0
    assert conversations.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0
    rows = [(1, 0, "u", "a b"), (2, 0, "u", "a b"), (3, None, None, None)]
    extra = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", d int, at int, e1 int")
    assert shown(conversations.prefix_trie(extra)) == plain(rows)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert shown(queries.op12_prefix_trie(spark, sf)) == plain(rows)


def test_fingerprints_form_a_monoid():
    rng = np.random.default_rng(0)
    e1, e2 = rng.integers(-2**62, 2**62, (2, 12))

    def whole(n, m):
        """The fingerprint of turns n .. m, by its definition."""
        values = [v[n:m] for v in conversations.lane_values(e1, e2)]
        return m - n, [sum(int(x) * pow(b, i, conversations.PRIME) for i, x in enumerate(v)) % conversations.PRIME
                       for v, b in zip(values, conversations.bases())]

    for a, b, c in [(0, 0, 0), (0, 5, 12), (3, 3, 9), (2, 7, 7)]:
        assert conversations.combine(whole(a, b), whole(b, c)) == whole(a, c)
    x, y, z = whole(0, 4), whole(4, 9), whole(9, 12)
    assert conversations.combine(conversations.combine(x, y), z) == conversations.combine(x, conversations.combine(y, z))
    at = np.array([0, 1, 5, -3, 2**40])
    for b in conversations.bases():
        assert conversations.power(b, at).tolist() == [pow(b, int(x), conversations.PRIME) for x in at]


def test_collisions_are_found(spark, monkeypatch):
    """With one poor base for all lanes (x + y = y + x) prefixes collide; the check sees it and other bases are tried."""
    real = conversations.bases
    tried = []

    def poor(attempt=0):
        tried.append(attempt)
        return [1, 1, 1, 1] if attempt == 0 else real(attempt)

    monkeypatch.setattr(conversations, "bases", poor)
    rows = [(1000, 0, "u", "a"), (1000, 1, "u", "b"), (1000, 2, "u", "c"), (1000, 3, "u", "d"), (1000, 4, "u", "e"), (1000, 5, "u", "f"),
            (2000, 0, "u", "a"), (2000, 1, "u", "b"), (2000, 2, "u", "c"), (2000, 3, "u", "d"), (2000, 4, "u", "f"), (2000, 5, "u", "e")]
    assert shown(conversations.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
    assert 1 in tried
    monkeypatch.setattr(conversations, "bases", lambda attempt=0: [1, 1, 1, 1])
    with pytest.raises(RuntimeError):
        conversations.prefix_trie(spark.createDataFrame(rows, SCHEMA), attempts=2).collect()
