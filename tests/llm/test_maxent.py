import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quarry.llm import maxent, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 1


def base(rows):
    """doc_id, held_out, n_tokens, n_known, train_tokens and base score of each row."""
    split = [(d, WORD.findall((t or "").translate(ASCII)) + [None]) for d, t in rows]
    c = Counter(w for d, ws in split if not out(d) for w in ws)
    n, v = sum(c.values()), len(c)
    return [(d, out(d), len(ws), sum(w in c for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
            for d, ws in split]


def compare(df, rows):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in df.collect()), key=str)
    want = sorted(base(rows), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)


def test_odd_documents(odd_documents, no_documents, monkeypatch):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    compare(maxent.score(odd_documents), rows)
    monkeypatch.setattr(maxent, "KNOWN", 20)  # most counts come from the join
    compare(maxent.score(odd_documents), rows)
    assert maxent.score(no_documents).count() == 0


def test_nothing_to_learn_from(rows):
    data = [(i, "a b") for i in range(200) if out(i)][:3] + [(None, "c")]
    got = maxent.score(rows(data, "doc_id long, text string")).collect()
    assert {(r.held_out, r.n_known, r.train_tokens, r.base_score, r.score) for r in got} == {(True, 0, 0, 0.0, 0.0)}


def test_model_beats_counts_on_held_out_text(spark):
    sf = "/root/testdata/sf0.1"
    r = queries.op3_maxent(spark, sf).filter("held_out").toPandas()
    assert r.score.sum() > r.base_score.sum() + 0.1 * r.n_tokens.sum()


def test_updates_raise_the_likelihood():
    rng = np.random.default_rng(0)
    a, b = np.zeros((maxent.BEFORE * maxent.SHAPES, maxent.CLASSES)), np.zeros((maxent.BEFORE * maxent.GROUPS, maxent.FREQUENT))
    for c in rng.integers(0, len(a), 300):
        a[c, c % maxent.CLASSES] += 20
        a[c, rng.integers(0, maxent.CLASSES)] += 2
    for c in rng.integers(0, len(b), 100):
        b[c, c % maxent.FREQUENT] += 20
    w = maxent.Weights()
    before = (a * w.class_logs()).sum() + (b * w.member_logs()).sum()
    change, seen = maxent._updates(w, a, b, 8, 0.5)
    w.parts = [p + c for p, c in zip(w.parts, change)]
    after = (a * w.class_logs()).sum() + (b * w.member_logs()).sum()
    assert after > before + 0.3 * abs(before)
    assert np.allclose(np.exp(w.class_logs()[:50]).sum(axis=1), 1, atol=1e-4)
    assert np.allclose(np.exp(w.member_logs()[:50]).reshape(50, -1, maxent.MEMBERS).sum(axis=2), 1, atol=1e-4)


def test_contexts_do_not_cross_texts():
    token, shape, first = maxent.tokens([b"a bb", b"", b"ccc"])
    assert np.diff(first).tolist() == [3, 1, 2] and (token[first[1:] - 1] == maxent.END).all()
    before, skipped = maxent.contexts(np.full(len(token), -1), shape, first[:-1])
    end = maxent.FREQUENT + maxent.END_SHAPE
    assert before.tolist()[0] == end and before[3] == end and before[4] == end
    assert skipped[[0, 3, 4]].tolist() == [maxent.END_SHAPE] * 3
