import random
from collections import defaultdict

import numpy as np
import pytest

from quarry.llm import queries, suffixes
from quarry.llm.common import alnum_words


def plain(rows, least):
    """Of every row by all windows: doc_id, n_words, n_repeated, n_later, spans, later, first_docs."""
    places, first = defaultdict(set), {}
    split = [alnum_words(t) for _, t in rows]
    for n, ((d, t), w) in enumerate(zip(rows, split)):
        for j in range(len(w) - least + 1):
            k = tuple(w[j:j + least])
            places[k].add((d, t if d is not None else n, j))
            first[k] = min(first.get(k, 2**63), 2**63 if d is None else d)
    out = []
    for (d, _), w in zip(rows, split):
        shared = [j for j in range(len(w) - least + 1) if len(places[tuple(w[j:j + least])]) > 1]
        before = [j for j in shared if first[tuple(w[j:j + least])] < (2**63 if d is None else d)]
        stretches = []
        for js in (shared, before):
            cover, spans = sorted({x for j in js for x in range(j, j + least)}), []
            for x in cover:
                if spans and spans[-1][1] == x:
                    spans[-1][1] = x + 1
                else:
                    spans.append([x, x + 1])
            stretches.append((len(cover), tuple(map(tuple, spans))))
        docs = tuple(sorted({first[tuple(w[j:j + least])] for j in shared} - {2**63}))
        out.append((d, len(w), stretches[0][0], stretches[1][0], stretches[0][1], stretches[1][1], docs))
    return sorted(out, key=str)


def shown(df):
    span = lambda x: tuple((s["first"], s["end"]) for s in x)
    return sorted(((r.doc_id, r.n_words, r.n_repeated, r.n_later, span(r.spans), span(r.later), tuple(r.first_docs)) for r in df.collect()),
                  key=str)


def made(n, seed):
    rng = random.Random(seed)
    letters = ["a", "b", "c"]
    pool = [[rng.choice(letters) for _ in range(rng.randint(5, 30))] for _ in range(6)]
    data = []
    for d in range(n):
        w = []
        for _ in range(rng.randint(0, 5)):
            w += rng.choice(pool) if rng.random() < 0.6 else [rng.choice(letters) for _ in range(rng.randint(0, 8))]
        data.append((d, " ".join(w)))
    return data + [(99, None), (3, data[3][1]), (98, ""), (None, data[5][1]), (None, data[5][1]), (4, data[6][1])]


@pytest.mark.parametrize("crowd", [suffixes.CROWD, 1])
def test_against_all_windows(rows, crowd):
    """Also where every shared gram counts as crowded (``crowd`` = 1)."""
    data = made(60, 5)
    found = suffixes.repeated_passages(rows(data, "doc_id long, text string"), 12, 4, crowd)
    assert shown(found) == plain(data, 12)


def test_cuts_take_only_what_stands_earlier(rows):
    """Rows that repeat an id are cut by their own spans, and every word that goes is in a passage of an earlier document."""
    data = [(i, t) for i, t in made(60, 8) if i is not None] + [(3, "a b"), (3, None)]
    docs = rows(data, "doc_id long, text string")
    kept = sorted(((r.doc_id, len(alnum_words(r.text))) for r in suffixes.without_repeats(docs, suffixes.repeated_passages(docs, 12, 4)).collect()))
    assert kept == sorted((d, n - later) for d, n, _, later, *_ in plain(data, 12))


@pytest.mark.parametrize("crowd", [suffixes.CROWD, 1])
def test_only_what_an_earlier_document_has_is_later(rows, crowd):
    words = lambda a, z: " ".join(f"a{i}" for i in range(a, z))
    docs = rows([(1, words(40, 90)), (5, words(0, 90)), (9, words(0, 90))], "doc_id long, text string")
    found = suffixes.repeated_passages(docs, crowd=crowd)
    by = {r.doc_id: r for r in found.collect()}
    assert (by[5].n_later, by[9].n_later, by[1].n_later) == (50, 90, 0) and by[9].first_docs == [1, 5]
    kept = {r.doc_id: r.text.split() for r in suffixes.without_repeats(docs, found).collect()}
    assert kept[5] == words(0, 40).split() and kept[9] == []


def test_rows_without_id_are_their_own(rows):
    text = " ".join(f"w{i}" for i in range(80))
    found = suffixes.repeated_passages(rows([(None, text), (None, text)], "doc_id long, text string")).collect()
    assert [(r.n_repeated, r.n_later, r.first_docs) for r in found] == [(80, 0, [])] * 2


def test_a_common_passage_counts_once(rows, monkeypatch):
    """Five times the documents around a common passage do not make five times its windows."""
    made_rows, store = [], suffixes.stored
    def counted(df, name):
        out = store(df, name)
        made_rows.extend([out.count()] if name == "windows" else [])
        return out

    monkeypatch.setattr(suffixes, "stored", counted)
    for n in (24, 120):
        words = lambda name, i: " ".join(f"{name}{i}x{j}" for j in range(45))
        data = [(i, f"{words('a', i)} {' '.join(f'p{j}' for j in range(70))} {words('z', i)}") for i in range(n)]
        found = suffixes.repeated_passages(rows(data, "doc_id long, text string"), crowd=1)
        assert shown(found) == plain(data, 50)
    assert 0 < made_rows[1] < 2 * made_rows[0]


def test_crowded_grams_over_several_batches(rows, spark):
    """A neighbour in another batch counts too; what only the context's own copies have stays."""
    data = made(60, 11)
    data += [(200 + i, data[i][1]) for i in range(0, 60, 3)]
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, "2")
    try:
        assert shown(suffixes.repeated_passages(rows(data, "doc_id long, text string"), 12, 4, 1)) == plain(data, 12)
    finally:
        spark.conf.set(batch, before)


def test_odd_documents(odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    found = suffixes.repeated_passages(odd_documents)
    assert shown(found) == plain(rows, 50)
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[7].first_docs == [6] and by_id[6].n_later == 0 and by_id[7].n_later == 30_000
    kept = {r.doc_id: r.text for r in suffixes.without_repeats(odd_documents, found).collect()}
    assert alnum_words(kept[7]) == [b"end"] and len(alnum_words(kept[6])) == 30_000
    assert suffixes.repeated_passages(no_documents).count() == 0
    with pytest.raises(ValueError):
        suffixes.repeated_passages(odd_documents, 10, 10)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert shown(queries.op5_suffixes(spark, sf)) == plain(rows, 50)


def test_word_hashes_differ():
    words = [b"a", b"a\x00", b"\x00a", b"\x00", b"aa", b"ab", b"ba", b"a\xc3\xa9"]
    table = bytes(range(256))
    h, first = suffixes.word_hashes([b" ".join(words), b"a"], table)
    assert len(set(h.tolist())) == len(words) and first.tolist() == [0, len(words), len(words) + 1] and h[-1] == h[0]


def test_every_window_has_a_minimiser():
    rng = np.random.default_rng(1)
    texts = [" ".join(f"v{x}" for x in rng.integers(0, 30, n)).encode() for n in (0, 11, 12, 13, 200, 500)]
    h, first = suffixes.word_hashes(texts)
    places, grams, before, after = suffixes.minimisers(h, first, 12, 4)
    assert len(set(h.tolist())) == 30
    for a, z in zip(first[:-1].tolist(), first[1:].tolist()):
        for s in range(a, z - 11):
            assert ((places >= s) & (places <= s + 8)).any()
    owner = np.searchsorted(first, places, side="right") - 1
    assert (places + 4 <= first[owner + 1]).all() and not (owner < 2).any()
