import hashlib
import random
import re

import pytest

from quarry.llm import decontaminate, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(ASCII))


def plain(text, items, window=10):
    w, hit, names = words(text), set(), set()
    for name, item in items:
        own = words(item)
        k = min(window, len(own))
        wins = {tuple(own[i:i + k]) for i in range(len(own) - k + 1)} if k else set()
        for i in range(len(w) - k + 1):
            if k and tuple(w[i:i + k]) in wins:
                hit |= set(range(i, i + k))
                names |= {str(name)} if name is not None else set()
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


def test_automaton_against_all_windows():
    rng = random.Random(4)
    for trial in range(300):
        letters = [b"a", b"b", b"c"][:rng.choice([1, 2, 3])]
        window = rng.choice([2, 3, 5, 10])
        items = [(str(i), [rng.choice(letters) for _ in range(rng.randint(trial % 2 * 2, 14))]) for i in range(rng.randint(0, 5))]
        text = [rng.choice([*letters, b"z"]) for _ in range(rng.randint(0, 60))]
        spans, names = decontaminate.Automaton(items, window).find(text)
        as_text = [(n, b" ".join(w).decode()) for n, w in items]
        want = plain(b" ".join(text).decode(), as_text, window)
        assert (sum(e - a for a, e in spans), len(names)) == want[1:3]
        assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


@pytest.fixture(scope="module")
def benchmark_items(spark):
    data = [(1, "one two three four"), (2, ""), (3, None), (None, "no id here"), (4, " ".join(f"W{i}" for i in range(40, 80))),
            (4, " ".join(f"W{i}" for i in range(40, 80))), (10, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14")]
    return spark.createDataFrame(data, "item_id long, text string")


@pytest.mark.parametrize("block", [100_000, 12])
def test_odd_documents(odd_documents, no_documents, benchmark_items, block):
    """Also with several automata (``block`` = 12 words), whose findings are merged."""
    items = [tuple(r) for r in benchmark_items.collect()]
    got = decontaminate.digest(decontaminate.findings(odd_documents, benchmark_items, block_words=block)).collect()
    want = [(r.doc_id, *plain(r.text, items)) for r in odd_documents.collect()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert decontaminate.findings(no_documents, benchmark_items, block_words=block).count() == 0
    empty = decontaminate.digest(decontaminate.findings(odd_documents, benchmark_items.limit(0))).collect()
    assert not any(r.contaminated or r.n_items for r in empty) and len(empty) == odd_documents.count()


def test_spans_are_cut_or_rows_dropped(odd_documents, benchmark_items):
    cut = decontaminate.clean(odd_documents, benchmark_items, max_coverage=1.0)
    assert cut.columns == odd_documents.columns and cut.count() == odd_documents.count()
    assert not any(r.contaminated for r in decontaminate.digest(decontaminate.findings(cut, benchmark_items)).collect())
    dropped = {r.doc_id for r in decontaminate.clean(odd_documents, benchmark_items).collect()}
    assert dropped == {1, 2, 3, None, 8, 9}
    some = {r.doc_id for r in decontaminate.clean(odd_documents, benchmark_items, max_coverage=0.5).collect()}
    assert {6, 7} <= some and not {4, 5} & some
    assert decontaminate.remove_spans("A b, c! d", [(1, 3)]) == "A ! d"


def test_query_against_sql_and_plain(spark):
    import duckdb
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = sorted(map(tuple, queries.op10_automaton(spark, sf).collect()))
    assert got == sorted(con.execute(queries.ORACLE_SQL["op10_automaton"]).fetchall())
    assert any(r[-1] for r in got)


def test_several_automata_clean_as_one(spark):
    """Coverage and cuts are those of all items together, however the benchmark is cut into blocks."""
    word = lambda a, z: " ".join(f"v{i}" for i in range(a, z))
    items = spark.createDataFrame([(1, word(0, 15)), (2, word(8, 20)), (3, word(40, 55)), (4, word(70, 82)), (5, word(200, 230))],
                                  "item_id long, text string")
    data = [(1, f"start {word(0, 20)} end"), (2, word(0, 15) + " between " + word(40, 55) + " " + word(300, 320)),
            (3, word(70, 82) + " " + word(300, 400)), (4, f"v0 {word(200, 230)} v1 v2"), (4, "other text"), (None, word(30, 60)),
            (5, None), (6, word(0, 8) + " " + word(40, 55) + " " + word(8, 20))]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    for coverage in (0.0, 0.5, 1.0):
        want = sorted(map(tuple, decontaminate.clean(docs, items, max_coverage=coverage).collect()), key=str)
        for block in ((1, 20) if coverage == 0.5 else (20,)):
            got = decontaminate.clean(docs, items, max_coverage=coverage, block_words=block)
            assert got.columns == docs.columns
            assert sorted(map(tuple, got.collect()), key=str) == want
