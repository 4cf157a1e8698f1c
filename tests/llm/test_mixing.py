import itertools
import random
from collections import Counter, defaultdict

import pytest

from quarry.llm import mixing, queries


def test_releases_deadlines_and_distance():
    rng = random.Random(0)
    for _ in range(200):
        weights = mixing.whole([rng.random() ** 3 + 1e-4 for _ in range(rng.randint(1, 12))])
        total, had = sum(weights), [0] * len(weights)
        for t, i in enumerate(itertools.islice(mixing.deal(weights, [10 ** 9] * len(weights)), 200)):
            j, w = had[i], weights[i]
            assert j * total // w <= t < -(-(j + 1) * total // w)  # release and deadline of its j-th block
            had[i] += 1
            assert all(abs(n * total - w * (t + 1)) < total for n, w in zip(had, weights))


def by_slot(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r.slot].append(r)
    return out


def check(rows, sizes, block, weights):
    """Whole schedule: each slot is one block of one source, every document comes, no source is a block away from its share."""
    total = sum(weights.values())
    assert sorted(rows) == list(range(len(rows)))
    had = Counter()
    for t in range(len(rows)):
        assert len({(r.source, r.block, r.epoch) for r in rows[t]}) == 1
        assert sorted(r.place for r in rows[t]) == list(range(len(rows[t]))) and len(rows[t]) <= block
        had[rows[t][0].source] += 1
        for s, w in weights.items():
            assert abs(had[s] - (t + 1) * w / total) < 1 + 1e-9
    blocks = {s: -(-n // block) for s, n in sizes.items()}
    assert all(had[s] >= blocks[s] for s in sizes) and any(had[s] == blocks[s] for s in sizes)


@pytest.mark.parametrize("frame", [40, 2_000])
def test_small_schedule(rows, frame):
    """Also over several frames (``frame`` = 40)."""
    data = [(i, "big") for i in range(400)] + [(i, "mid") for i in range(400, 460)] + [(i, None) for i in range(460, 467)]
    weights = {"big": 0.5, "mid": 0.3, None: 0.2}
    df = mixing.schedule(rows(data, "doc_id long, source string"), weights, block_docs=4, frame=frame)
    check(by_slot(df), Counter(s for _, s in data), 4, weights)
    per_doc = Counter(r.doc_id for r in df.collect())
    assert set(per_doc) == {i for i, _ in data} and set(Counter(per_doc[i] for i, s in data if s == "big")) == {1}
    with pytest.raises(ValueError):
        mixing.schedule(rows(data, "doc_id long, source string"), {"big": 1.0, "mid": 1.0})


def test_odd_documents(odd_documents, no_documents):
    df = mixing.schedule(odd_documents)
    assert df.columns == [c for c in odd_documents.columns if c != "slot"] + ["slot", "place", "block", "epoch"]
    once = df.filter("epoch = 0").drop("slot", "place", "block", "epoch")
    want = sorted((tuple(r) for r in odd_documents.drop("slot").collect()), key=str)
    assert sorted(map(tuple, once.collect()), key=str) == want
    assert mixing.schedule(no_documents).count() == 0
    out = mixing.mixed(odd_documents)  # a column named like the schedule's stays
    assert out.columns == odd_documents.columns
    assert sorted(map(tuple, out.distinct().collect()), key=str) == sorted(map(tuple, odd_documents.distinct().collect()), key=str)


def test_query(spark):
    sf = "/root/testdata/sf0.1"
    docs = {r.doc_id: r.source for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source").collect()}
    found = by_slot(queries.op8_pfair(spark, sf))
    sizes = Counter(docs.values())
    check(found, sizes, mixing.BLOCK_DOCS, {s: n ** 0.7 for s, n in sizes.items()})
    assert {r.doc_id for rows in found.values() for r in rows} == set(docs)


def test_mixed_rows_are_in_turn_order(spark, rows):
    data = [(i, f"s{i % 3}") for i in range(500)]
    df = rows(data, "doc_id long, source string")
    turn = {r.doc_id: (r.slot, r.place) for r in mixing.schedule(df).filter("epoch = 0").collect()}
    out = [r.doc_id for r in mixing.mixed(df, exponent=1.0).collect()]
    assert sorted(out) == sorted(turn) and out == sorted(out, key=turn.get)


def far(turns, weights):
    """Largest distance of any source from its exact share, in blocks, over all slots."""
    total, had, worst = sum(weights), [0] * len(weights), 0
    for t, i in enumerate(turns, 1):
        had[i] += 1
        worst = max(worst, *(abs(n * total - t * w) for n, w in zip(had, weights)))
    return worst / total


def test_distance_stays_under_one_block_however_long_the_schedule():
    rng = random.Random(1)
    for n in (2, 20, 50):
        weights = mixing.whole([rng.random() ** 3 + 1e-4 for _ in range(n)])
        turns = itertools.islice(mixing.deal(weights, [10 ** 9] * n), 20_000)
        assert far(turns, weights) < 1


def test_schedule_of_many_frames_follows_the_exact_weights(rows):
    """A source with a third of the rows and one of 8 rows, over many frames: the bound does not grow with the slot."""
    data = [(i, "hot") for i in range(6_000)] + [(i, f"s{i % 18}") for i in range(6_000, 17_992)] + [(i, "tiny") for i in range(17_992, 18_000)]
    sizes = Counter(s for _, s in data)
    names = sorted(sizes)
    weights = mixing.whole([sizes[s] ** 0.7 for s in names])
    found = by_slot(mixing.schedule(rows(data, "doc_id long, source string"), frame=100))
    assert sorted(found) == list(range(len(found))) and len(found) > 2_000
    turns = [names.index(found[t][0].source) for t in range(len(found))]
    assert far(turns, weights) < 1
    check(found, sizes, mixing.BLOCK_DOCS, {s: n ** 0.7 for s, n in sizes.items()})


def test_more_sources_than_a_frame_has_turns(rows):
    data = [(i, f"site{i % 2_500}") for i in range(5_003)]
    found = by_slot(mixing.schedule(rows(data, "doc_id long, source string")))
    assert {r.doc_id for x in found.values() for r in x} == {i for i, _ in data}
    assert sorted(found) == list(range(len(found)))
