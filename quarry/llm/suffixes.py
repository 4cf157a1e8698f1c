"""Repeated passages through sparse suffix arrays.

Of all suffixes only those are kept that start at a minimiser: the smallest hash
of ``GRAM`` words in some window of ``least`` words.  Equal windows choose equal
positions, so two occurrences of a passage of at least ``least`` words keep a
suffix at the same place in it.  Kept suffixes are grouped by the gram they start
with and sorted by the words that follow; neighbours are compared, and matches
are extended to the left and to the right until every window of ``least`` words
that contains the gram and stands elsewhere too is found.

Most suffixes need no sort.  Those with equal contexts (the words of all those
windows) are counted first, with partial counts before the shuffle, so copies in
any number cost no more than one; a context that stands at several places is
matched as a whole.  Only suffixes that share a gram but not the context are
sorted, one for each context, and what is found for it holds for all its copies.  A
gram with very many contexts is not sorted in one task: its contexts are sorted in
several tasks, cut to the words that a neighbour has too, and those that are then equal
count as one; if very many are left, each window's hash is counted.  All ways give the same spans: for each partner (the first document of
a set of equal windows) the windows shared with it, which all contain the gram and
so form one stretch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import ALNUM_BYTES, ship, small_batches, stored, texts_of
from quarry.llm.decontaminate import remove_spans

LEAST, GRAM = 50, 10
CROWD = 1 << 12
_R = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit depends on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    name = f"{base}"
    if name not in _POWERS or len(_POWERS[name]) < n:
        steps = np.full(max(n, 1 << 16), base & (2**64 - 1), dtype=np.uint64)
        steps[0] = 1
        _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS[name][:n]


def word_hashes(texts: list[bytes | None], table: bytes = ALNUM_BYTES, with_ends: bool = False) -> tuple[np.ndarray, ...]:
    """A 64-bit hash of every word of all texts in a row, and the place of each text's first word (length n + 1).
    Words are what ``table`` does not map to a space.  ``with_ends``: also each word's last two bytes as a number."""
    data = b" ".join([b" ", *(t or b"" for t in texts)]).translate(table)
    sizes = np.fromiter((len(t or b"") for t in texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
    data = np.frombuffer(data, np.uint8)
    letter = data != 32
    starts = np.flatnonzero(letter & ~np.concatenate([[False], letter[:-1]]))
    first = np.searchsorted(starts, offsets + 1)
    if not len(starts):
        h = np.zeros(0, np.uint64)
        return (h, first, h) if with_ends else (h, first)
    # one more than the byte, as a zero byte must count too
    values = (data.astype(np.uint64) + letter) * letter * _powers(_R, len(data))
    h = _mix(np.add.reduceat(values, starts) * _powers(pow(_R, -1, 1 << 64), len(data))[starts])
    if not with_ends:
        return h, first
    ends = np.flatnonzero(letter & ~np.concatenate([letter[1:], [False]]))
    # a word of one byte has the space before it
    return h, first, data[ends].astype(np.int64) << 8 | data[ends - 1]


def _running(h: np.ndarray, base: int) -> np.ndarray:
    """Sums of h weighted by powers of the base, before each place and at the end."""
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _powers(base, len(h)), dtype=np.uint64)])


def _sums(h: np.ndarray, size: int, base: int) -> np.ndarray:
    """Order-dependent hashes of every ``size`` neighbours (the last size - 1 places are not meant to be used)."""
    scaled = _running(h, base)
    end = np.minimum(np.arange(len(h)) + size, len(h))
    return _mix((scaled[end] - scaled[:-1]) * _powers(pow(base, -1, 1 << 64), len(h)))


def _slide(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minimum (or maximum) of x over [i, i + width), for each i with a whole window."""
    best, have = x, 1
    pick = np.minimum if least else np.maximum
    while have < width:
        step = min(have, width - have)
        best = pick(best[:len(best) - step], best[step:])
        have += step
    return best


def minimisers(h: np.ndarray, first: np.ndarray, least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Places (in all words) of the kept suffixes, the hash of the gram at each, and how many words before and from
    there on belong to windows that chose it.  (Other windows with the gram have it only by chance: an equal window
    elsewhere may not keep it.)"""
    n, width = len(h), least - gram + 1
    if n < least:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = _sums(h, gram, _R) | np.uint64(1)
    low = _slide(grams, width, True)[:n - least + 1]
    # windows that cross from one text to the next do not count
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    low = np.where(text[:n - least + 1] == text[least - 1:], low, np.uint64(0))
    padded = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)])
    chosen = np.flatnonzero(_slide(padded, width, False)[:n - gram + 1] == grams[:n - gram + 1])
    # windows that start 0 .. width - 1 words before it and have no smaller gram; they follow one another
    own = np.lib.stride_tricks.sliding_window_view(padded, width)[chosen] == grams[chosen, None]
    before, least_before = width - 1 - own.argmax(axis=1), own[:, ::-1].argmax(axis=1)
    return chosen, grams[chosen], before, least - least_before


def _suffixes(docs: DataFrame, least: int, gram: int) -> DataFrame:
    """uid, doc_id, row, gram, context, pos, before, after of every kept suffix; and a row for each document, with gram null and pos its words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", 1 << 20):
            h, first = word_hashes(texts_of(b, "text"))
            places, grams, before, after = minimisers(h, first, least, gram)
            rows, text = np.arange(b.num_rows), np.searchsorted(first, places, side="right") - 1
            low, high = places - before, places + after
            sums = _running(h, _R)
            inverse = _powers(pow(_R, -1, 1 << 64), len(h) + 1)
            # the place of the gram in its context is part of the context
            context = _mix((sums[high] - sums[low]) * inverse[low] + (places - low).astype(np.uint64) * np.uint64(_R))
            who = pa.array(np.concatenate([rows, text]))
            none = pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("uid").take(who), b.column("doc_id").take(who), b.column("row").take(who),
                 pa.concat_arrays([none, pa.array(grams.view(np.int64))]), pa.concat_arrays([none, pa.array(context.view(np.int64))]),
                 pa.array(np.concatenate([np.diff(first), places - first[text]]).astype(np.int64)),
                 *(pa.array(np.concatenate([np.zeros(len(rows)), x]).astype(np.int16)) for x in (before, after))],
                ["uid", "doc_id", "row", "gram", "context", "pos", "before", "after"])

    return docs.mapInArrow(run, "uid long, doc_id long, row long, gram long, context long, pos long, before short, after short")


def _contexts(docs: DataFrame, wanted: DataFrame, least: int, gram: int) -> DataFrame:
    """The words around the wanted suffixes: ``before`` (nearest first) and ``after`` as 32-bit hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", 1 << 20):
            h, first = word_hashes(texts_of(b, "text"))
            short = (h >> np.uint64(32)).astype("<u4")
            marks = b.column("marks")
            who = np.repeat(np.arange(b.num_rows), np.diff(np.asarray(marks.offsets)))
            flat = marks.flatten()
            places = np.asarray(flat.field("pos")) + first[who]
            low, high = places - np.asarray(flat.field("before")), places + np.asarray(flat.field("after"))
            before = [short[a:p][::-1].tobytes() for a, p in zip(low.tolist(), places.tolist())]
            after = [short[p:z].tobytes() for p, z in zip(places.tolist(), high.tolist())]
            take = pa.array(who)
            yield pa.RecordBatch.from_arrays(
                [b.column("uid").take(take), b.column("doc_id").take(take), flat.field("gram"), flat.field("context"),
                 flat.field("pos"), flat.field("crowd"), flat.field("many"), pa.array(before, pa.binary()), pa.array(after, pa.binary())],
                ["uid", "doc_id", "gram", "context", "pos", "crowd", "many", "before", "after"])

    marks = wanted.groupBy("uid").agg(F.collect_list(F.struct("gram", "context", "pos", "before", "after", "crowd", "many")).alias("marks"))
    return docs.join(marks, "uid").select("uid", "doc_id", "text", "marks").mapInArrow(
        run, "uid long, doc_id long, gram long, context long, pos long, crowd boolean, many boolean, before binary, after binary")


def _padded(values: list[bytes], width: int) -> np.ndarray:
    """Word hashes as rows of equal width; places beyond an end differ from all words and from each other's rows."""
    out = np.zeros((len(values), width), dtype=np.uint64)
    for i, v in enumerate(values):
        words = np.frombuffer(v, "<u4")
        out[i, :len(words)] = words.astype(np.uint64) + np.uint64(1)
        out[i, len(words):] = np.uint64(1 << 40) + np.uint64(i)
    return out


def matches(group: np.ndarray, before: list[bytes], after: list[bytes], doc: np.ndarray, many: np.ndarray, least: int = LEAST,
            gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(suffix, first, end, partner), places from the suffix's own: for each partner the stretch of its shared windows.

    Suffixes under their grams (``group``) are sorted by the words after them;
    neighbours that agree in the first least - o words form runs, and within a run
    the o words before decide.  A window's partner is the smallest ``doc`` that has
    it.  ``many``: the suffix's whole context stands elsewhere too.
    """
    m, reach = len(group), least - gram
    right, left = _padded(after, least), _padded(before, reach)
    order = np.lexsort([right[:, c] for c in range(least - 1, -1, -1)] + [group])
    group, right, left, doc, many = group[order], right[order], left[order], doc[order], many[order]
    differs = right[1:] != right[:-1]
    shared = np.where(differs.any(axis=1), differs.argmax(axis=1), least)
    shared = np.where(group[1:] == group[:-1], shared, -1)
    lefts = np.zeros(m, np.uint64)
    seen: list[np.ndarray] = []
    for o in range(reach + 1):
        run = np.concatenate([[0], np.cumsum(shared < least - o)])
        # the window must exist: enough words before and after
        whole = (left[:, o - 1] < 1 << 40 if o else np.ones(m, bool)) & (right[:, least - o - 1] < 1 << 40)
        key = _mix(lefts ^ _mix(run.astype(np.uint64) + np.uint64(_R)))
        rows = np.flatnonzero(whole)
        _, where, count = np.unique(key[rows], return_inverse=True, return_counts=True)
        found = many[rows] | (count[where] > 1)
        least_doc = np.full(len(count), np.iinfo(np.int64).max)
        np.minimum.at(least_doc, where, doc[rows])
        rows, where = rows[found], where[found]
        seen.append(np.stack([order[rows], least_doc[where], np.full(len(rows), o)]))
        if o < reach:
            lefts = _mix(lefts * np.uint64(_R) + left[:, o])
    row, partner, o = np.concatenate(seen, axis=1)
    by = np.lexsort((o, partner, row))
    row, partner, o = row[by], partner[by], o[by]
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (partner[1:] != partner[:-1])])) if len(row) else np.zeros(0, np.int64)
    last = np.append(new[1:], len(row)) - 1 if len(row) else new
    return row[new], -o[last], least - o[new], partner[new]


def _sorted_matches(found: DataFrame, least: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_grams(batches, 1 << 14):
            doc = np.asarray(t.column("doc_id").fill_null(np.iinfo(np.int64).max))
            many = np.asarray(t.column("many").cast(pa.int8())).astype(bool)
            row, first, end, partner = matches(np.asarray(t.column("gram")), t.column("before").to_pylist(),
                                               t.column("after").to_pylist(), doc, many, least, gram)
            which = pa.array(row)
            yield pa.RecordBatch.from_arrays([t.column("gram").take(which), t.column("context").take(which), pa.array(first),
                                              pa.array(end), pa.array(partner)], ["gram", "context", "first", "end", "partner"])

    return found.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, _SPAN)


_SPAN = "gram long, context long, first long, end long, partner long"


def _whole_grams(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches of at least ``size`` rows that do not cut a gram's rows."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        if sum(x.num_rows for x in held) < size:
            continue
        t = pa.concat_batches(held)
        gram = np.asarray(t.column("gram"))
        edges = np.flatnonzero(gram[1:] != gram[:-1])
        cut = int(edges[-1]) + 1 if len(edges) else 0
        held = [t.slice(cut)]
        if cut:
            yield t.slice(0, cut)
    if held and (t := pa.concat_batches(held)).num_rows:
        yield t


def _counted_matches(found: DataFrame, least: int, gram: int) -> DataFrame:
    """The same for grams with very many contexts, equal ones counted as one: every window's hash is counted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                b = whole.slice(at, 4096)
                starts, hashes, rows = [], [], []
                for i, (before, after) in enumerate(zip(b.column("before").to_pylist(), b.column("after").to_pylist())):
                    words = np.concatenate([np.frombuffer(before, "<u4")[::-1], np.frombuffer(after, "<u4")]).astype(np.uint64)
                    n = len(words) - least + 1
                    sums = _sums(words + np.uint64(1), least, _R)[:n]
                    starts.append(np.arange(n) - len(before) // 4)
                    hashes.append(sums.view(np.int64))
                    rows.append(np.full(n, i))
                if rows:
                    who = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_arrays(
                        [*(b.column(c).take(who) for c in ("doc_id", "gram", "context", "many")),
                         pa.array(np.concatenate(hashes)), pa.array(np.concatenate(starts))],
                        ["doc_id", "gram", "context", "many", "window", "first"])

    windows = found.mapInArrow(run, "doc_id long, gram long, context long, many boolean, window long, first long")
    windows = stored(windows, "windows")
    # a window stands at another place, or in a context that does; a gram may stand in it twice, so its place counts
    shared = windows.groupBy("gram", "first", "window").agg(F.count(F.lit(1)).alias("n"), F.max("many").alias("many_"), F.min("doc_id").alias("partner")) \
        .where("n > 1 or many_").select("gram", "first", "window", F.coalesce("partner", F.lit(2**63 - 1)).alias("partner"))
    return windows.join(shared, ["gram", "first", "window"]).groupBy("gram", "context", "partner").agg(
        F.min("first").alias("first"), (F.max("first") + least).alias("end")).select("gram", "context", "first", "end", "partner")


def _trimmed(found: DataFrame, side: str, least: int) -> DataFrame:
    """``found`` with the words of one side (``before`` or ``after``) cut to those that another context of the gram has too.

    Contexts are sorted by these words, in as many tasks as the table needs; the
    longest common start is that with a neighbour.  At the ends of a task's rows, where
    one neighbour is not known, nothing is cut; words too many do no harm.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = None, least
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                b = whole.slice(at, 4096)
                t = b if held is None else pa.concat_batches([held, b])
                words = _padded(t.column(side).to_pylist(), least)
                differs = words[1:] != words[:-1]
                shared = np.where(differs.any(axis=1), differs.argmax(axis=1), least)
                group = np.asarray(t.column("gram"))
                shared = np.concatenate([[known], np.where(group[1:] == group[:-1], shared, 0)])
                yield cut(t.slice(0, t.num_rows - 1), np.maximum(shared[:-1], shared[1:]))
                held, known = t.slice(t.num_rows - 1), shared[-1]
        if held is not None:
            yield held

    def cut(t: pa.RecordBatch, size: np.ndarray) -> pa.RecordBatch:
        kept = [v[:4 * n] for v, n in zip(t.column(side).to_pylist(), size.tolist())]
        return t.set_column(t.schema.get_field_index(side), side, pa.array(kept, pa.binary()))

    order = ["gram", side, "context"]
    return found.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, found.schema)


def _crowded_matches(found: DataFrame, least: int, gram: int, crowd: int) -> DataFrame:
    """The same for grams with very many contexts, which no task holds as a whole.

    Windows that other contexts have too lie within the words that another context
    shares on either side.  Contexts that are equal in these words have the same
    partners and count as one, so what differs around a common passage does not
    multiply its windows.  If a gram still has more than ``crowd``, windows are counted.
    """
    size = lambda name: (F.octet_length(name) / 4).cast("long")
    rows = found.select("doc_id", "gram", "context", "many", "before", "after",
                        size("before").alias("low"), size("after").alias("high"))
    rows = _trimmed(_trimmed(rows, "after", least), "before", least).withColumn("words", F.xxhash64("before", "after"))
    rows = stored(rows, "trimmed")
    shared = rows.filter(size("before") + size("after") >= least)
    alike = shared.groupBy("gram", "words").agg(F.min("doc_id").alias("doc_id"), (F.max("many") | (F.count(F.lit(1)) > 1)).alias("many"),
                                                F.min("before").alias("before"), F.min("after").alias("after"))
    alike = stored(alike.withColumnRenamed("words", "context"), "alike")
    crowded = alike.groupBy("gram").agg((F.count(F.lit(1)) > crowd).alias("crowd"))
    alike = alike.join(F.broadcast(crowded), "gram")
    spans = _sorted_matches(alike.filter("not crowd").drop("crowd"), least, gram).unionByName(
        _counted_matches(alike.filter("crowd").drop("crowd"), least, gram))
    spans = shared.select("gram", "context", "words").join(spans.withColumnRenamed("context", "words"), ["gram", "words"]).drop("words")
    # windows of a context at several places that no other context has; if no window is shared, all of them
    own = F.coalesce("doc_id", F.lit(2**63 - 1)).alias("partner")
    several, some = rows.filter("many"), size("before") + size("after") >= least
    right = several.filter(some & (F.col("high") > size("after"))).select(
        "gram", "context", (size("after") + 1 - least).alias("first"), F.col("high").alias("end"), own)
    left = several.filter(some & (F.col("low") > size("before"))).select(
        "gram", "context", (-F.col("low")).alias("first"), (least - 1 - size("before")).alias("end"), own)
    none = several.filter(~some).select("gram", "context", (-F.col("low")).alias("first"), F.col("high").alias("end"), own)
    return spans.unionByName(right).unionByName(left).unionByName(none)


def repeated_passages(docs: DataFrame, least: int = LEAST, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_words, n_repeated, n_later, spans, later, first_docs, text_key of every row.

    A word is repeated if a passage of at least ``least`` words around it stands
    at another place, in the same or another document.  spans: the repeated
    stretches [first, end) in words, ascending.  first_docs: the smallest doc_id
    that has it of each repeated passage of ``least`` words, ascending; later,
    n_later: stretches and words of passages that a document with a smaller doc_id
    has too.  text_key: a hash of doc_id and text, which names the row.  ``crowd``:
    contexts beyond which a gram is not sorted in one task, without effect on the result.
    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z
    lower-cased.  Defined cases: a null text has no words; rows alike in doc_id
    and text are one document (the result is repeated), but rows without doc_id
    are each their own; a null doc_id is larger than any other and is not listed; an
    empty table gives no rows; other columns are not read.
    """
    if least <= gram:
        raise ValueError("a passage must be longer than a gram")
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("uid", F.xxhash64("doc_id", "text"))
    # a number only tells rows without id apart, and is stored with the suffixes
    every = stored(_suffixes(rows.withColumn("row", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(F.lit(0))),
                             least, gram), "suffixes")
    kept = every.filter("gram is not null")
    low = F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc_id"), "uid", "pos", "before", "after")).alias("low")
    place = F.xxhash64("uid", "pos", "row")
    contexts = kept.groupBy("gram", "context").agg(low, (F.min(place) != F.max(place)).alias("many"))
    contexts = stored(contexts, "contexts")
    # one suffix for each context of the grams that have several
    grams = contexts.groupBy("gram").agg(F.count("*").alias("contexts"))
    known = contexts.join(grams, "gram")
    wanted = known.filter("contexts > 1").select(F.col("low.uid").alias("uid"), F.col("low.pos").alias("pos"), "gram", "context", "many",
                                                 F.col("low.before").alias("before"), F.col("low.after").alias("after"),
                                                 (F.col("contexts") > crowd).alias("crowd"))
    around = stored(_contexts(rows, wanted, least, gram).dropDuplicates(["gram", "context"]), "around")
    part = _sorted_matches(around.filter("not crowd"), least, gram).unionByName(
        _crowded_matches(around.filter("crowd"), least, gram, crowd))
    # the only context of its gram, at several places: all its windows are shared
    alone = known.filter("contexts = 1 and many").select("gram", "context", (-F.col("low.before")).cast("long").alias("first"),
                                                         F.col("low.after").cast("long").alias("end"), F.col("low.doc_id").alias("partner"))
    sizes = every.filter("gram is null").select("uid", "doc_id", F.col("pos").alias("n_words"))
    own = kept.select("uid", "pos", "gram", "context").join(part.unionByName(alone), ["gram", "context"]).select(
        "uid", (F.col("pos") + F.col("first")).alias("first"), (F.col("pos") + F.col("end")).alias("end"), "partner")
    spans = own.groupBy("uid").agg(F.collect_set(F.struct("first", "end", "partner")).alias("found"))
    joined = sizes.join(spans, "uid", "left")
    return joined.mapInArrow(_summed, "doc_id long, n_words long, n_repeated long, n_later long, "
                                      "spans array<struct<first: long, end: long>>, later array<struct<first: long, end: long>>, "
                                      "first_docs array<long>, text_key long")


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A document's spans, merged and counted."""
    for b in batches:
        out: dict[str, list] = {"n_repeated": [], "n_later": [], "spans": [], "later": [], "first_docs": []}
        for own, n, found in zip(b.column("doc_id").to_pylist(), b.column("n_words").to_pylist(), b.column("found").to_pylist()):
            found = [(max(0, f["first"]), min(n, f["end"]), f["partner"]) for f in found or []]
            spans = _merged([(a, z) for a, z, _ in found])
            mine = 2**63 - 1 if own is None else own
            later = _merged([(a, z) for a, z, p in found if p < mine])
            out["n_repeated"].append(sum(z - a for a, z in spans))
            out["n_later"].append(sum(z - a for a, z in later))
            out["spans"].append([{"first": a, "end": z} for a, z in spans])
            out["later"].append([{"first": a, "end": z} for a, z in later])
            out["first_docs"].append(sorted({p for *_, p in found if p != 2**63 - 1}))
        span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("n_words"), pa.array(out["n_repeated"], pa.int64()), pa.array(out["n_later"], pa.int64()),
             pa.array(out["spans"], span), pa.array(out["later"], span), pa.array(out["first_docs"], pa.list_(pa.int64())),
             b.column("uid")], ["doc_id", "n_words", *out, "text_key"])


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], z))
        else:
            out.append((a, z))
    return out


def without_repeats(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id and text, without the passages (``later``) that a document with a smaller doc_id has too.
    Rows without an id keep their text; of rows that repeat an id each is cut by its own spans."""
    cuts = found.filter(F.col("doc_id").isNotNull() & (F.size("later") > 0)).select("text_key", "later").dropDuplicates(["text_key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", 1 << 20):
            texts = [remove_spans(t, [(s["first"], s["end"]) for s in x]) if t and x else t
                     for t, x in zip(b.column("text").to_pylist(), b.column("later").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("text_key", F.xxhash64("doc_id", "text"))
    return rows.join(cuts, "text_key", "left").select("doc_id", "text", "later").mapInArrow(cut, "doc_id long, text string")
