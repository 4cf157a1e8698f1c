"""Benchmark decontamination with a generalised suffix automaton.

The automaton of the benchmark items (sequences of words) accepts exactly their
word substrings.  Training words are streamed through it: after each word it
knows the longest match that ends there.  Where that is at least ``window``
words, or ends a whole shorter item, the matched words are hit, and the state
names the items that hold the window.

A benchmark of any size is processed: items are dealt into automata of a bounded
number of words (an item longer than that in overlapping pieces, so that each of
its windows lies in one), which are built one at a time and written to the shared
folder.  Texts are read and split into words once; a task then has one automaton
after the other in memory and merges what they find in a text.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import RAW_ALNUM_WORD, alnum_words, shared_dir, ship, small_batches, stored, texts_of

WINDOW = 10
#: words in one automaton (about two states a word)
BLOCK_WORDS = 100_000


class Automaton:
    """Generalised suffix automaton of word sequences, with the items of each window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window, self.vocabulary = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        known = self.vocabulary
        sequences = [(name, [known.setdefault(w, len(known)) for w in words]) for name, words in items if words]
        self.shortest = min((min(len(s), window) for _, s in sequences), default=0)
        for _, seq in sequences:
            last = 0
            for word in seq:
                last = self._extend(last, word)
        #: by state: items that hold the window of the state; whole items shorter than a window, by length
        self.items: dict[int, set[str | None]] = {}
        self.whole: dict[int, dict[int, set[str | None]]] = {}
        for name, seq in sequences:
            state = 0
            for n, word in enumerate(seq, 1):
                state = self.next[state][word]
                if n >= window:
                    self.items.setdefault(self._shorten(state, window), set()).add(name)
            if len(seq) < window:
                self.whole.setdefault(self._shorten(state, len(seq)), {}).setdefault(len(seq), set()).add(name)
        # the nearest state on the suffix path (itself included) at which a whole short item ends
        self.ends = [0] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.ends[state] = state if state in self.whole else self.ends[self.link[state]]

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            q = nxt[last][word]
            return q if length[q] == length[last] + 1 else self._clone(last, word, q)
        new = self._state(length[last] + 1, {}, 0)
        p = last
        while p != -1 and word not in nxt[p]:
            nxt[p][word] = new
            p = link[p]
        if p != -1:
            q = nxt[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, word, q)
        return new

    def _clone(self, p: int, word: int, q: int) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _state(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _shorten(self, state: int, n: int) -> int:
        """The state of the last ``n`` words matched."""
        while self.length[self.link[state]] >= n and state:
            state = self.link[state]
        return state

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Hit spans [first, end) of words, merged and ascending, and the items found."""
        if not self.shortest:
            return [], set()
        ids = np.fromiter(map(self.vocabulary.get, words, _NONE), np.int64, len(words))
        # only runs of known words as long as the shortest window can hold one
        edges = np.flatnonzero(np.diff(np.concatenate([[False], ids >= 0, [False]]).view(np.int8)))
        spans: list[tuple[int, int]] = []
        found: set[str | None] = set()
        for a, b in edges.reshape(-1, 2).tolist():
            if b - a >= self.shortest:
                self._stream(ids[a:b].tolist(), a, spans, found)
        return spans, found

    def _stream(self, ids: list[int], offset: int, spans: list[tuple[int, int]], found: set[str | None]) -> None:
        nxt, link, length, window = self.next, self.link, self.length, self.window
        state = size = 0
        for end, word in enumerate(ids, offset + 1):
            while state and word not in nxt[state]:
                state = link[state]
                size = length[state]
            state = nxt[state].get(word, 0)
            size = size + 1 if state else 0
            reach = 0
            if size >= window:
                found |= self.items[self._shorten(state, window)]
                reach = window
            s = self.ends[state]
            while s:
                for n, names in self.whole[s].items():
                    if n <= size:
                        found |= names
                        reach = max(reach, n)
                s = self.ends[link[s]]
            if reach:
                first = end - reach
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append((first, end))


class _Missing:
    def __iter__(self):
        return self

    def __next__(self):
        return -1


_NONE = _Missing()


def _items(benchmark: DataFrame, window: int, block_words: int) -> DataFrame:
    """item, text and n (words) of all items; long ones as pieces of ``block_words`` words that overlap by a window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", 1 << 20):
            for item, text in zip(b.column("item").to_pylist(), texts_of(b, "text")):
                words = alnum_words(text)
                starts = range(0, max(1, len(words) - window + 1), block_words)
                parts = [words[i:i + block_words + window - 1] for i in starts] if len(words) > block_words else [words]
                yield pa.RecordBatch.from_pydict({
                    "item": pa.array([item] * len(parts), pa.string()), "text": [b" ".join(p).decode() for p in parts],
                    "n": pa.array(map(len, parts), pa.int64())})

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return rows.filter(F.col("text").isNotNull()).mapInArrow(run, "item string, text string, n long")


def _automata(benchmark: DataFrame, window: int, block_words: int) -> list[str]:
    """The files of the automata in the shared folder, one for each block of items; a block is collected on its own."""
    spark = benchmark.sparkSession
    items = stored(_items(benchmark, window, block_words), "items")
    total = items.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, math.ceil(total / block_words))
    folder = shared_dir(spark, "automata")
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) if blocks > 1 else items
        automaton = Automaton([(r.item, alnum_words(r.text)) for r in own.select("item", "text").collect()], window)
        with fs.open_output_stream(f"{path}/{block}") as f:
            f.write(pickle.dumps(automaton, protocol=5))
    return [f"{folder}/{block}" for block in range(blocks)]


_LOADED: dict[str, Automaton] = {}


def _loaded(file: str) -> Automaton:
    """An automaton from its file; a worker keeps the last one."""
    if file not in _LOADED:
        _LOADED.clear()
        fs, path = pafs.FileSystem.from_uri(file)
        with fs.open_input_stream(path) as f:
            _LOADED[file] = pickle.loads(f.read())
    return _LOADED[file]


def _find(files: list[str], texts: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set[str | None]]]:
    """Merged hit spans and items of each text's words, by all automata."""
    out: list[tuple[list[tuple[int, int]], set[str | None]]] = [([], set()) for _ in texts]
    # from the one in memory on, so that each is loaded once a batch at most
    for file in sorted(files, key=lambda f: f not in _LOADED):
        automaton = _loaded(file)
        for i, words in enumerate(texts):
            spans, names = automaton.find(words)
            if spans:
                out[i] = _merged(out[i][0] + spans) if out[i][0] else spans, out[i][1] | names
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], z)
        else:
            out.append((a, z))
    return out


def _size(files: list[str]) -> int:
    """Bytes of text held at a time: more if automata have to be loaded for them."""
    return (4 if len(files) == 1 else 16) << 20


def findings(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, spans (array of [first, end) word positions) and items (sorted) of every row.

    Defined cases: a null text has no words; an item without words matches
    nothing; items without an id make hits but are not listed; repeated rows
    give repeated results; an empty benchmark gives no hits; other columns are
    not read.
    """
    ship(docs.sparkSession)
    files = _automata(benchmark, window, block_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", _size(files)):
            texts = [alnum_words(t) for t in texts_of(b, "text")]
            found = _find(files, texts)
            spans = [[{"first": a, "end": e} for a, e in s] for s, _ in found]
            items = [sorted(n for n in names if n is not None) for _, names in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(spans, pa.list_(_SPAN)),
                 pa.array(items, pa.list_(pa.string()))], ["doc_id", "n_words", "spans", "items"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_words long, spans array<struct<first: int, end: int>>, items array<string>")


_SPAN = pa.struct([("first", pa.int32()), ("end", pa.int32())])


def digest(found: DataFrame) -> DataFrame:
    """The findings as counts: n_hit words, n_items and the checksum of the item ids."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def remove_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of these spans (and what stands between them)."""
    if not spans:
        return text
    places = [m.span() for m in re.finditer(RAW_ALNUM_WORD, text)]
    out, at = [], 0
    for first, end in spans:
        out.append(text[at:places[first][0]])
        at = places[end - 1][1]
    return "".join(out) + text[at:]


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.0,
          block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` after decontamination, with all their columns.

    Matches of ``window`` words or more (or whole shorter items) are over the
    length limit and are cut out of the text.  A row of whose words more than
    ``max_coverage`` (a share, 0 to 1) were matched is dropped; at 0 any row
    with a match goes.  Rows without a match keep their text as it is.
    """
    ship(docs.sparkSession)
    files = _automata(benchmark, window, block_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", _size(files) // 4):
            texts, kept, at = b.column("text").to_pylist(), [], b.schema.get_field_index("text")
            words = [alnum_words(t) for t in texts]
            for i, (spans, _) in enumerate(_find(files, words)):
                kept.append(sum(e - a for a, e in spans) <= max_coverage * len(words[i]))
                if spans and kept[-1]:
                    texts[i] = remove_spans(texts[i], spans)
            column = pa.array(texts, b.schema.field(at).type)
            yield b.set_column(at, b.schema.field(at), column).filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
