"""Token-ID output: one wavelet matrix file per shard.

``encode_documents`` tokenises whole texts, orders documents by id, and writes
shards.  A shard file is one wavelet matrix: bit plane 0 holds the highest bit of
every token in document order, each further plane the next bit after a stable
partition by the planes before it.  Planes are compressed in blocks; a directory
in the file holds the ones before each block and where it lies, so rank and select
(token access, counting, occurrence lookup) read a block or two a plane and nothing
else.  ``read_documents`` reads the files back.

Defined cases: a null or empty text has only the end id; null ids sort first
and stay null; repeated rows are all written, ties of an id in text order; an
empty table writes no shard and reads back as no rows; other columns of the
input are not read.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import shared_dir, ship, small_batches

_MAGIC = b"QWM2"
#: words of a block, which is compressed on its own
BLOCK = 1 << 12
_HEAD = struct.Struct("<4sIQQQQ")  # magic, planes, tokens, documents, first token in its partition, bytes of the table
SUFFIX = ".wm"


class Plane:
    """A bit plane in blocks of ``BLOCK`` words (64 bits each, lowest bit first), with the ones before each block.

    ``load`` gives a block's words; blocks are read when asked for, and the last few stay in memory."""

    def __init__(self, n: int, ranks: np.ndarray, load: Callable[[int], np.ndarray], keep: int = 4):
        self.n, self.ranks, self.load, self.keep = n, ranks, load, keep
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @property
    def zeros(self) -> int:
        return self.n - int(self.ranks[-1])

    def _block(self, j: int) -> tuple[np.ndarray, np.ndarray]:
        """A block's words, and the ones before each of them in the block."""
        if j not in self.held:
            words = self.load(j)
            while len(self.held) >= self.keep:
                self.held.pop(next(iter(self.held)))
            self.held[j] = words, np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        return self.held[j]

    def bits(self) -> np.ndarray:
        words = [self.load(j) for j in range(len(self.ranks) - 1)]
        return _unpack(np.concatenate(words) if words else np.zeros(0, "<u8"), self.n)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        block, rest = i // (BLOCK * 64), i % (BLOCK * 64)
        out = self.ranks[np.minimum(block, len(self.ranks) - 1)].copy()
        for j in np.unique(block[rest > 0]).tolist():
            some = np.flatnonzero((block == j) & (rest > 0))
            words, before = self._block(j)
            word, bit = rest[some] >> 6, (rest[some] & 63).astype(np.uint64)
            last = np.append(words, np.uint64(0))[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[some] += before[word] + np.bitwise_count(last)
        return out

    def select(self, bit: int, k: np.ndarray) -> np.ndarray:
        """Positions of the k-th (from 0) ones or zeros: the block from the stored ranks, then the word, then the bit."""
        size = np.minimum(np.arange(len(self.ranks)) * BLOCK * 64, self.n)
        counts = self.ranks if bit else size - self.ranks
        block, out = np.searchsorted(counts, k, side="right") - 1, np.empty(len(k), np.int64)
        for j in np.unique(block).tolist():
            some = np.flatnonzero(block == j)
            words, before = self._block(j)
            inner = before if bit else np.arange(len(before), dtype=np.int64) * 64 - before
            rest = k[some] - counts[j]
            word = np.searchsorted(inner, rest, side="right") - 1
            rest = (rest - inner[word]).astype(np.int64)
            value = words[word] if bit else ~words[word]
            # binary search for the rest-th set bit of each word
            low, high = np.zeros(len(some), np.int64), np.full(len(some), 63, np.int64)
            for _ in range(6):
                mid = (low + high) >> 1
                upto = np.bitwise_count(value & (~np.uint64(0) >> (np.uint64(63) - mid.astype(np.uint64))))
                found = upto > rest
                low, high = np.where(found, low, mid + 1), np.where(found, mid, high)
            out[some] = (j * BLOCK + word) * 64 + low
        return out


class WaveletMatrix:
    """Bit planes, the highest bit's first."""

    def __init__(self, n: int, planes: list[Plane]):
        self.n, self.planes = n, planes
        self.bits = len(planes)

    @classmethod
    def build(cls, tokens: np.ndarray, bits: int) -> WaveletMatrix:
        seq = np.ascontiguousarray(tokens, dtype=np.uint16 if bits <= 16 else np.uint32)
        if len(seq) and int(seq.max()) >> bits:
            raise ValueError(f"a token needs more than {bits} bits")
        planes = []
        for b in range(bits - 1, -1, -1):
            ones = (seq & seq.dtype.type(1 << b)) != 0
            words = _pack(ones)
            starts = np.arange(0, len(words), BLOCK)
            counts = np.add.reduceat(np.bitwise_count(words), starts, dtype=np.int64) if len(words) else np.zeros(0, np.int64)
            planes.append(Plane(len(seq), np.concatenate([[0], np.cumsum(counts)]), lambda j, w=words: w[j * BLOCK:(j + 1) * BLOCK]))
            seq = np.concatenate([np.compress(~ones, seq), np.compress(ones, seq)])
        return cls(len(seq), planes)

    # whole sequence -------------------------------------------------------
    def tokens(self) -> np.ndarray:
        """All tokens, planes undone from the last to the first."""
        seq = np.zeros(self.n, dtype=np.uint16 if self.bits <= 16 else np.uint32)
        for level in range(self.bits - 1, -1, -1):
            ones = self.planes[level].bits()
            out = np.empty_like(seq)
            ones, zeros = np.flatnonzero(ones), np.flatnonzero(~ones)
            out[zeros] = seq[:len(zeros)]
            out[ones] = seq[len(zeros):] | seq.dtype.type(1 << (self.bits - 1 - level))
            seq = out
        return seq

    # rank and select ------------------------------------------------------
    def access(self, i) -> np.ndarray:
        """Tokens at the positions ``i``."""
        at = np.atleast_1d(np.asarray(i, dtype=np.int64))
        if at.size and (at.min() < 0 or at.max() >= self.n):
            raise IndexError("position outside the shard")
        token = np.zeros(len(at), dtype=np.int64)
        for plane in self.planes:
            before = plane.ones(at)
            bit = plane.ones(at + 1) - before
            token = (token << 1) | bit
            at = np.where(bit == 1, plane.zeros + before, at - before)
        return token

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the occurrences of a token in [lo, hi) lie after the last plane."""
        if token < 0 or token >> self.bits:
            return 0, 0
        ends = np.array([max(lo, 0), min(hi, self.n)], dtype=np.int64)
        for level, plane in enumerate(self.planes):
            before = plane.ones(ends)
            ends = plane.zeros + before if (token >> (self.bits - 1 - level)) & 1 else ends - before
        return int(ends[0]), max(int(ends[0]), int(ends[1]))

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of a token in [lo, hi)."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def _positions(self, token: int, at: np.ndarray) -> np.ndarray:
        """From places after the last plane back through all planes."""
        for level in range(self.bits - 1, -1, -1):
            bit, plane = (token >> (self.bits - 1 - level)) & 1, self.planes[level]
            at = plane.select(bit, at - plane.zeros if bit else at)
        return at

    def occurrences(self, token: int, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Positions of a token in [lo, hi), ascending."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return self._positions(token, np.arange(a, b, dtype=np.int64))

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of a token; -1 if there are fewer."""
        a, b = self._range(token, 0, self.n)
        return int(self._positions(token, np.array([a + k], dtype=np.int64))[0]) if 0 <= k < b - a else -1


def _pack(ones: np.ndarray) -> np.ndarray:
    packed = np.packbits(ones, bitorder="little")
    return np.concatenate([packed, np.zeros(-len(packed) % 8, np.uint8)]).view("<u8")


def _unpack(plane: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(plane.view(np.uint8), count=n, bitorder="little").view(bool)


def write_shard(tokens: np.ndarray, ends: np.ndarray, ids: list[int | None], first: int, bits: int) -> bytes:
    """One shard file: header, document table, directory of the blocks (ones before and compressed bytes before each), blocks."""
    matrix = WaveletMatrix.build(tokens, bits)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    known = np.array([i is not None for i in ids], dtype=np.uint8)
    table = squeeze(np.array([i or 0 for i in ids], dtype="<i8").tobytes() + np.asarray(ends, dtype="<i8").tobytes()
                    + known.tobytes())
    blocks = [squeeze(p.load(j).tobytes()) for p in matrix.planes for j in range(len(p.ranks) - 1)]
    ranks = np.concatenate([p.ranks for p in matrix.planes]).astype("<i8")
    places = np.concatenate([[0], np.cumsum([len(x) for x in blocks], dtype=np.int64)]).astype("<i8")
    return b"".join([_HEAD.pack(_MAGIC, bits, matrix.n, len(ids), first, len(table)), table, ranks.tobytes(), places.tobytes(), *blocks])


def open_shard(read: Callable[[int, int], bytes]) -> tuple[WaveletMatrix, np.ndarray, list[int | None], int]:
    """The matrix, each document's end, the ids, and the first token's place in the partition, from a file of which
    ``read(offset, size)`` gives a part.  Blocks are read when asked for."""
    magic, bits, n, n_docs, first, size = _HEAD.unpack(read(0, _HEAD.size))
    if magic != _MAGIC:
        raise ValueError("not a wavelet matrix shard")
    expand = zstandard.ZstdDecompressor().decompress
    table = expand(read(_HEAD.size, size))
    ids, ends = np.frombuffer(table, "<i8", n_docs), np.frombuffer(table, "<i8", n_docs, 8 * n_docs)
    known = np.frombuffer(table, np.uint8, n_docs, 16 * n_docs)
    count = -(-n // (64 * BLOCK))
    at, cells = _HEAD.size + size, bits * (count + 1)
    directory = read(at, 8 * (cells + bits * count + 1))
    ranks = np.frombuffer(directory, "<i8", cells).reshape(bits, count + 1)
    places = np.frombuffer(directory, "<i8", bits * count + 1, 8 * cells) + at + len(directory)

    def load(j: int) -> np.ndarray:
        return np.frombuffer(expand(read(int(places[j]), int(places[j + 1] - places[j]))), "<u8")

    planes = [Plane(n, ranks[level], lambda j, level=level: load(level * count + j)) for level in range(bits)]
    return WaveletMatrix(n, planes), ends, [i if k else None for i, k in zip(ids.tolist(), known.tolist())], first


def read_shard(data: bytes) -> tuple[WaveletMatrix, np.ndarray, list[int | None], int]:
    """``open_shard`` of a file in memory."""
    return open_shard(lambda at, size: data[at:at + size])


#: fixed value: a pre-tokenizer's pattern, as tokenizer files hold it
RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: 1: ASCII letters; 2: other ASCII characters but white space, control characters and the apostrophe
_KIND = np.array([1 if chr(c).isalpha() else 2 if 32 < c < 127 and c != 39 else 0 for c in range(128)] + [0] * 128, np.uint8)


def _apart(texts: pa.Array) -> pa.Array:
    """Texts (no nulls, no offset) with a space between ASCII letters and other ASCII characters next to them."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[:len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)[:offsets[-1]]
    kind = _KIND[data]
    cuts = np.flatnonzero(kind[1:] + kind[:-1] == 3) + 1
    offsets = (offsets + np.searchsorted(cuts, offsets)).astype(np.int32)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(np.insert(data, cuts, 32)))


class Encoder:
    """A ``tokenizers`` file applied to whole texts.

    Its pre-tokenizer never joins text across ASCII white space, so a text's ids
    are those of its white-space chunks in a row; with the pattern ``RUNS`` it does
    not join ASCII letters to other ASCII characters either (apostrophes aside), and
    chunks end there too.  Arrow splits a batch and finds its distinct chunks; of
    these, the ones not met before are encoded, many to a call, with one of the
    tokenizer's own special tokens between them, which it never joins to its
    neighbours; numpy puts the ids in the texts' order.  At most ``keep`` chunks are
    remembered.
    """

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str, keep: int = 700_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; waiting threads would take others'
        self.tokenizer = Tokenizer.from_file(path)
        self.keep = keep
        whole = [(i, t.content) for i, t in sorted(self.tokenizer.get_added_tokens_decoder().items())
                 if t.special and not (t.lstrip or t.rstrip or t.single_word)]
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marker = whole[-1] if whole else None
        before = json.loads(self.tokenizer.to_str()).get("pre_tokenizer") or {}
        first = (before.get("pretokenizers") or [before])[0]
        self.runs = first.get("type") == "Split" and first["pattern"].get("Regex") == RUNS and first["invert"]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.start = np.zeros(0, np.uint32), np.zeros(1, np.int64)  # and where each chunk's ids begin

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _found(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks in a row, and how many each has."""
        encode = self.tokenizer.encode_batch_fast
        if self.marker is None:
            found = [e.ids for e in encode(chunks, add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], np.uint32), np.fromiter(map(len, found), np.int64, len(found))
        number, text = self.marker
        groups = [text.join(chunks[i:i + 200]) + text for i in range(0, len(chunks), 200)]
        every = np.concatenate([np.zeros(0, np.uint32), *(np.array(e.ids, np.uint32) for e in encode(groups, add_special_tokens=False))])
        marks = np.flatnonzero(every == number)
        return every[every != number], np.diff(np.concatenate([[-1], marks])) - 1

    def _slots(self, chunks: list[str]) -> np.ndarray:
        """Numbers of remembered chunks; new ones are learned."""
        if len(self.known) > self.keep:
            self._forget()
        slots = np.fromiter(map(self.known.get, chunks, repeat(-1)), np.int64, len(chunks))
        places = np.flatnonzero(slots < 0)
        if not len(places):
            return slots
        # chunks that hold one of the tokenizer's added tokens are encoded on their own
        new = [chunks[i] for i in places.tolist()]
        odd = np.fromiter((any(t in c for t in self.added) for c in new), bool, len(new)) if any(t in "".join(new) for t in self.added) \
            else np.zeros(len(new), bool)
        places = np.concatenate([places[~odd], places[odd]])
        new = [chunks[i] for i in places.tolist()]
        plain = len(new) - int(odd.sum())
        ids, sizes = self._found(new[:plain])
        if plain < len(new):
            single = [e.ids for e in self.tokenizer.encode_batch_fast(new[plain:], add_special_tokens=False)]
            ids = np.concatenate([ids, np.array([i for x in single for i in x], np.uint32)])
            sizes = np.concatenate([sizes, [len(x) for x in single]])
        slots[places] = np.arange(len(self.known), len(self.known) + len(new))
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids])
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        return slots

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the number of each text's ids."""
        # a copy without an offset: some of Arrow's text functions do not respect that of a slice
        texts = pc.fill_null(texts.take(pa.array(np.arange(len(texts)))), "").cast(pa.string())
        # the tokenizer folds case itself, except in the special tokens, which all hold "<|"
        plain = pc.ascii_lower(_apart(texts) if self.runs else texts)
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, plain)
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        slots = self._slots(coded.dictionary.to_pylist())[np.asarray(coded.indices)]
        begin, size = self.start[slots], self.start[slots + 1] - self.start[slots]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(begin - upto[:-1], size) + np.arange(upto[-1])]
        offsets = np.asarray(split.offsets)
        return ids, np.diff(upto[offsets])


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int, shard_tokens: int = 1 << 20,
                     doc_id: str = "doc_id", text: str = "text", order: Sequence[Column] | None = None) -> tuple[str, dict[int, int]]:
    """Write the shards of ``docs`` to the shared folder, in the order of the ids or in that of the ``order`` columns.

    Returns the folder and, by partition, the tokens before it (one number per
    shuffle partition).  A shard is written under a private name and then moved
    to its final one, which follows from its place, so a task that runs again
    puts the same bytes in the same file.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = shared_dir(spark, "wavelet")
    bits = max(1, int(vocabulary - 1).bit_length())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        part, encoder = TaskContext.get().partitionId(), Encoder.of(tokenizer)
        ids, pieces, held, first, shard = [], [], 0, 0, 0

        def flush():
            tokens, ends = np.concatenate(pieces), np.cumsum([len(p) for p in pieces])
            name = f"{path}/{part:06d}-{shard:06d}"
            private = f"{name}.{uuid.uuid4().hex}"
            with fs.open_output_stream(private) as f:
                f.write(write_shard(tokens, ends, ids, first, bits))
            if fs.get_file_info(name + SUFFIX).type == pafs.FileType.NotFound:
                fs.move(private, name + SUFFIX)
            else:  # an earlier attempt of this task has put the same bytes there
                fs.delete_file(private)
            return pa.RecordBatch.from_pydict({"part": [part], "n_tokens": [len(tokens)]})

        for batch in small_batches(batches, "text", 4 << 20):
            found, sizes = encoder.encode(batch.column("text"))
            ends = np.cumsum(sizes + 1)
            tokens = np.full(len(found) + len(sizes), end_id, np.uint32)
            keep = np.ones(len(tokens), bool)
            keep[ends - 1] = False
            tokens[keep] = found
            for i, a, z in zip(batch.column("doc_id").to_pylist(), (ends - sizes - 1).tolist(), ends.tolist()):
                ids.append(i)
                pieces.append(tokens[a:z])
                held += z - a
                if held >= shard_tokens:
                    yield flush()
                    first, shard = first + held, shard + 1
                    ids, pieces, held = [], [], 0
        if ids:
            yield flush()

    keys = [c.alias(f"at{i}") for i, c in enumerate(order or [])]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *keys)
    if order:
        names = [f"at{i}" for i in range(len(keys))]
        rows = rows.repartitionByRange(*names).sortWithinPartitions(*names, "doc_id", "text").drop(*names)
    else:
        rows = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    sums = rows.mapInArrow(write, "part long, n_tokens long").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before, at = {}, 0
    for r in sorted(sums.collect()):  # a row for each shuffle partition
        before[r.part], at = at, at + r.n
    return folder, before


def read_documents(spark: SparkSession, folder: str, before: dict[int, int]) -> DataFrame:
    """Read shards back: doc_id, start, n_tokens, ids_crc32, shard."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, shard string"
    if not before:
        return spark.createDataFrame([], schema)
    ship(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                name = path.rsplit("/", 1)[-1]
                matrix, ends, ids, first = read_shard(data.as_py())
                raw = matrix.tokens().astype("<u4").tobytes()
                starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                at = before[int(name.split("-")[0])] + first
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids, pa.int64()), "start": starts + at, "n_tokens": ends - starts,
                    "ids_crc32": pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())],
                                          pa.int64()),
                    "shard": [name] * len(ids)})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*" + SUFFIX).load(folder)
    return files.select("path", "content").mapInArrow(read, schema)


def token_shards(docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int, shard_tokens: int = 1 << 20,
                 order: Sequence[Column] | None = None) -> DataFrame:
    """Write ``docs`` as wavelet shards and return their documents as read back."""
    return read_documents(docs.sparkSession, *encode_documents(docs, tokenizer, end_id, vocabulary, shard_tokens, order=order))


def token_places(spark: SparkSession, folder: str, before: dict[int, int], tokens: Sequence[int]) -> DataFrame:
    """token, place (in the whole corpus) of every occurrence of the given tokens, read from the shards' blocks
    that hold them: files are opened, not loaded."""
    schema = "token long, place long, shard string"
    if not before:
        return spark.createDataFrame([], schema)
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                name = path.rsplit("/", 1)[-1]
                with fs.open_input_file(pafs.FileSystem.from_uri(f"{folder}/{name}")[1]) as f:
                    matrix, *_, first = open_shard(lambda at, size: f.read_at(size, at))
                    for t in tokens:
                        found = matrix.occurrences(t) + before[int(name.split("-")[0])] + first
                        for a in range(0, len(found), 1 << 16):
                            part = found[a:a + (1 << 16)]
                            yield pa.RecordBatch.from_pydict({"token": np.full(len(part), t, np.int64), "place": part, "shard": [name] * len(part)})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*" + SUFFIX).load(folder)
    return files.select("path").mapInArrow(run, schema)
