"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are sorted by their rank in the Gray code, in which neighbours
share most bits.  Runs of neighbours form leaves and runs of leaves form upper
nodes; a node keeps only the bits (mask and pattern) that all below it share and
that no node above it has already factored out.  A search adds up the
differences from node to node and drops a whole group once they exceed the
limit.

To distribute the index, the 64 bits are cut into five blocks: two fingerprints
that differ in at most three bits agree in at least two whole blocks.  For each
of the ten pairs of blocks a copy of the index has that pair's bits in front, so
that the pair's value is the root under which both fingerprints lie.  Roots are
spread over the cluster by a shuffle; a root with very many fingerprints is cut
into chunks and each pair of chunks is searched on its own.  Only distinct
fingerprints are indexed, so copies cost nothing.  No link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from quarry.llm.common import fresh, ship, small_batches, space_words, stored, texts_of
from quarry.llm.components import components

SEED = 42
#: bits of the five blocks; any two fingerprints at three or fewer bits share two of them
BLOCKS = (13, 13, 13, 13, 12)
MAX_BITS = 3
LEAF, FANOUT = 32, 32


# fingerprints -------------------------------------------------------------
def shingle_hashes(text: bytes | None, size: int) -> np.ndarray:
    """XXH64 of every shingle of ``size`` words (fewer words: of the whole sequence)."""
    words = space_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    size, digest = min(size, len(words)), xxhash.xxh64_digest
    shingles = zip(*(words[i:] for i in range(size)))
    return np.frombuffer(b"".join([digest(b" ".join(s), SEED) for s in shingles]), dtype=">u8").astype(np.uint64)


def fingerprints(texts: list[bytes | None], size: int = 3) -> np.ndarray:
    """SimHash of each text: a bit is one if more than half the shingles have it; no words: zero."""
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        hashes = shingle_hashes(text, size)
        if len(hashes):
            bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
            # bytes are summed over at most 255 rows, then the sums
            sums = sum(bits[a:a + 255].sum(axis=0, dtype=np.uint8).astype(np.int64) for a in range(0, len(bits), 255))
            out[i] = np.packbits(sums * 2 > len(hashes), bitorder="little").view("<u8")[0]
    return out


def with_fingerprint(docs: DataFrame, size: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fp (the 64 bits as a long) of every row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", 2 << 20):
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(fingerprints(texts_of(b, "text"), size).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")) \
        .mapInArrow(run, "doc_id long, fp long")


# the index ----------------------------------------------------------------
def with_gray_rank(df: DataFrame, code: str) -> DataFrame:
    """Replace a column of 64-bit codes by their places in the Gray sequence
    (prefix XOR, one projection a step so that no step's expression is repeated)."""
    for shift in (1, 2, 4, 8, 16, 32):
        df = df.withColumn(code, F.col(code).bitwiseXOR(F.shiftrightunsigned(code, shift)))
    return df


def _arranged(fp: Column, front: tuple[int, ...]) -> tuple[Column, Column]:
    """The bits with the blocks ``front`` moved to the front; and those blocks' value."""
    offsets = np.cumsum((0, *BLOCKS))
    order = [*front, *(b for b in range(len(BLOCKS)) if b not in front)]
    out, width, key = None, 0, None
    for n, b in enumerate(order):
        block = F.shiftrightunsigned(fp, int(offsets[b])).bitwiseAND(F.lit((1 << BLOCKS[b]) - 1).cast("long"))
        out = block if out is None else F.shiftleft(out, BLOCKS[b]).bitwiseOR(block)
        width += BLOCKS[b]
        key = out if n == len(front) - 1 else key
    return out, key


def linked(keys: np.ndarray, codes: np.ndarray, limit: int = MAX_BITS, budget: int = 1 << 21) \
        -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a, b), a < b, of rows under one key whose codes differ in at most
    ``limit`` bits.  Rows of a key are consecutive and in Gray order.  Yields
    blocks of pairs; a block looks at about ``budget`` rows at most."""
    n = len(codes)
    if n < 2:
        return
    codes = codes.astype(np.uint64)
    group_start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    group_size = np.diff(np.append(group_start, n))
    group = np.repeat(np.arange(len(group_start)), group_size)
    leaf_start = np.flatnonzero((np.arange(n) - group_start[group]) % LEAF == 0)
    leaf_end = np.append(leaf_start[1:], n)
    leaf_group = group[leaf_start]
    group_leaf = np.searchsorted(leaf_group, np.arange(len(group_start)))
    node_start = np.flatnonzero((np.arange(len(leaf_start)) - group_leaf[leaf_group]) % FANOUT == 0)
    node_end = np.append(node_start[1:], len(leaf_start))
    node_group = leaf_group[node_start]
    group_node = np.append(np.searchsorted(node_group, np.arange(len(group_start))), len(node_start))
    # shared bits, each factored into the highest node that has them
    leaf_and, leaf_or = np.bitwise_and.reduceat(codes, leaf_start), np.bitwise_or.reduceat(codes, leaf_start)
    leaf_same = ~(leaf_and ^ leaf_or)
    node_and, node_or = np.bitwise_and.reduceat(leaf_and, node_start), np.bitwise_or.reduceat(leaf_or, node_start)
    node_same = ~(node_and ^ node_or)
    above = np.repeat(node_same, node_end - node_start)
    leaf_mask = leaf_same & ~above
    row_mask = ~np.repeat(leaf_same, leaf_end - leaf_start)

    work = np.cumsum(group_size[group])
    at = 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + budget, side="right")))
        q = np.arange(at, stop)
        q = q[group_size[group[q]] > 1]
        at = stop
        if not len(q):
            continue
        q, node = _spread(q, group_node[group[q]], group_node[group[q] + 1])
        far = np.bitwise_count((codes[q] ^ node_and[node]) & node_same[node])
        keep = (far <= limit) & (leaf_end[node_end[node] - 1] > q + 1)
        q, node, far = q[keep], node[keep], far[keep]
        (q, far), leaf = _spread((q, far), node_start[node], node_end[node])
        far = far + np.bitwise_count((codes[q] ^ leaf_and[leaf]) & leaf_mask[leaf])
        keep = (far <= limit) & (leaf_end[leaf] > q + 1)
        q, leaf, far = q[keep], leaf[keep], far[keep]
        (q, far), row = _spread((q, far), leaf_start[leaf], leaf_end[leaf])
        keep = row > q
        q, row, far = q[keep], row[keep], far[keep]
        keep = far + np.bitwise_count((codes[q] ^ codes[row]) & row_mask[row]) <= limit
        if keep.any():
            yield q[keep], row[keep]


def _spread(values, low: np.ndarray, high: np.ndarray):
    """Each value once for every child in [low, high), and those children."""
    counts = high - low
    children = np.arange(counts.sum()) + np.repeat(low - (np.cumsum(counts) - counts), counts)
    if isinstance(values, tuple):
        return tuple(np.repeat(v, counts) for v in values), children
    return np.repeat(values, counts), children


def _hook(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (the smallest row reached so far) after adding the pairs."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up


def links(nodes: DataFrame, limit: int = MAX_BITS, chunk: int = 1 << 14) -> DataFrame:
    """Edges (a, b) among distinct fingerprints ``nodes`` (fp): they connect exactly
    those that a chain of links of at most ``limit`` bits connects; every edge
    comes from rows under one root of the index."""
    if not 0 <= limit <= MAX_BITS:
        raise ValueError(f"the block design is complete for up to {MAX_BITS} bits")
    ship(nodes.sparkSession)
    copies = []
    for t, front in enumerate(combinations(range(len(BLOCKS)), len(BLOCKS) - MAX_BITS)):
        code, key = _arranged(F.col("fp"), front)
        copies.append(F.struct(F.lit(t).alias("t"), key.alias("key"), code.alias("rank")))
    rows = with_gray_rank(nodes.select("fp", F.inline(F.array(*copies))), "rank")
    crowded = rows.groupBy("t", "key").count().filter(F.col("count") > chunk) \
        .select("t", "key", F.ceil(F.col("count") / chunk).cast("int").alias("chunks"))
    rows = rows.join(crowded, ["t", "key"], "left") \
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.coalesce("chunks", F.lit(1))).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1))) \
        .select("t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                (F.col("own") > F.col("other")).alias("second"), "rank", "fp")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, rank, fp, crossed, second in _groups(batches, 1 << 17):
            label = np.arange(len(fp))
            for a, b in linked(keys, rank ^ (rank >> np.uint64(1)), limit):
                fit = ~crossed[a] | (second[a] != second[b])
                label = _hook(label, a[fit], b[fit])
            moved = np.flatnonzero(label != np.arange(len(fp)))
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[label[moved]])], ["a", "b"])

    spread = rows.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j", "rank")
    return spread.mapInArrow(search, "a long, b long")


def _groups(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Whole groups (t, key, i, j), at least ``size`` rows of them at a time, as arrays;
    groups of one row are left out, as they have no partner."""
    held: list[tuple[np.ndarray, ...]] = []
    rows = 0

    def cut(last: bool):
        nonlocal held, rows
        g, rank, fp, i, j, second = (np.concatenate(c) for c in zip(*held))
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        upto = len(g) if last else int(np.flatnonzero(new)[-1])
        held, rows = ([] if last else [tuple(x[upto:] for x in (g, rank, fp, i, j, second))]), len(g) - upto
        if not upto:
            return None
        number = np.cumsum(new[:upto])
        many = np.bincount(number)[number] > 1
        return tuple(x[:upto][many] for x in (number, rank.view(np.uint64), fp, i != j, second))

    for b in batches:
        if not b.num_rows:
            continue
        col = {n: np.asarray(b.column(n)) for n in ("t", "key", "i", "j", "rank", "fp")}
        held.append((col["t"].astype(np.int64) << 32 | col["key"], col["rank"], col["fp"], col["i"], col["j"],
                     np.asarray(b.column("second").cast(pa.int8())).astype(bool)))
        rows += b.num_rows
        if rows >= size and (out := cut(False)):
            yield out
    if rows and (out := cut(True)):
        yield out


# the operator -------------------------------------------------------------
def near_duplicates(docs: DataFrame, shingle: int = 3, limit: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id and root of every row.

    component_id is the smallest doc_id that a chain of links reaches; root
    names the component itself (its smallest fingerprint).  Defined cases: a
    null or empty text has fingerprint zero and is linked like any other; rows
    with a null doc_id have fingerprints and components (component_id is null
    only if every row of the component has a null id); repeated rows give
    repeated results; an empty table gives none; other columns are not read.
    """
    fps = stored(with_fingerprint(docs, shingle), "fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprints")
    roots = components(stored(links(nodes, limit), "links")).withColumnRenamed("node", "fp")
    nodes = nodes.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = nodes.groupBy("root").agg(F.min("low").alias("component_id"))
    nodes = nodes.join(lows, "root").select("fp", "root", "component_id")
    return fps.join(nodes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root")


def keep_one(docs: DataFrame, shingle: int = 3, limit: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one row of each component: its smallest doc_id.

    A row is named by its doc_id and fingerprint, so of rows that repeat a
    doc_id in other components one stays in each that has no smaller one.  Of
    rows alike in both one stays, the same at each run.  A component whose rows
    all have a null doc_id keeps one of them.
    """
    found = stored(near_duplicates(docs, shingle, limit), "near-duplicates")
    low = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fingerprint")).alias("low")
    keeper, fp, place = (fresh(docs.columns, x) for x in ("keeper", "fp", "place"))
    keepers = found.groupBy("root").agg(low).select(F.col("low.doc_id").alias(keeper), F.col("low.fingerprint").alias(fp))
    several = found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias(keeper))
    several = stored(several, "repeated-ids")
    known = docs.join(keepers.join(several, keeper, "left_anti"), F.col("doc_id") == F.col(keeper), "left_semi")

    # rows with a repeated id, or without one, are matched by their fingerprint too
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", 1 << 20):
            found = pa.array([f"{int(x):016x}" for x in fingerprints(texts_of(b, "text"), shingle)], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, found], [*b.schema.names, fp])

    rest = docs.join(several, F.col("doc_id") == F.col(keeper), "left_semi").unionAll(docs.filter("doc_id is null"))
    rest = rest.mapInArrow(add, StructType([*docs.schema.fields, StructField(fp, StringType())]))
    rest = rest.join(keepers.withColumnRenamed(fp, fp + "_"), F.col("doc_id").eqNullSafe(F.col(keeper)) & (F.col(fp) == F.col(fp + "_")),
                     "left_semi")
    first = F.row_number().over(Window.partitionBy("doc_id", fp).orderBy(F.xxhash64(*docs.columns)))
    return known.unionByName(rest.withColumn(place, first).filter(F.col(place) == 1).select(docs.columns))
