"""Approximate nearest neighbours by multiprobe p-stable hashing.

Inner products become distances by one more component, sqrt(M^2 - |x|^2), which
gives every vector the largest norm M.  A table hashes a vector by ``HASHES``
projections on Gaussian (2-stable) directions, cut into ``BINS`` bins each, so a
table has a bounded number of buckets.  A query visits buckets in the order of
their estimated success: the squared distances that its projections would have to
move to reach the bucket, summed, least first, over all tables together.  The
candidates of all tables are merged and ranked by their exact inner products.

How many rows a query visits is fitted: some queries are answered exactly, in
one pass over all rows, and the share of rows is taken at which the wanted recall
is reached.  Buckets are dealt into parts of a bounded number of rows; a bucket
with more rows is split over several parts, all of which its visitors see.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import ship, stored

TABLES, HASHES, BINS, WIDTH = 2, 7, 5, 1.25
PART_ROWS, LEAST_ROWS = 16_384, 2_000


class Hashes:
    """The projections of all tables for vectors of a dimension and largest norm."""

    def __init__(self, dimension: int, norm: float, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.norm = norm
        self.directions = rng.standard_normal((dimension + 1, TABLES * HASHES))
        self.shift = rng.random(TABLES * HASHES)
        self.radix = BINS ** np.arange(HASHES - 1, -1, -1)

    def project(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Projections in units of a bin (rows, TABLES, HASHES), the middle bin around zero."""
        size = np.linalg.norm(x, axis=1)
        # a query's order of candidates does not depend on its length
        if query:
            x, rest = x / size[:, None], np.zeros(len(x))
        else:
            x, rest = x / self.norm, np.sqrt(np.maximum(0, 1 - (size / self.norm) ** 2))
        at = np.column_stack([x, rest]) @ self.directions / WIDTH + self.shift + (BINS - 1) / 2
        return at.reshape(len(x), TABLES, HASHES)

    def cells(self, x: np.ndarray) -> np.ndarray:
        """Bucket numbers (rows, TABLES); a table's buckets follow those of the table before."""
        bins = np.clip(np.floor(self.project(x, False)), 0, BINS - 1).astype(np.int64)
        return bins @ self.radix + np.arange(TABLES) * BINS ** HASHES

    def costs(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Estimated effort (queries, cells) to reach each bucket."""
        at = self.project(x, True)
        out = np.empty((len(x), len(cells)))
        for t in range(TABLES):
            own = np.flatnonzero(cells // BINS ** HASHES == t)
            bins = cells[own, None] // self.radix % BINS
            # effort by query, hash and bin; outer bins are open to the outside
            low, high = np.arange(BINS, dtype=float), np.arange(1, BINS + 1, dtype=float)
            low[0], high[-1] = -np.inf, np.inf
            gap = np.maximum(np.maximum(low - at[:, t, :, None], at[:, t, :, None] - high), 0) ** 2
            out[:, own] = sum(gap[:, h, :][:, bins[:, h]] for h in range(HASHES))
        return out


class Directory:
    """The occupied buckets, their rows, and the parts they are dealt into."""

    def __init__(self, cells: np.ndarray, rows: np.ndarray, part_rows: int):
        order = np.argsort(cells)
        self.cells, self.rows = cells[order], rows[order]
        self.chunks = -(-self.rows // part_rows)
        # small buckets fill a part in order; a large one has parts of its own
        self.first, part, filled = np.zeros(len(cells), np.int64), 0, 0
        for i, (n, c) in enumerate(zip(self.rows.tolist(), self.chunks.tolist())):
            if filled and filled + n > part_rows:
                part, filled = part + 1, 0
            self.first[i], filled = part, filled + n
            if c > 1:
                part, filled = part + c, 0
        self.parts = part + 1

    def part(self, cells: np.ndarray, ids: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.cells, cells)
        return self.first[at] + ids % self.chunks[at]

    def parts_of(self, places: np.ndarray) -> np.ndarray:
        """The parts that hold rows of these buckets."""
        times = self.chunks[places]
        return np.unique(np.repeat(self.first[places] - np.cumsum(times) + times, times) + np.arange(times.sum()))

    def efforts(self, costs: np.ndarray, share: float) -> np.ndarray:
        """For each query the cost up to which its buckets hold the share of all rows."""
        wanted = max(share * self.rows.sum(), LEAST_ROWS)
        order = np.argsort(costs, axis=1, kind="stable")
        last = (np.cumsum(self.rows[order], axis=1) < wanted).sum(axis=1)
        return costs[np.arange(len(costs)), order[np.arange(len(costs)), np.minimum(last, len(self.rows) - 1)]]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _usable(vectors: DataFrame, key: str, value: str) -> DataFrame:
    """One finite, non-zero vector for each id; shorter ones are filled up with zeros, which add nothing to a product."""
    fits = F.size("v") > 0
    fits &= F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(value).alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull()).filter(fits)
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    nought = F.lit(0).cast(rows.schema["v"].dataType.elementType)
    filled = F.when(F.size("v") == longest, F.col("v")).otherwise(F.concat("v", F.array_repeat(nought, F.lit(longest) - F.size("v"))))
    return rows.select("id", filled.alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


def search(vectors: DataFrame, k: int = 20, every: int = 20, recall: float = 0.95, sample: int = 64, key: str = "vec_id",
           value: str = "embedding", part_rows: int = PART_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query (a row
    whose id is divisible by ``every``) among all other rows.

    ``recall`` is what the visits are fitted to, on ``sample`` queries.  Defined
    cases: vectors that are null, empty, zero, or hold a null or non-finite
    component, and rows without an id take no part; a shorter vector counts as
    filled up with zeros; of rows that repeat an id the one with the smallest
    vector takes part; with k or fewer candidates all are returned; equal scores go to the
    smaller id; a table without queries gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = stored(_usable(vectors, key, value), "vectors")
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    first = rows.agg(F.max(size).alias("norm"), F.max(F.size("v")).alias("d")).first()
    if first["d"] is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    hashes = spark.sparkContext.broadcast(Hashes(first["d"], first["norm"]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                found = hashes.value.cells(_matrix(b.column("v"))).ravel()
                cell, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], ["cell", "n"])

    # at most TABLES * BINS ** HASHES buckets
    counts = rows.mapInArrow(place, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    directory = Directory(counts.column("cell").to_numpy(), counts.column("n").to_numpy(), part_rows)
    queries = rows.filter(F.col("id") % every == 0)
    share = _fitted(rows, queries, hashes.value, directory, k, recall, sample)
    shared = spark.sparkContext.broadcast(directory)

    names = ["part", "query", "id", "cell", "effort", "v"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row to one part of each table."""
        for b in batches:
            if b.num_rows:
                cells, ids = hashes.value.cells(_matrix(b.column("v"))), np.asarray(b.column("id"))
                for t in range(TABLES):
                    part = shared.value.part(cells[:, t], ids)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part), pa.array(np.zeros(len(ids), bool)), b.column("id"),
                         pa.array(cells[:, t]), pa.nulls(len(ids), pa.float64()), b.column("v")], names)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query to each part that holds a bucket it visits, with the cost up to which it does."""
        d = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 32):
                b = whole.slice(at, 32)
                costs = hashes.value.costs(_matrix(b.column("v")), d.cells)
                efforts = d.efforts(costs, share)
                parts = [d.parts_of(np.flatnonzero(c <= e)) for c, e in zip(costs, efforts)]
                which = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(parts)), pa.array(np.ones(len(which), bool)), b.column("id").take(pa.array(which)),
                     pa.nulls(len(which), pa.int64()), pa.array(efforts[which]), b.column("v").take(pa.array(which))], names)

    kind = rows.schema["v"].dataType.simpleString()
    schema = f"part long, query boolean, id long, cell long, effort double, v {kind}"
    dealt = rows.mapInArrow(deal, schema).unionByName(queries.mapInArrow(visit, schema))
    dealt = dealt.repartition(directory.parts, "part").sortWithinPartitions("part", "query", "id")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, cells, x, query, q, efforts in _parts(batches):
            yield _nearest(ids, cells, x, query, q, hashes.value, efforts, k)

    found = dealt.mapInArrow(rank, "query_id long, vec_id long, score double").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def _parts(batches: Iterator[pa.RecordBatch]):
    """For each part its rows (ids, cells, vectors) and its queries, a batch at a time."""
    state = {"part": None, "rows": [], "ready": None}

    def rows_of(state):
        if state["ready"] is None and state["rows"]:
            ids, cells, x = (np.concatenate(c) for c in zip(*state["rows"]))
            order = np.argsort(cells, kind="stable")
            state["ready"] = ids[order], cells[order], x[order]
        return state["ready"]

    for b in batches:
        if not b.num_rows:
            continue
        part, query = np.asarray(b.column("part")), np.asarray(b.column("query").cast(pa.int8()))
        edges = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (query[1:] != query[:-1]), [True]]))
        for a, z in zip(edges[:-1].tolist(), edges[1:].tolist()):
            s = b.slice(a, z - a)
            if part[a] != state["part"]:
                state = {"part": part[a], "rows": [], "ready": None}
            if not query[a]:
                state["rows"].append((np.asarray(s.column("id")), np.asarray(s.column("cell")), _matrix(s.column("v"))))
                continue
            ready = rows_of(state)
            for i in range(0, s.num_rows if ready else 0, 128):
                c = s.slice(i, 128)
                yield *ready, np.asarray(c.column("id")), _matrix(c.column("v")), np.asarray(c.column("effort"))


def _nearest(ids, cells, x, query, q, hashes, efforts, k) -> pa.RecordBatch:
    """The k best rows of a part for each query, looking only at the buckets it visits."""
    edges = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1], [True]]))
    visited = hashes.costs(q, cells[edges[:-1]]) <= efforts[:, None]
    scores = np.full((len(query), len(ids)), -np.inf)
    for n, (a, z) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        asking = np.flatnonzero(visited[:, n])
        if len(asking):
            scores[asking, a:z] = q[asking] @ x[a:z].T
    scores[ids[None, :] == query[:, None]] = -np.inf
    out = []
    for i, row in enumerate(scores):
        open_ = np.flatnonzero(row > -np.inf)
        if len(open_) > k * TABLES:  # a part may hold a row once for each table
            # a margin for rounding, then the exact product, which is alike for equal vectors
            limit = np.partition(row[open_], len(open_) - k * TABLES)[len(open_) - k * TABLES]
            open_ = open_[row[open_] >= limit - 1e-9 * (1 + abs(limit))]
        open_ = open_[np.unique(ids[open_], return_index=True)[1]]
        exact = (x[open_] * q[i]).sum(axis=1)
        best = _best(ids[open_], exact, k)
        out.append((np.full(len(best), query[i]), ids[open_][best], exact[best]))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query_id", "vec_id", "score"])


def _fitted(rows: DataFrame, queries: DataFrame, hashes: Hashes, directory: Directory, k: int, recall: float, sample: int) \
        -> float:
    """The share of rows to visit: sample queries are answered exactly by a pass over all rows."""
    asked = queries.orderBy(F.xxhash64("id"), "id").limit(sample).toArrow()
    if not asked.num_rows:
        return 1.0
    query, q = asked.column("id").to_numpy(), _matrix(asked.column("v").combine_chunks())
    shared = rows.sparkSession.sparkContext.broadcast((query, q))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, q = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            x, ids = _matrix(b.column("v")), np.asarray(b.column("id"))
            cells, scores = hashes.cells(x), q @ x.T
            scores[ids[None, :] == query[:, None]] = -np.inf
            best = np.array([_best(ids, s, k) for s in scores])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(query)), best.shape[1])), pa.array(ids[best].ravel()),
                 pa.array(np.take_along_axis(scores, best, axis=1).ravel()),
                 pa.array(cells[best.ravel()].tolist(), pa.list_(pa.int64()))], ["query", "id", "score", "cells"])

    found = rows.mapInArrow(exact, "query long, id long, score double, cells array<long>").filter("score > double('-Infinity')")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    true = found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k).select("query", "cells").toArrow()
    if not true.num_rows:
        return 1.0
    costs, total = hashes.costs(q, directory.cells), directory.rows.sum()
    needed = []
    for i in range(len(query)):
        own = np.array([c for n, c in zip(true.column("query").to_pylist(), true.column("cells").to_pylist()) if n == i])
        if len(own):
            order = np.argsort(costs[i], kind="stable")
            reached = np.empty(len(order))
            reached[order] = np.cumsum(directory.rows[order]) / total
            needed.extend(reached[np.searchsorted(directory.cells, own)].min(axis=1))
    return float(np.quantile(needed, recall))
