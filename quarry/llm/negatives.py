"""Hard negatives through a GNAT tree (geometric near-neighbour access tree).

Vectors get one more component that gives all the largest norm M, so that an inner
product with an anchor is a distance from it: d^2 = |a|^2 + M^2 - 2 a.x.  A node of
the tree has ``FAN`` split points, far from each other; a vector belongs to the
nearest one, so the borders between siblings are hyperplanes.  For each pair of
siblings i, j the node stores the range of distances from split point i to the
vectors below j.  A search for scores in a window looks for distances in an annulus
around the anchor; by the triangle inequality j cannot hold any if, for some i, the
distances that the annulus allows from i do not meet the stored range.  What is
left is searched exactly.

The upper tree is fitted on a bounded sample, but all ranges come from all
vectors.  Vectors are dealt into leaves by their cell; a cell with more than a
leaf's rows has several.  Each leaf is a node of its own again.  Anchors first
search their own leaf, which bounds the distance of their last positive, then all
leaves within it, then all leaves that meet the windows of their positives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import ship, stored
from quarry.operators.ranking import top_k_per_group

FAN, DEPTH = 16, 3
#: rows and bytes of the sample that split points are chosen from
SAMPLE_ROWS, SAMPLE_BYTES = 1 << 16, 1 << 25
LEAF_ROWS = (2048, 1 << 15)
#: anchors that search a leaf in one task
ANCHORS = 1 << 20
LAST = 2**63 - 1


class Space:
    """Vectors as numbers: packed as ``kind``, of ``dimension`` components and norm of at most sqrt(``norm2``)."""

    def __init__(self, kind: str, dimension: int, norm2: float):
        self.kind, self.dimension, self.norm2 = kind, dimension, norm2
        self.slack = 1e-6 * max(norm2, 1.0) ** 0.5

    def unpack(self, column: pa.Array) -> np.ndarray:
        values = column.to_pylist()
        return np.frombuffer(b"".join(values), self.kind).reshape(len(values), self.dimension).astype(np.float64)

    def products(self, a: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Exact inner products.  Doubles hold them up to 2^53, and no partial sum is beyond the product of the lengths;
        pairs of longer vectors are worked out in whole numbers."""
        out = a @ x.T
        if self.norm2 < 2**52:
            return out
        lengths = np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(x, axis=1))
        if not (lengths >= 2**52).any():
            return out
        out = out.astype(object)
        for i, j in zip(*np.nonzero(lengths >= 2**52)):
            out[i, j] = sum(int(p) * int(q) for p, q in zip(a[i].tolist(), x[j].tolist()))
        return out

    def lifted(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([x, np.sqrt(np.maximum(self.norm2 - (x * x).sum(axis=1), 0.0))[:, None]])

    def radius(self, own2: np.ndarray, score: np.ndarray) -> np.ndarray:
        """The distance from an anchor of squared length ``own2`` at which vectors have the score."""
        return np.sqrt(np.maximum(own2 + self.norm2 - 2 * score.astype(np.float64), 0.0))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0))


def split_points(x: np.ndarray, fan: int, rng: np.random.Generator) -> np.ndarray:
    """Rows of ``x`` far from each other: of some drawn ones, each time the one farthest from those taken."""
    drawn = x[rng.choice(len(x), min(len(x), 3 * fan), replace=False)]
    taken = [0]
    near = distances(drawn, drawn[:1])[:, 0]
    while len(taken) < min(fan, len(drawn)) and near.max() > 0:
        taken.append(int(near.argmax()))
        near = np.minimum(near, distances(drawn, drawn[taken[-1:]])[:, 0])
    return drawn[taken]


def ranges(far: np.ndarray, child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest distance from split point i (columns of ``far``) to the rows below j: two tables [i, j]."""
    n = far.shape[1]
    low, high = np.full((n, n), np.inf), np.full((n, n), -np.inf)
    for j in np.unique(child):
        low[:, j], high[:, j] = far[child == j].min(axis=0), far[child == j].max(axis=0)
    return low, high


def alive(far: np.ndarray, inner: np.ndarray, outer: np.ndarray, low: np.ndarray, high: np.ndarray, slack: float) -> np.ndarray:
    """Which siblings [row, j] may hold a vector between ``inner`` and ``outer`` of the row's anchor."""
    least = np.maximum(far - outer[:, None], inner[:, None] - far) - slack
    most = far + outer[:, None] + slack
    return ((most[:, :, None] >= low) & (least[:, :, None] <= high)).all(axis=1)


class Tree:
    """Nodes of split points; a child is a node's number or, below zero, ~cell."""

    def __init__(self, x: np.ndarray, depth: int, fan: int = FAN, seed: int = 11):
        self.points: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.cells = 0
        self._grow(x, depth, fan, np.random.default_rng(seed))

    def _grow(self, x: np.ndarray, depth: int, fan: int, rng: np.random.Generator) -> int:
        if not depth or len(x) < 2 * fan:
            self.cells += 1
            return ~(self.cells - 1)
        number = len(self.points)
        points = split_points(x, fan, rng)
        self.points.append(points), self.children.append([])
        child = distances(x, points).argmin(axis=1)
        self.children[number] = [self._grow(x[child == j], depth - 1, fan, rng) for j in range(len(points))]
        return number

    def descend(self, x: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
        """The cell of each row; and for each node met, the distances of its rows to its split points and their children."""
        cell, met = np.zeros(len(x), np.int64), []
        todo = [(0, np.arange(len(x)))] if self.points else []
        while todo:
            node, rows = todo.pop()
            far = distances(x[rows], self.points[node])
            child = far.argmin(axis=1)
            met.append((node, far, child))
            for j, below in enumerate(self.children[node]):
                some = rows[child == j]
                if below < 0:
                    cell[some] = ~below
                elif len(some):
                    todo.append((below, some))
        return cell, met

    def visits(self, x: np.ndarray, inner: np.ndarray, outer: np.ndarray, slack: float) -> list[tuple[np.ndarray, int]]:
        """(rows, cell): which anchors have to search which cell."""
        out, todo = [], [(0 if self.points else ~0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                out.append((rows, ~node))
                continue
            keep = alive(distances(x[rows], self.points[node]), inner[rows], outer[rows], self.low[node], self.high[node], slack)
            todo += [(below, rows[keep[:, j]]) for j, below in enumerate(self.children[node])]
        return out


def best(scores: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, columns) of each row's largest score, then of the next, k times; equal ones from left to right.  Changes ``scores``."""
    rows = np.arange(len(scores))
    for _ in range(min(k, scores.shape[1])):
        column = scores.argmax(axis=1)
        some = scores[rows, column] > -np.inf
        if not some.any():
            return
        yield rows[some], column[some]
        scores[rows[some], column[some]] = -np.inf


class Leaf:
    """The rows of one leaf, by vec_id, under a node of their own."""

    def __init__(self, space: Space, uid: np.ndarray, vec_id: np.ndarray, label: np.ndarray, x: np.ndarray):
        order = np.lexsort((uid, vec_id))
        self.space, self.uid, self.vec_id, self.label, self.x = space, uid[order], vec_id[order], label[order], x[order]
        lifted = space.lifted(self.x)
        self.points = split_points(lifted, FAN, np.random.default_rng(5))
        far = distances(lifted, self.points)
        child = far.argmin(axis=1)
        self.low, self.high = ranges(far, child)
        self.groups = [np.flatnonzero(child == j) for j in range(len(self.points))]

    def scores(self, a: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> np.ndarray:
        """Inner products of anchors with the rows of all groups that may matter to them; elsewhere minus infinity."""
        flat = np.hstack([a, np.zeros((len(a), 1))])
        keep = alive(distances(flat, self.points), inner, outer, self.low, self.high, self.space.slack)
        out = np.full((len(a), len(self.x)), -np.inf)
        for j, group in enumerate(self.groups):
            some = np.flatnonzero(keep[:, j])
            if len(some) and len(group):
                found = self.space.products(a[some], self.x[group])
                out = out.astype(found.dtype) if found.dtype == object else out
                out[np.ix_(some, group)] = found
        return out

    def positives(self, uid: np.ndarray, label: np.ndarray, a: np.ndarray, outer: np.ndarray, k: int) -> list[np.ndarray]:
        """rows, uid, vec_id, score of the best k other rows of the anchor's label."""
        scores = self.scores(a, np.zeros(len(a)), outer)
        scores[label[:, None] != self.label] = -np.inf
        _, mine, here = np.intersect1d(uid, self.uid, return_indices=True)
        scores[mine, here] = -np.inf
        kept, found = scores.copy(), list(best(scores, k))
        rows, columns = (np.concatenate([np.zeros(0, np.int64), *c]) for c in (list(zip(*found)) or [(), ()]))
        return [rows, self.uid[columns], self.vec_id[columns], kept[rows, columns]]

    def negatives(self, label: np.ndarray, a: np.ndarray, windows: list[list[int]], low: int, high: int, k: int) -> list[np.ndarray]:
        """rows, window number, uid, vec_id, score of the best k rows of other labels in each of the anchor's windows."""
        width = max(map(len, windows))
        own2 = (a * a).sum(axis=1)
        # 100 s between low p and high p; missing windows are empty
        kind = object if any(abs(p) >= 2**46 for w in windows for p in w) else np.float64
        floor = np.array([[-(-low * p // 100) for p in w] + [1] * (width - len(w)) for w in windows], dtype=kind)
        ceil = np.array([[high * p // 100 for p in w] + [0] * (width - len(w)) for w in windows], dtype=kind)
        some = floor <= ceil
        top, least = np.where(some, ceil, -np.inf).max(axis=1), np.where(some, floor, np.inf).min(axis=1)
        live = some.any(axis=1)
        inner, outer = (self.space.radius(own2, np.where(live, s, 0.0)) for s in (top, least))
        scores = self.scores(a, inner, np.where(live, outer, -np.inf))
        scores[label[:, None] == self.label] = -np.inf
        out: list[list[np.ndarray]] = [[], [], []]
        for w in range(width):
            inside = np.where((scores >= floor[:, w, None]) & (scores <= ceil[:, w, None]), scores, -np.inf)
            for rows, columns in best(inside, k):
                out[0].append(rows), out[1].append(np.full(len(rows), w)), out[2].append(columns)
        rows, number, columns = (np.concatenate([np.zeros(0, np.int64), *c]) for c in out)
        return [rows, number, self.uid[columns], self.vec_id[columns], scores[rows, columns]]


# on Spark -----------------------------------------------------------------
def _usable(embeddings: DataFrame, label: Column, scale: int) -> DataFrame:
    # a double of 2^52 or more is whole
    whole = lambda y: F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)
    parts = F.transform("embedding", lambda x: whole(x.cast("double") * scale))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return embeddings.where(F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), parts.alias("x")).where("label is not null")


def _packed(rows: DataFrame, space: Space) -> DataFrame:
    """uid, vec_id, label, vec: components as bytes, shorter vectors filled up with zeros."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("x")
            sizes = np.diff(np.asarray(lists.offsets))
            out = np.zeros((b.num_rows, space.dimension))
            out[np.arange(space.dimension) < sizes[:, None]] = np.asarray(lists.flatten())
            packed = out.astype(space.kind)
            yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("vec_id"), b.column("label"),
                                              pa.array([r.tobytes() for r in packed], pa.binary())], ["uid", "vec_id", "label", "vec"])

    return rows.mapInArrow(run, "uid long, vec_id long, label long, vec binary")


def _leaves(rows: DataFrame, space: Space, count: int) -> tuple[DataFrame, Tree, DataFrame, int]:
    """Rows with their leaf, the tree with its ranges, the leaves of each cell, and how many leaves there are."""
    size = int(min(max(count // 32, LEAF_ROWS[0]), LEAF_ROWS[1]))
    depth = int(min(max(round(np.log(max(count / size, 1)) / np.log(FAN)), 0), DEPTH))
    fit = int(min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * (space.dimension + 1))))
    sample = rows.orderBy(F.xxhash64("uid")).limit(fit if depth else 1).select("vec").toArrow().column("vec").combine_chunks()
    tree = Tree(space.lifted(space.unpack(sample)), depth)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, _ = tree.descend(space.lifted(space.unpack(b.column("vec"))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], [*b.schema.names, "cell"])

    dealt = stored(rows.mapInArrow(deal, "uid long, vec_id long, label long, vec binary, cell long"), "cells")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for node, far, child in tree.descend(space.lifted(space.unpack(b.column("vec"))))[1]:
                low, high = ranges(far, child)
                old = found.get(node, (low, high))
                found[node] = np.minimum(old[0], low), np.maximum(old[1], high)
        for node, (low, high) in found.items():
            i, j = np.nonzero(high >= low)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), node)), pa.array(i), pa.array(j), pa.array(low[i, j]),
                                              pa.array(high[i, j])], ["node", "i", "j", "low", "high"])

    for points in tree.points:
        tree.low.append(np.full((len(points), len(points)), np.inf))
        tree.high.append(np.full((len(points), len(points)), -np.inf))
    if tree.points:  # at most FAN^2 rows for each of the tree's nodes
        for r in dealt.mapInArrow(measure, "node long, i long, j long, low double, high double").groupBy("node", "i", "j") \
                .agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
            tree.low[r["node"]][r["i"], r["j"]], tree.high[r["node"]][r["i"], r["j"]] = r["low"], r["high"]
    cells = dealt.groupBy("cell").count().select("cell", F.ceil(F.col("count") / size).alias("parts"))
    cells = stored(cells.repartition(1).sortWithinPartitions("cell"), "leaves")  # a row for each cell, at most FAN^DEPTH
    leaves = cells.agg(F.sum("parts")).first()[0]
    leaf = F.col("cell") * (1 << 32) + F.pmod(F.xxhash64("uid"), F.col("parts"))
    return stored(dealt.join(cells, "cell").select("uid", "vec_id", "label", "vec", leaf.alias("leaf")), "leaves"), tree, cells, leaves


_WITH = "leaf long, block long, kind long, uid long, vec_id long, label long, vec binary, bound double, scores array<long>"


def _parts(batches: Iterator[pa.RecordBatch], space: Space) -> Iterator[tuple[Leaf, pa.RecordBatch | None]]:
    """(leaf, anchors) in blocks; a leaf's rows (kind 0) come before its anchors (kind 1)."""
    held: list[pa.RecordBatch] = []
    leaf, at = None, None
    for b in batches:
        key = np.stack([np.asarray(b.column(c)) for c in ("leaf", "block", "kind")])
        edges = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), b.num_rows]
        for a, z in zip(edges, edges[1:]):
            if a == z:
                continue
            where, kind = tuple(key[:2, a].tolist()), int(key[2, a])
            if where != at:
                held, leaf, at = [], None, where
            if kind == 0:
                held.append(b.slice(a, z - a))
                continue
            if not held:
                continue
            if leaf is None:
                t = pa.concat_batches(held)
                leaf = Leaf(space, np.asarray(t.column("uid")), np.asarray(t.column("vec_id").fill_null(LAST)),
                            np.asarray(t.column("label")), space.unpack(t.column("vec")))
            step = max(1, (1 << 21) // len(leaf.x))
            for s in range(a, z, step):
                yield leaf, b.slice(s, min(step, z - s))


def _ids(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=values == LAST)


def _longs(values: np.ndarray) -> pa.Array:
    """Scores; beyond 64 bits the nearest long."""
    return pa.array([max(-LAST, min(LAST, int(v))) for v in values] if values.dtype == object else values.astype(np.int64), pa.int64())


def _search(rows: DataFrame, visits: DataFrame, leaves: int, blocks: int, run, schema: str) -> DataFrame:
    """``run`` over every leaf with the anchors that visit it."""
    none = [F.lit(None).cast("double").alias("bound"), F.lit(None).cast("array<long>").alias("scores")]
    table = rows.select("leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(0).cast("long").alias("kind"),
                        "uid", "vec_id", "label", "vec", *none)
    visits = visits.select("leaf", F.pmod(F.xxhash64("uid"), F.lit(blocks)).alias("block"), F.lit(1).cast("long").alias("kind"),
                           "uid", "vec_id", "label", "vec", "bound", "scores")
    wide = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(min(leaves * blocks, wide), leaves * blocks // 8, 1)
    both = table.unionByName(visits).repartition(tasks, "leaf", "block").sortWithinPartitions("leaf", "block", "kind")
    return both.mapInArrow(run, schema)


def mine(embeddings: DataFrame, label: Column | None = None, anchors: Column | None = None, scale: int = 256, positives: int = 5,
         negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``label`` and ``anchors`` are columns over the table (default: label; every
    row).  Components become floor(``scale`` x); scores are integer inner products.
    An anchor's positives are its best ``positives`` other rows of its label; for
    each, the best ``negatives`` rows of other labels with a score of ``low`` to
    ``high`` percent of the positive's.  Ties: smaller vec_id.  Defined cases: rows
    with a null label, a null vector or a component that is null or not finite take
    no part; a shorter vector counts as filled up with zeros; a null vec_id comes
    last among ties; rows that repeat a vec_id are rows of their own (an anchor
    leaves out itself only); an empty table gives no rows; other columns are not
    read.  A score beyond 64 bits counts as the nearest long.
    """
    spark = embeddings.sparkSession
    ship(spark)
    rows = _usable(embeddings, F.col("label") if label is None else label, scale)
    rows = stored(rows.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("dimension"), F.max(square).alias("norm2"),
                     F.max(F.array_max(F.transform("x", F.abs))).alias("largest")).first()
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not facts["n"] or not facts["dimension"]:
        return spark.createDataFrame([], result)
    largest = facts["largest"]
    space = Space("<i2" if largest < 2**15 else "<i4" if largest < 2**31 else "<f8", facts["dimension"], facts["norm2"])
    rows, tree, cells, leaves = _leaves(_packed(rows, space), space, facts["n"])
    chosen = F.lit(True) if anchors is None else anchors
    asked = rows.where(F.coalesce(chosen, F.lit(False)))
    blocks = max(1, -(-asked.count() // ANCHORS))

    # 1. own leaves: how far the last positive may be
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for leaf, b in _parts(batches, space):
            a, uid = space.unpack(b.column("vec")), np.asarray(b.column("uid"))
            found, _, _, score = leaf.positives(uid, np.asarray(b.column("label")), a, np.full(len(a), np.inf), positives)
            last, many = np.full(len(a), np.inf), np.bincount(found, minlength=len(a))
            np.minimum.at(last, found, score.astype(np.float64))
            bound = np.where(many >= positives, space.radius((a * a).sum(axis=1), np.where(many > 0, last, 0.0)), np.inf)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("uid", "vec_id", "label", "vec")), pa.array(bound)],
                                             ["uid", "vec_id", "label", "vec", "bound"])

    bare = asked.withColumn("bound", F.lit(None).cast("double")).withColumn("scores", F.lit(None).cast("array<long>"))
    bounded = _search(rows, bare, leaves, blocks, own, "uid long, vec_id long, label long, vec binary, bound double")

    def spread(windows: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 1024):
                    b = whole.slice(at, 1024)
                    a = space.unpack(b.column("vec"))
                    own2, flat = (a * a).sum(axis=1), np.hstack([a, np.zeros((len(a), 1))])
                    inner, outer = np.zeros(len(a)), np.asarray(b.column("bound").fill_null(np.inf))
                    if windows:
                        kept = [[p for p in s if -(-low * p // 100) <= high * p // 100] for s in b.column("scores").to_pylist()]
                        least = np.array([min((-(-low * p // 100) for p in s), default=0) for s in kept], dtype=np.float64)
                        most = np.array([max((high * p // 100 for p in s), default=0) for s in kept], dtype=np.float64)
                        some = np.array([bool(s) for s in kept])
                        inner, outer = space.radius(own2, most), np.where(some, space.radius(own2, least), -np.inf)
                    for some, cell in tree.visits(flat, inner, outer, space.slack):
                        yield pa.RecordBatch.from_arrays([*(c.take(pa.array(some)) for c in b.columns), pa.array(np.full(len(some), cell))],
                                                         [*b.schema.names, "cell"])
        return run

    def visiting(df: DataFrame, windows: bool) -> DataFrame:
        kind = "uid long, vec_id long, label long, vec binary, bound double, scores array<long>"
        seen = df.select("uid", "vec_id", "label", "vec", "bound", "scores").mapInArrow(spread(windows), f"{kind}, cell long")
        part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
        return seen.join(cells, "cell").withColumn("part", part).withColumn("leaf", F.col("cell") * (1 << 32) + F.col("part"))

    # 2. positives from all leaves within that distance
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for leaf, b in _parts(batches, space):
            a = space.unpack(b.column("vec"))
            found, uid, vec_id, score = leaf.positives(np.asarray(b.column("uid")), np.asarray(b.column("label")), a,
                                                       np.asarray(b.column("bound")), positives)
            yield pa.RecordBatch.from_arrays([b.column("uid").take(pa.array(found)), pa.array(uid), _ids(vec_id), _longs(score)],
                                             ["uid", "other", "positive_id", "score"])

    first = _search(rows, visiting(bounded.withColumn("scores", F.lit(None).cast("array<long>")), False), leaves, blocks, near,
                    "uid long, other long, positive_id long, score long")
    # (1 << 63) - 1 stands for a null id among ties
    order = [F.col("score").desc(), F.col("positive_id").asc_nulls_last(), F.col("other")]
    best_rows = top_k_per_group(first, ["uid"], order, positives, "place")
    lists = stored(best_rows.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "score"))).alias("found")), "positives")
    asked = asked.join(lists, "uid").withColumn("bound", F.lit(None).cast("double")) \
        .withColumn("scores", F.col("found.score"))

    # 3. negatives from all leaves that meet a window
    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for leaf, b in _parts(batches, space):
            a, windows = space.unpack(b.column("vec")), b.column("scores").to_pylist()
            found, number, uid, vec_id, score = leaf.negatives(np.asarray(b.column("label")), a, windows, low, high, negatives)
            yield pa.RecordBatch.from_arrays([b.column("uid").take(pa.array(found)), pa.array(number), pa.array(uid), _ids(vec_id),
                                              _longs(score)], ["uid", "number", "other", "negative_id", "negative_score"])

    second = _search(rows, visiting(asked, True), leaves, blocks, far,
                     "uid long, number long, other long, negative_id long, negative_score long")
    order = [F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last(), F.col("other")]
    ranked = top_k_per_group(second, ["uid", "number"], order, negatives, "rank")
    names = asked.select("uid", F.col("vec_id").alias("anchor_id"), "found")
    out = ranked.join(names, "uid").withColumn("positive", F.get("found", F.col("number").cast("int")))
    return out.select("anchor_id", F.col("positive.positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                      "negative_id", F.col("positive.score").alias("positive_score"), "negative_score")


#: the contract's result in DuckDB SQL
ORACLE = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::double)) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = e.label AS same, e.vec_id, list_dot_product(a.v, e.v)::bigint AS score
      FROM e a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::integer AS rank,
             vec_id AS negative_id, positive_score, score AS negative_score
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT * FROM n WHERE rank <= 3"""
