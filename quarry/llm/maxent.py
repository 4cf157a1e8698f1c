"""Language-model scoring with a hashed maximum-entropy model.

A token's probability is that of its class times that of the token in its class.
The ``FREQUENT`` most frequent tokens are in classes of ``MEMBERS``; all others
are in ``SHAPES`` classes by their last two bytes, where a token's share is its
smoothed count.  Class and member are log-linear in the context: an n-gram
feature of the token before, a skip feature of the shape of the token before
that, and a hashed feature of both together.

All training text is reduced to counts of (context, outcome), which are the
model's sufficient statistics; gradient updates run in parallel over parts of
these counts and are averaged, weighted by how often a part has seen a feature.
Scoring turns the weights into tables and looks up whole batches of tokens.
Token counts of any vocabulary are joined in the cluster; only a bounded number
of frequent ones is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import crc_mod, ship, small_batches, stored, texts_of
from quarry.llm.suffixes import _mix, word_hashes

FREQUENT, MEMBERS, SHAPES = 512, 32, 64
CLASSES = FREQUENT // MEMBERS + SHAPES
#: values of a context's first and second feature, buckets of their joint feature, and shape groups in a class
BEFORE, BUCKETS, GROUPS = FREQUENT + SHAPES, 1_024, 4
#: frequent tokens whose counts are broadcast; other counts are joined
KNOWN = 200_000
#: rounds of parallel updates, parts, and updates of a part in a round
ROUNDS, PARTS, STEPS, RATE = 5, 4, 10, 0.5
END, END_SHAPE = np.uint64(1), 0
#: bytes of the tokens: A-Z lower-cased, white space to space
_TABLE = bytes(32 if c == 32 or 9 <= c <= 13 else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and shape of every token of all texts, each text followed by an end, and the first token of each text."""
    h, first, last = word_hashes(texts, _TABLE, with_ends=True)
    shape = (_mix(last.astype(np.uint64)) % np.uint64(SHAPES)).astype(np.int64)
    ends = first[1:]
    return np.insert(h | np.uint64(2), ends, END), np.insert(shape, ends, END_SHAPE), first + np.arange(len(first))


def _learned(doc_id: str = "doc_id") -> Column:
    return F.coalesce(crc_mod(F.col(doc_id), 5) != 1, F.lit(False))


def token_counts(docs: DataFrame) -> DataFrame:
    """token (hash), shape and n of the training tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def merged():
            token, shape, n = (np.concatenate(c) for c in zip(*held))
            token, at, where = np.unique(token, return_index=True, return_inverse=True)
            return token, shape[at], np.bincount(where, n, len(token)).astype(np.int64)

        for b in small_batches(batches, "text", 1 << 20):
            token, shape, _ = tokens(texts_of(b, "text"))
            token, at, n = np.unique(token, return_index=True, return_counts=True)
            held.append((token, shape[at], n))
            if sum(len(x[0]) for x in held) > 1_500_000:
                held = [merged()]
                if len(held[0][0]) > 800_000:
                    yield _counts(*held.pop())
        if held:
            yield _counts(*merged())

    rows = docs.filter(_learned()).select("text").mapInArrow(run, "token long, shape long, n long")
    return rows.groupBy("token").agg(F.first("shape").alias("shape"), F.sum("n").alias("n"))


def _counts(token: np.ndarray, shape: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(shape), pa.array(n)], ["token", "shape", "n"])


class Vocabulary:
    """The frequent tokens by rank, the counts of known ones, and the totals."""

    def __init__(self, token: np.ndarray, n: np.ndarray, total: int, distinct: int, shape_total: np.ndarray,
                 shape_distinct: np.ndarray):
        self.total, self.distinct = total, distinct
        self.shape_total, self.shape_distinct = shape_total, shape_distinct
        order = np.argsort(token)
        self.known, self.n = token[order], n[order]
        rank = np.full(len(token), -1)
        rank[:FREQUENT] = np.arange(min(FREQUENT, len(token)))
        self.rank = rank[order]

    def look(self, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (-1: not frequent) and count (0: not among the known) of tokens."""
        at = np.minimum(np.searchsorted(self.known, token), len(self.known) - 1)
        hit = self.known[at] == token
        return np.where(hit, self.rank[at], -1), np.where(hit, self.n[at], 0)


def contexts(rank: np.ndarray, shape: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First feature (token before, or its shape) and second (shape of the one before that) of every token's context.
    A text starts after an end."""
    own = np.where(rank >= 0, rank, FREQUENT + shape)
    end = own[-1:]  # every text ends with the end token
    before = np.concatenate([end, own[:-1]])
    skipped = np.concatenate([[END_SHAPE, END_SHAPE], shape[:-2]])[:len(shape)]
    skipped[starts] = END_SHAPE
    return before, skipped


def _bucket(pair: np.ndarray) -> np.ndarray:
    return (_mix(pair.astype(np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)


def _count_contexts(docs: DataFrame, vocabulary) -> DataFrame:
    """kind (0 class, 1 member), cell (context and outcome) and n over all training tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_class = np.zeros(BEFORE * SHAPES * CLASSES, np.int32)
        by_member = np.zeros(BEFORE * GROUPS * FREQUENT, np.int32)
        for b in small_batches(batches, "text", 1 << 20):
            token, shape, first = tokens(texts_of(b, "text"))
            rank, _ = vocabulary.value.look(token)
            before, skipped = contexts(rank, shape, first[:-1])
            outcome = np.where(rank >= 0, rank // MEMBERS, FREQUENT // MEMBERS + shape)
            by_class += np.bincount((before * SHAPES + skipped) * CLASSES + outcome, minlength=len(by_class)).astype(np.int32)
            hit = rank >= 0
            cell = (before[hit] * GROUPS + skipped[hit] % GROUPS) * FREQUENT + rank[hit]
            by_member += np.bincount(cell, minlength=len(by_member)).astype(np.int32)
        for kind, table in enumerate((by_class, by_member)):
            cell = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), kind)), pa.array(cell), pa.array(table[cell].astype(np.int64))],
                                             ["kind", "cell", "n"])

    return docs.filter(_learned()).select("text").mapInArrow(run, "kind long, cell long, n long") \
        .groupBy("kind", "cell").agg(F.sum("n").alias("n"))


class Weights:
    """Log-linear weights: for the class by first feature, second feature and joint bucket; for the member by first
    feature and shape group; and a bias for each."""

    def __init__(self):
        z = lambda *s: np.zeros(s, np.float32)
        self.parts = [z(1, CLASSES), z(BEFORE, CLASSES), z(SHAPES, CLASSES), z(BUCKETS, CLASSES),
                      z(1, FREQUENT), z(BEFORE, FREQUENT), z(GROUPS, FREQUENT)]

    def class_rows(self) -> list[np.ndarray]:
        """For each context (first, second) the row of each class weight."""
        pair = np.arange(BEFORE * SHAPES)
        return [np.zeros(len(pair), np.int64), pair // SHAPES, pair % SHAPES, _bucket(pair)]

    def member_rows(self) -> list[np.ndarray]:
        pair = np.arange(BEFORE * GROUPS)
        return [np.zeros(len(pair), np.int64), pair // GROUPS, pair % GROUPS]

    def class_logs(self, keep: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Natural log-probabilities of the classes in each context."""
        z = sum(w[r[keep]] for w, r in zip(self.parts[:4], self.class_rows()))
        return _log_softmax(z)

    def member_logs(self, keep: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = sum(w[r[keep]] for w, r in zip(self.parts[4:], self.member_rows()))
        return _log_softmax(z.reshape(len(z), -1, MEMBERS)).reshape(len(z), FREQUENT)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Decadic log-probabilities for scoring, made once in a process."""
        if not hasattr(self, "_tables"):
            self._tables = [(t / np.log(10)).astype(np.float64).ravel() for t in (self.class_logs(), self.member_logs())]
        return self._tables

    def __getstate__(self):
        return {"parts": self.parts}


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=-1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=-1, keepdims=True))


def _updates(weights: Weights, by_class: np.ndarray, by_member: np.ndarray, steps: int, rate: float) \
        -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Adaptive gradient steps on counts (context x outcome); the changes, and how often each weight row was seen."""
    local = Weights()
    local.parts = [p.copy() for p in weights.parts]
    squares = [np.full(p.shape, 1e-6, np.float32) for p in local.parts]
    sides = []
    for counts, rows, logs, parts in ((by_class, weights.class_rows(), local.class_logs, slice(0, 4)),
                                      (by_member, weights.member_rows(), local.member_logs, slice(4, 7))):
        keep = np.flatnonzero(counts.any(axis=1))
        sides.append((counts[keep].astype(np.float32), [r[keep] for r in rows], keep, logs, range(*parts.indices(7))))
    seen = [np.zeros(len(p), np.float64) for p in local.parts]
    for counts, rows, keep, logs, which in sides:
        for k, r in zip(which, rows):
            np.add.at(seen[k], r, counts.sum(axis=1))
    for _ in range(steps):
        for counts, rows, keep, logs, which in sides:
            if not len(keep):
                continue
            p = np.exp(logs(keep))
            # in a class, a member competes with that class's counts only
            groups = counts.reshape(len(counts), -1, MEMBERS) if which.start else counts[:, None, :]
            error = (groups - groups.sum(axis=2, keepdims=True) * p.reshape(groups.shape)).reshape(counts.shape)
            for k, r in zip(which, rows):
                order = np.argsort(r, kind="stable")
                cuts = np.flatnonzero(np.concatenate([[True], np.diff(r[order]) > 0]))
                gradient = np.zeros_like(local.parts[k])
                gradient[r[order][cuts]] = np.add.reduceat(error[order], cuts, axis=0)
                gradient /= np.maximum(seen[k], 1)[:, None] ** 0.5
                squares[k] += gradient ** 2
                local.parts[k] += rate * gradient / np.sqrt(squares[k])
    return [a - b for a, b in zip(local.parts, weights.parts)], seen


def train(counts: DataFrame, rounds: int = ROUNDS, parts: int = PARTS, steps: int = STEPS, rate: float = RATE) -> Weights:
    """Weights after ``rounds`` of updates over ``parts`` parts of the counts, averaged after each round."""
    spark = counts.sparkSession
    dealt = stored(counts.repartition(parts, "cell"), "counts")
    sizes = [p.size for p in Weights().parts]
    rows = [len(p) for p in Weights().parts]
    weights = Weights()
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tables = [np.zeros(BEFORE * SHAPES * CLASSES), np.zeros(BEFORE * GROUPS * FREQUENT)]
            for b in batches:
                kind, cell, n = (np.asarray(b.column(c)) for c in ("kind", "cell", "n"))
                for k in (0, 1):
                    tables[k][cell[kind == k]] += n[kind == k]
            if any(t.any() for t in tables):
                change, seen = _updates(shared.value, tables[0].reshape(-1, CLASSES), tables[1].reshape(-1, FREQUENT), steps, rate)
                packed = np.concatenate([c.ravel() for c in change] + [s.astype(np.float32) for s in seen])
                yield pa.RecordBatch.from_arrays([pa.array([packed.astype("<f4").tobytes()], pa.binary())], ["change"])

        # one array of bounded size from each part
        found = dealt.coalesce(parts).mapInArrow(run, "change binary").collect()
        sums, seen = np.zeros(sum(sizes)), [np.zeros(n) for n in rows]
        for r in found:
            x = np.frombuffer(r["change"], "<f4").astype(np.float64)
            own = np.split(x[sum(sizes):], np.cumsum(rows)[:-1])
            weight = np.concatenate([np.repeat(s, size // n) for s, size, n in zip(own, sizes, rows)])
            sums += x[:sum(sizes)] * weight
            seen = [a + b for a, b in zip(seen, own)]
        total = np.concatenate([np.repeat(s, size // n) for s, size, n in zip(seen, sizes, rows)])
        step = np.split(sums / np.maximum(total, 1), np.cumsum(sizes)[:-1])
        after = Weights()
        after.parts = [(p + s.reshape(p.shape)).astype(np.float32) for p, s in zip(weights.parts, step)]
        weights = after
    return weights


def learn(docs: DataFrame) -> tuple[Vocabulary, DataFrame, Weights] | None:
    """Vocabulary, token counts and weights from the training rows; None if there are none."""
    counts = stored(token_counts(docs), "tokens")
    top = counts.orderBy(F.col("token") != int(END), F.desc("n"), "token").limit(KNOWN).toArrow()
    if not top.num_rows:
        return None
    token, n = top.column("token").to_numpy().view(np.uint64), top.column("n").to_numpy()
    frequent = counts.sparkSession.createDataFrame(pa.table({"token": token[:FREQUENT].view(np.int64)}))
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    rare = counts.join(F.broadcast(frequent), "token", "left_anti").groupBy("shape").agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    sums, distinct = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in rare.collect():  # a row for each shape
        sums[r["shape"]], distinct[r["shape"]] = r["n"], r["v"]
    vocabulary = Vocabulary(token, n, totals["n"], totals["v"], sums, distinct)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return vocabulary, counts, train(_count_contexts(docs, shared))


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    The model learns from the rows whose crc32(doc_id) mod 5 is not 1.  Defined
    cases: a null text is an empty one, whose only token is its end; rows
    without a doc_id are held out; repeated rows are learned from and scored
    each; without training rows both scores are 0 (a single unknown token has
    all the probability); other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    learned = learn(rows)
    if learned is None:
        learned = Vocabulary(np.array([END]), np.zeros(1, np.int64), 0, 0, np.zeros(SHAPES), np.zeros(SHAPES)), None, None
    vocabulary, counts, weights = learned
    shared = spark.sparkContext.broadcast((vocabulary, weights))
    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, token long"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document, and one (with token) for each occurrence of a token whose count must be joined."""
        vocabulary, weights = shared.value
        log_total = np.log10(vocabulary.total + 0.5 * (vocabulary.distinct + 1))
        log_shape = np.log10(vocabulary.shape_total + 0.5 * (vocabulary.shape_distinct + 1))
        at = TaskContext.get().partitionId() << 40
        for b in small_batches(batches, "text", 1 << 20):
            token, shape, first = tokens(texts_of(b, "text"))
            rank, n = vocabulary.look(token)
            joined = (n == 0) & (vocabulary.total > 0)
            own = np.where(joined, 0.0, np.log10(n + 0.5))
            model = np.zeros(len(token))
            if weights is not None:
                by_class, by_member = weights.tables()
                before, skipped = contexts(rank, shape, first[:-1])
                outcome = np.where(rank >= 0, rank // MEMBERS, FREQUENT // MEMBERS + shape)
                model = by_class[(before * SHAPES + skipped) * CLASSES + outcome]
                member = by_member[(before * GROUPS + skipped % GROUPS) * FREQUENT + np.maximum(rank, 0)]
                model += np.where(rank >= 0, member, own - log_shape[shape])
            else:
                own = np.zeros(len(token))
                log_total = 0.0
            sums = lambda x: np.add.reduceat(x, first[:-1], dtype=np.float64)
            ids = np.arange(at, at + b.num_rows)
            at += b.num_rows
            sizes = np.diff(first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), b.column("doc_id"), b.column("held_out"), pa.array(sizes),
                 pa.array(sums((n > 0).astype(np.float64)).astype(np.int64)), pa.array(sums(own) - sizes * log_total),
                 pa.array(sums(model)), pa.nulls(b.num_rows, pa.int64())], names)
            rare = np.flatnonzero(joined)
            text = np.repeat(np.arange(b.num_rows), sizes)[rare]
            none = lambda t: pa.nulls(len(rare), t)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[text]), none(pa.int64()), none(pa.bool_()), none(pa.int64()), none(pa.int64()), none(pa.float64()),
                 none(pa.float64()), pa.array(token[rare].view(np.int64))], names)

    found = rows.withColumn("held_out", ~_learned()).mapInArrow(run, schema)
    result = [F.col("n_tokens"), F.col("n_known"), F.lit(int(vocabulary.total)).cast("long").alias("train_tokens")]
    if counts is None:
        return found.filter("token is null").select("doc_id", "held_out", *result, F.col("base").alias("base_score"),
                                                    F.col("model").alias("score"))
    found = stored(found, "scores")
    rare = found.filter("token is not null").groupBy("row", "token").agg(F.count("*").alias("times"))
    rare = rare.join(counts.select("token", "n"), "token", "left").groupBy("row").agg(
        F.sum("times").alias("times"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("log"))
    both = found.filter("token is null").drop("token").join(rare, "row", "left")
    log, known = F.coalesce("log", F.lit(0.0)), F.coalesce("known", F.lit(0))
    return both.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + known).alias("n_known"), result[2],
                       (F.col("base") + log).alias("base_score"), (F.col("model") + log).alias("score"))
