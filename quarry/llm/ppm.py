"""Language identification by prediction by partial matching (PPM).

Each language has a byte context tree of up to three preceding bytes.  In a
context, a byte that followed it before gets count / (total + distinct); the
rest, distinct / (total + distinct), is the escape probability and is shared by
the other bytes in proportion to the next shorter context, down to equal
probabilities.  The statistics are frozen after learning, so the exact code
length of every (context, byte) is put into one table and a text's code length
is a sum of table entries; the language with the shortest code wins.

Learning reads a bounded, hash-chosen sample of labelled rows; counting runs in
the cluster and only the bounded context statistics reach the driver.  Every
language is learned: more than a model holds are dealt to several models, which
are learned and applied one after the other; the shortest code of all wins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import crc_mod, fresh, ship, small_batches, stored, texts_of

ORDER = 3
#: byte classes: the 127 most frequent bytes, and one for all others
CLASSES, SHIFT = 128, 7
PAD = b"\n" * ORDER
UNKNOWN = "und"


class Model:
    """languages; class of each byte; node of each context; costs in bits by language, node and class."""

    def __init__(self, languages: list[str], grams: list[tuple[np.ndarray, np.ndarray]], max_contexts: int,
                 smooth: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None):
        """``grams``: the four-byte sequences of each language and their counts;
        ``smooth``: probabilities from counts and those of the shorter context."""
        self.languages, smooth = languages, smooth or escape
        bytes_seen = np.zeros(256)
        for gram, n in grams:
            np.add.at(bytes_seen, gram & 255, n)
        frequent = np.argsort(-bytes_seen, kind="stable")[:CLASSES - 1]
        self.classes = np.full(256, CLASSES - 1, dtype=np.uint8)
        self.classes[frequent] = np.arange(CLASSES - 1)
        rest = np.zeros(CLASSES, dtype=np.float64)
        rest[CLASSES - 1] = np.log2(256 - (CLASSES - 1))

        # counts of (context, class), the context being the ORDER classes before
        counts = []
        for gram, n in grams:
            c = [self.classes[(gram >> (8 * k)) & 255].astype(np.int64) for k in range(ORDER, -1, -1)]
            key = sum(x << (SHIFT * (ORDER - k)) for k, x in enumerate(c))
            key, where = np.unique(key, return_inverse=True)
            counts.append((key, np.bincount(where, n, len(key))))
        # contexts of each order in any language; of the longest, the most frequent
        contexts = [np.zeros(1, np.int64)]
        for order in range(1, ORDER + 1):
            keys = np.concatenate([(k >> SHIFT) & ((1 << SHIFT * order) - 1) for k, _ in counts] or [contexts[0][:0]])
            seen, where = np.unique(keys, return_inverse=True)
            if len(seen) > max_contexts:
                weight = np.bincount(where, np.concatenate([n for _, n in counts]), len(seen))
                seen = np.sort(seen[np.argsort(-weight, kind="stable")[:max_contexts]])
            contexts.append(seen)
        first = np.cumsum([0, *map(len, contexts)])
        every = np.arange(1 << SHIFT * ORDER)
        self.node = np.zeros(len(every), dtype=np.int32)
        parents = []
        for order in range(1, ORDER + 1):
            # the node of a context that is not in the tree is that of its longest suffix in the tree
            parents.append(self.node[contexts[order] & ((1 << SHIFT * (order - 1)) - 1)])
            hit, at = _find(contexts[order], every & ((1 << SHIFT * order) - 1))
            self.node[hit] = at[hit] + first[order]
        self.costs = np.zeros((len(languages), first[-1], CLASSES), dtype=np.float32)
        for (key, n), cost in zip(counts, self.costs):
            p = np.full((1, CLASSES), 1 / CLASSES)
            below = None
            for order in range(ORDER + 1):
                table = np.zeros((len(contexts[order]), CLASSES))
                hit, at = _find(contexts[order], (key >> SHIFT) & ((1 << SHIFT * order) - 1))
                np.add.at(table, (at[hit], (key & (CLASSES - 1))[hit]), n[hit])
                lower = p if order == 0 else below[parents[order - 1]]
                p = smooth(table, np.broadcast_to(lower, table.shape))
                below = p if below is None else np.concatenate([below, p])
            cost[:] = -np.log2(below) + rest
        self.costs = self.costs.reshape(len(languages), int(first[-1]) * CLASSES)

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each text (rows) in each language (columns)."""
        data = PAD + PAD.join(texts)
        code = self.classes[np.frombuffer(data, dtype=np.uint8)].astype(np.int32)
        context = (code[:-3] << (2 * SHIFT)) | (code[1:-2] << SHIFT) | code[2:-1]
        at = (self.node[context] << SHIFT) | code[ORDER:]
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        starts = np.cumsum(sizes + ORDER) - (sizes + ORDER)
        full = np.flatnonzero(sizes)
        # a text's sum and that of the padding behind it take turns
        cuts = np.column_stack([starts[full], starts[full] + sizes[full]]).ravel()
        out = np.zeros((len(texts), len(self.languages)))
        if len(full):
            cuts = cuts[:-1] if cuts[-1] >= len(at) else cuts
            for k, cost in enumerate(self.costs):
                out[full, k] = np.add.reduceat(cost[at], cuts, dtype=np.float64)[::2]
        return out

    def judge(self, texts: list[bytes | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, its posterior probability at equal priors, and bits per byte, of each text."""
        langs, scores, rates = [UNKNOWN] * len(texts), [0.0] * len(texts), [8.0] * len(texts)
        for i, lang, low, mass in zip(*self.shortest(texts)):
            langs[i], scores[i], rates[i] = lang, 1 / mass, low / len(texts[i])
        return langs, scores, rates

    def shortest(self, texts: list[bytes | None]) -> tuple[list[int], list[str], list[float], list[float]]:
        """Of the texts with a letter: place, language of the shortest code, its bits, and the probability of all
        languages in units of that one's."""
        usable = [i for i, t in enumerate(texts) if t and has_letter(t)] if self.languages else []
        if not usable:
            return [], [], [], []
        bits = self.lengths([texts[i] for i in usable])
        best = bits.argmin(axis=1)
        low = bits[np.arange(len(best)), best]
        mass = np.exp2(np.minimum(low[:, None] - bits, 0)).sum(axis=1)
        return usable, [self.languages[b] for b in best.tolist()], low.tolist(), mass.tolist()


def _find(values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``wanted`` are in the sorted ``values``, and where."""
    at = np.searchsorted(values, wanted)
    inside = np.minimum(at, max(len(values) - 1, 0))
    return (values[inside] == wanted) if len(values) else np.zeros(len(wanted), bool), inside


def escape(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probabilities in contexts with these counts; bytes not seen share the escape by ``lower``."""
    seen = counts > 0
    total, distinct = counts.sum(axis=1, keepdims=True), seen.sum(axis=1, keepdims=True)
    unseen = np.where(seen, 0, lower)
    mass = unseen.sum(axis=1, keepdims=True)
    every = distinct == counts.shape[1]
    with np.errstate(invalid="ignore", divide="ignore"):
        p = np.where(seen, counts / (total + np.where(every, 0, distinct)), distinct / (total + distinct) * unseen / mass)
    return np.where(total > 0, p, lower)


def has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode(errors="replace")))


class Models:
    """The models of more languages than one model holds, each learned when it is its turn."""

    def __init__(self, rows: DataFrame, groups: list[list[Row]], sample: int, max_contexts: int):
        self.rows, self.groups, self.sample, self.max_contexts = rows, groups, sample, max_contexts
        self.languages = sorted(r["label"] for group in groups for r in group)

    def __iter__(self) -> Iterator[Model]:
        for group in self.groups:
            yield Model(*_gram_counts(self.rows, "doc_id", self.sample, group, self.max_contexts), self.max_contexts)


def learn(docs: DataFrame, sample: int = 2_000, max_languages: int = 64, max_contexts: int = 24_000) -> Model | Models:
    """A model of all languages, or models of groups of them, from the labelled rows whose crc32(doc_id) mod 4 is not 2.

    ``sample``: about so many rows of each language are read, chosen by a hash
    of the id; ``max_languages``: languages of a model, the most frequent ones
    in the first; ``max_contexts``: the most frequent contexts of three bytes
    that a model's trees keep.  These bound what the driver gathers and
    broadcasts at a time.
    """
    ship(docs.sparkSession)
    usable = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (crc_mod(F.col("doc_id"), 4) != 2))
    rows = usable.select("doc_id", F.col("lang").alias("label"), "text")
    sizes = _by_size(rows).collect()  # a row for each language
    groups = [sizes[i:i + max_languages] for i in range(0, len(sizes), max_languages)]
    if len(groups) > 1:
        return Models(rows, groups, sample, max_contexts)
    return Model(*_gram_counts(rows, "doc_id", sample, sizes, max_contexts), max_contexts)


def gram_counts(rows: DataFrame, key: str, sample: int, max_labels: int, max_contexts: int) \
        -> tuple[list[str], list[tuple[np.ndarray, np.ndarray]]]:
    """Labels (the most frequent), and for each the four-byte sequences of its texts with their counts.

    About ``sample`` rows of a label are read, chosen by a hash of ``key``; so
    the sequences kept (the most frequent, 12 for a context) are bounded.
    """
    return _gram_counts(rows, key, sample, _by_size(rows).limit(max_labels).collect(), max_contexts)


def _by_size(rows: DataFrame) -> DataFrame:
    return rows.groupBy("label").count().orderBy(F.desc("count"), "label")


def _gram_counts(rows: DataFrame, key: str, sample: int, sizes: list[Row], max_contexts: int) \
        -> tuple[list[str], list[tuple[np.ndarray, np.ndarray]]]:
    if not sizes:
        return [], []
    share = F.create_map(*[x for r in sizes for x in (F.lit(r["label"]), F.lit(min(1.0, sample / r["count"])))])
    chosen = rows.withColumn("share", share[F.col("label")]) \
        .filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < F.col("share") * (1 << 30))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", 4 << 20):
            labels = np.array(b.column("label").to_pylist(), dtype=object)
            texts = texts_of(b, "text")
            for label in dict.fromkeys(labels.tolist()):
                data = PAD + PAD.join(texts[i] for i in np.flatnonzero(labels == label))
                x = np.frombuffer(data, np.uint8).astype(np.int64)
                gram, n = np.unique(x[:-3] << 24 | x[1:-2] << 16 | x[2:-1] << 8 | x[3:], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([label] * len(gram), pa.string()), pa.array(gram), pa.array(n)],
                                                 ["label", "gram", "n"])

    grams = chosen.select("label", "text").mapInArrow(count, "label string, gram long, n long") \
        .groupBy("label", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("n"), "gram"))
    kept = grams.withColumn("place", rank).filter(F.col("place") <= 12 * max_contexts).select("label", "gram", "n").toArrow()
    label = np.array(kept.column("label").to_pylist(), dtype=object)
    gram, n = kept.column("gram").to_numpy(), kept.column("n").to_numpy()
    labels, parts = sorted(r["label"] for r in sizes), []
    for name in labels:
        own = np.flatnonzero(label == name)
        own = own[np.argsort(gram[own])]
        parts.append((gram[own], n[own].astype(np.float64)))
    return labels, parts


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from; those without an id are among them."""
    return F.coalesce(crc_mod(F.col(doc_id), 4) == 2, F.lit(True))


def _in_turn(docs: DataFrame, models: Models) -> tuple[DataFrame, DataFrame, str]:
    """``docs`` with a row number; lang, score and rate (bits per byte) by row number; and its name.

    Each model is learned, applied to the stored rows and dropped before the
    next; what a text costs in it is stored by row number.  Texts without a
    letter have no row among the costs.
    """
    spark, row = docs.sparkSession, fresh(docs.columns, "_row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    costs = None
    for model in models:
        shared = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in small_batches(batches, "text", 1 << 20):
                texts = texts_of(b, "text")
                at, langs, low, mass = shared.value.shortest(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(row).take(pa.array(at, pa.int64())), pa.array(langs, pa.string()), pa.array(low, pa.float64()),
                     pa.array(mass, pa.float64()), pa.array([len(texts[i]) for i in at], pa.int64())],
                    [row, "lang", "bits", "mass", "size"])

        part = rows.select(row, "text").mapInArrow(run, f"{row} long, lang string, bits double, mass double, size long")
        part = stored(part, "codes")
        shared.destroy()
        costs = part if costs is None else costs.unionAll(part)
    # equal lengths go to the first language by name; a list holds one entry for each model
    best = costs.groupBy(row).agg(F.min(F.struct("bits", "lang")).alias("best"), F.max("size").alias("size"),
                                  F.collect_list(F.struct("bits", "mass")).alias("all"))
    mass = F.aggregate("all", F.lit(0.0), lambda x, y: x + y["mass"] * F.pow(F.lit(2.0), F.col("best.bits") - y["bits"]))
    return rows, best.select(row, F.col("best.lang").alias("lang"), (1 / mass).alias("score"),
                             (F.col("best.bits") / F.col("size")).alias("rate")), row


def identify(docs: DataFrame, model: Model | Models) -> DataFrame:
    """doc_id, held_out, lang_pred, score and bits_per_byte of every row.

    Only the text is looked at.  Defined cases: a null text, or one without a
    letter, or a model that learned from no row, gives ``und`` with score 0 and
    8 bits a byte; equal code lengths go to the first language by name;
    repeated rows give repeated results; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    if isinstance(model, Models):
        rows, found, row = _in_turn(docs, model)
        return rows.select("doc_id", "held_out", row).join(found, row, "left").select(
            "doc_id", "held_out", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang_pred"),
            F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("rate", F.lit(8.0)).alias("bits_per_byte"))
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", 1 << 20):
            langs, scores, rates = shared.value.judge(texts_of(b, "text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64()), pa.array(rates, pa.float64())],
                                             ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"])

    return docs.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, bits_per_byte double")


def keep_identified(docs: DataFrame, model: Model | Models) -> DataFrame:
    """The rows whose text is in one of the model's languages: it has a letter,
    and the best language's code is shorter than the text itself (8 bits a byte)."""
    spark = docs.sparkSession
    ship(spark)
    if isinstance(model, Models):
        rows, found, row = _in_turn(docs, model)
        kept = found.filter((F.col("lang") != UNKNOWN) & (F.col("rate") < 8))
        return rows.join(kept, row, "left_semi").select(*docs.columns)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", 1 << 20):
            langs, _, rates = shared.value.judge(texts_of(b, "text"))
            yield b.filter(pa.array([lang != UNKNOWN and rate < 8 for lang, rate in zip(langs, rates)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
