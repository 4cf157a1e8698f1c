"""Prefix trie of rebuilt conversations by composable fingerprints.

A turn is referred to by a 128-bit hash of its role and text.  A sequence of turns
x1 .. xn has the fingerprint x1 + B x2 + ... + B^(n-1) xn in four prime fields at
once.  Fingerprints form a monoid under H(uv) = H(u) + B^|u| H(v), so the
fingerprint of "the first turns of one conversation, then the later turns of
another" follows from running sums over the original turns: the head's product
and the difference of two sums of the tail.  A rebuilt text is never written; a
rebuilt conversation is one narrow row for each of its depths.

Rows with equal fingerprints form the nodes of the trie.  Fingerprints are not
trusted: a node's rows must agree in the node before and in the reference of
their last turn, and rows under one reference must agree in role and text; by
induction on the depth a node then is one sequence.  Should any disagree, all is
done again with other bases.

Sums over subtrees need no walk: a node belongs to its smallest member, so each
conversation owns one stretch of its own path, and what hangs below a node is the
whole stretches of its other members and the rest of its owner's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quarry.llm.common import SPACE_WORD, ship, stored
from quarry.operators.running import block_size, numbered, running

#: the largest prime below 2^31: products of two residues fit in a long
PRIME = (1 << 31) - 1
LANES = range(4)
#: ids of one piece of a node's list of ends
PIECE = 1 << 16
#: characters of a text that order turns with equal numbers and roles
TIE = 32


def bases(attempt: int = 0) -> list[int]:
    """The four bases."""
    return [int(x) for x in np.random.default_rng(attempt + 12).integers(1 << 16, PRIME - 1, len(LANES))]


def power(base: int, exponent: np.ndarray) -> np.ndarray:
    """base^exponent in the field; negative exponents mean inverses."""
    left = np.mod(exponent.astype(np.int64), PRIME - 1).astype(np.uint64)
    out, square, prime = np.ones(len(left), np.uint64), np.uint64(base), np.uint64(PRIME)
    while left.any():
        out = np.where(left & np.uint64(1), out * square % prime, out)
        square, left = square * square % prime, left >> np.uint64(1)
    return out


def lane_values(e1: np.ndarray, e2: np.ndarray) -> list[np.ndarray]:
    """A turn's reference as one residue, never zero, for each field."""
    halves = [x.view(np.uint64) >> np.uint64(32 * s) & np.uint64(2**32 - 1) for x in (e1, e2) for s in (1, 0)]
    return [h % np.uint64(PRIME - 1) + np.uint64(1) for h in halves]


def combine(head: tuple[int, list[int]], tail: tuple[int, list[int]], attempt: int = 0) -> tuple[int, list[int]]:
    """The fingerprint (length, values) of a sequence from those of its two parts."""
    return head[0] + tail[0], [(h + pow(b, head[0], PRIME) * t) % PRIME for h, t, b in zip(head[1], tail[1], bases(attempt))]


def _turns(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))


def _reference(attempt: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * attempt + s), F.col("role"), F.col("text")).alias(f"e{s + 1}") for s in (0, 1)]


def _summed(turns: DataFrame, attempt: int) -> DataFrame:
    """conv_id, pos, e1, e2, words, at of every original turn, and for each lane v (its term) and s (the sum with it)."""
    words = F.regexp_count("text", F.lit(SPACE_WORD)).cast("long").alias("words")
    narrow = turns.select("conv_id", "turn", *_reference(attempt), words, "role", F.substring("text", 1, TIE).alias("front"))
    rows = numbered(narrow, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("front"), F.col("e1"), F.col("e2")],
                    "at").drop("turn", "role", "front")

    fields = bases(attempt)

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.asarray(b.column("at"))
            values = lane_values(np.asarray(b.column("e1")), np.asarray(b.column("e2")))
            lanes = [pa.array((v * power(base, at) % np.uint64(PRIME)).astype(np.int64)) for v, base in zip(values, fields)]
            yield pa.RecordBatch.from_arrays([*b.columns, *lanes], [*b.schema.names, *[f"v{i}" for i in LANES]])

    block = block_size(rows)
    kinds = ", ".join(f"{c} long" for c in (*rows.columns, *[f"v{i}" for i in LANES]))
    rows = rows.mapInArrow(terms, kinds)
    sums = running(rows, ["conv_id"], [], {**{f"s{i}": F.col(f"v{i}") for i in LANES}, "pos": F.lit(1)}, block=block, at="at")
    return sums.withColumns({"pos": F.col("pos") - 1, **{f"s{i}": F.col(f"s{i}") % PRIME for i in LANES}})


def _plans(turns: DataFrame, group: int, heads: int, attempt: int) -> DataFrame:
    """For each conversation: n, h and k (turns of its own that go, and of the base's that come), the base's first turns,
    and for each lane f, o and z: the fingerprint of k turns of the base is z, of own turns after h up to sum s (s - o) f + z."""
    head = F.when(F.col("pos") < heads - 1, F.struct("pos", "e1", "e2", "words", *[f"s{i}" for i in LANES]))
    convs = stored(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("start"),
                                                F.sort_array(F.collect_list(head)).alias("head")), "conversations")
    base = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), F.col("start").alias("base_start"),
                        F.col("head").alias("base_head"))
    own = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % group) \
        .withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads)
    both = own.join(base, "base", "left").withColumn("k", F.least(F.col("h"), F.coalesce("base_n", F.lit(0))).cast("long"))

    def reached(of: str, count: str, lane: int) -> Column:
        """A head's sum after ``count`` turns (0: none)."""
        return F.coalesce(F.get(F.col(of), (F.col(count) - 1).cast("int"))[f"s{lane}"], F.lit(0)).alias(f"{of}{lane}")

    both = both.select("conv_id", "n", "h", "k", "start", F.coalesce("base_start", F.lit(0)).cast("long").alias("base_start"),
                       F.slice(F.coalesce("base_head", F.array().cast(convs.schema["head"].dataType)), 1, F.col("k").cast("int")).alias("base_head"),
                       *[reached("head", "h", i) for i in LANES])

    fields = bases(attempt)

    def factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            get = lambda c: np.asarray(b.column(c))
            own = get("k") - get("start") - get("h")
            lanes = [pa.array(power(base, x).astype(np.int64)) for x in (own, -get("base_start")) for base in fields]
            yield pa.RecordBatch.from_arrays([*b.columns, *lanes], [*b.schema.names, *[f"f{i}" for i in LANES], *[f"g{i}" for i in LANES]])

    added = [StructField(f"{x}{i}", LongType()) for x in "fg" for i in LANES]
    return stored(both.mapInArrow(factors, StructType([*both.schema.fields, *added])), "plans")


def _lanes(values: list[Column], names: tuple[str, str]) -> list[Column]:
    """Four residues as two numbers."""
    return [F.shiftleft(values[0], 31).bitwiseOR(values[1]).alias(names[0]), F.shiftleft(values[2], 31).bitwiseOR(values[3]).alias(names[1])]


def _steps(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, d, fa, fb (fingerprint of the first d rebuilt turns), pa, pb (of one turn fewer), e1, e2, words (last turn), last."""
    zero = F.lit(0).cast("long")
    depth = F.col("k") + F.greatest(F.col("n") - F.col("h"), zero)
    roots = plans.select("conv_id", zero.alias("d"), *[zero.alias(c) for c in ("fa", "fb", "pa", "pb", "e1", "e2", "words")],
                         (depth == 0).alias("last"))
    heads = plans.select("conv_id", "n", "h", "k", "base_head", *[f"g{i}" for i in LANES], F.posexplode("base_head").alias("i", "turn"))
    here = [F.col("turn")[f"s{i}"] * F.col(f"g{i}") % PRIME for i in LANES]
    before = [F.coalesce(F.get("base_head", F.col("i") - 1)[f"s{i}"], zero) * F.col(f"g{i}") % PRIME for i in LANES]
    heads = heads.select("conv_id", (F.col("i") + 1).cast("long").alias("d"), *_lanes(here, ("fa", "fb")), *_lanes(before, ("pa", "pb")),
                         "turn.e1", "turn.e2", "turn.words", (depth == F.col("i") + 1).alias("last"))
    # the base's product after k turns
    z = [F.coalesce(F.get("base_head", (F.col("k") - 1).cast("int"))[f"s{i}"], zero) * F.col(f"g{i}") % PRIME for i in LANES]
    narrow = plans.where("n > h").select("conv_id", "n", "h", "k", *[F.col(f"head{i}").alias(f"o{i}") for i in LANES],
                                         *[f"f{i}" for i in LANES], *[c.alias(f"z{i}") for i, c in enumerate(z)])
    own = turns.join(narrow, "conv_id").where("pos >= h")
    tail = lambda s, i: (F.pmod(s - F.col(f"o{i}"), F.lit(PRIME)) * F.col(f"f{i}") + F.col(f"z{i}")) % PRIME
    d = F.col("k") + F.col("pos") - F.col("h") + 1
    own = own.select("conv_id", d.alias("d"), *_lanes([tail(F.col(f"s{i}"), i) for i in LANES], ("fa", "fb")),
                     *_lanes([tail(F.col(f"s{i}") - F.col(f"v{i}"), i) for i in LANES], ("pa", "pb")),
                     "e1", "e2", "words", (depth == d).alias("last"))
    return roots.unionByName(heads).unionByName(own)


def _digests(steps: DataFrame, key: list[str]) -> DataFrame:
    """SHA-256 of the ids that end in each node.  Sorted pieces of bounded size are made first; a node's digest reads them in a row."""
    ends = steps.where("last").groupBy(*key, F.floor(F.col("conv_id") / PIECE).alias("piece")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for b in batches:
            done, out = [], []
            for *node, ids in zip(*(b.column(c).to_pylist() for c in (*key, "ids"))):
                if node == current:
                    state.update(b",")
                else:
                    if current is not None:
                        done.append(current), out.append(state.hexdigest())
                    current, state = node, hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in zip(*done)], pa.array(out)], [*key, "ends_sha256"])
        if current is not None:
            yield pa.RecordBatch.from_arrays([*[pa.array([c], pa.int64()) for c in current], pa.array([state.hexdigest()])], [*key, "ends_sha256"])

    return ends.repartition(*key).sortWithinPartitions(*key, "piece").mapInArrow(
        digest, ", ".join(f"{c} long" for c in key) + ", ends_sha256 string")


def prefix_trie(conversations: DataFrame, group: int = 20, heads: int = 4, attempts: int = 3) -> DataFrame:
    """One row for each distinct beginning of the rebuilt conversations: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversation c begins with the first h = crc32(c as text) mod ``heads`` turns
    of conversation c - c % ``group``, then has its own turns after its first h.
    Turns stand in the order of their numbers, null first; equal numbers in that
    of role, text (its first 32 characters), then hash.  Defined cases: a null
    role or text is empty; rows without conv_id take no part; repeated rows are
    turns of their own; a conversation left without turns is a member of the root
    only; an empty table has no root and gives no rows; other columns are not read.
    """
    ship(conversations.sparkSession)
    turns = _turns(conversations)
    key = ["d", "fa", "fb"]
    for attempt in range(attempts):
        texts = turns.select(*_reference(attempt), F.struct("role", "text").alias("whole")).groupBy("e1", "e2").agg(
            (F.min("whole") != F.max("whole")).alias("differ")).where("differ")
        summed = stored(_summed(turns, attempt), "turns")
        steps = stored(_steps(summed, _plans(summed, group, heads, attempt)), "steps")
        agree = [c for c in ("pa", "pb", "e1", "e2")]
        nodes = steps.groupBy(*key).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("words").alias("words"),
                                        *[F.min(c).alias(c) for c in agree], *[F.max(c).alias(f"{c}_") for c in agree])
        nodes = stored(nodes, "nodes")
        mixed = nodes.where(" or ".join(f"{c} <> {c}_" for c in agree)).drop(*[f"{c}_" for c in agree])
        if mixed.isEmpty() and texts.isEmpty():
            break
    else:
        raise RuntimeError("sequences with equal fingerprints in every attempt")
    nodes = nodes.drop(*[f"{c}_" for c in agree], "e1", "e2")
    parents = nodes.select((F.col("d") + 1).alias("d"), F.col("fa").alias("pa"), F.col("fb").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    children = nodes.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("pa").alias("fa"), F.col("pb").alias("fb")) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(parents, ["d", "pa", "pb"], "left").join(children, key, "left").select(
        *key, "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    nodes = stored(nodes, "nodes")
    # what a conversation's own stretch holds, and of it what lies at a node or deeper
    owned = nodes.groupBy("conv_id").agg(F.sum("leaf").alias("own_leaf"), F.sum("saved").alias("own_saved"))
    deeper = running(nodes, ["conv_id"], [F.col("d").desc()], {"deep_leaf": F.col("leaf"), "deep_saved": F.col("saved")})
    below = steps.select("conv_id", *key).join(owned, "conv_id").groupBy(*key).agg(
        F.sum("own_leaf").alias("all_leaf"), F.sum("own_saved").alias("all_saved"))
    out = deeper.join(below, key).join(owned, "conv_id").join(_digests(steps, key), key, "left")
    return out.select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        (F.col("all_leaf") - F.col("own_leaf") + F.col("deep_leaf")).alias("n_leaves"),
        (F.col("all_saved") - F.col("own_saved") + F.col("deep_saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


#: the same in DuckDB SQL.  CRC32 is worked out bit by bit: a byte is xored in, -1 stands for a shift.
ORACLE = r"""
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS txt FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({'r': role, 't': txt} ORDER BY turn NULLS FIRST, role, txt) AS l FROM t GROUP BY c),
p AS (SELECT c, l, xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(c::varchar, ''),
        lambda x: [ord(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384::bigint * (a & 1)) END), 4294967295::bigint) % 4 AS h FROM own),
re AS (SELECT p.c, list_concat(coalesce(b.l[1 : p.h], []), p.l[p.h + 1 :]) AS l FROM p LEFT JOIN own b ON b.c = p.c - p.c % 20),
s AS (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM re),
steps AS (SELECT c, d, l[1 : d] AS k, CASE WHEN d > 0 THEN l[1 : d - 1] END AS up, d = len(l) AS fin,
                 CASE WHEN d > 0 THEN len(regexp_extract_all(l[d].t, '[^\x20\x09-\x0D]+')) ELSE 0 END AS w FROM s),
nodes AS (SELECT d, k, any_value(up) AS up, count(*) AS n, min(c) AS conv_id, any_value(w) AS w,
                 coalesce(string_agg(c::varchar, ',' ORDER BY c) FILTER (fin), '') AS ends FROM steps GROUP BY d, k),
kids AS (SELECT up AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY up),
val AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (k)),
sub AS (SELECT a.k, sum((v.n_children = 0)::int) AS n_leaves, sum((v.n - 1) * v.w) AS saved
        FROM val v JOIN steps a ON a.c = v.conv_id AND a.d <= v.d GROUP BY a.k)
SELECT v.conv_id, v.d::bigint AS depth, u.conv_id AS parent_conv_id, v.n AS n_convs, v.n_children, sub.n_leaves::bigint AS n_leaves,
       sub.saved::bigint AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM val v JOIN sub ON sub.k = v.k LEFT JOIN nodes u ON u.k = v.up"""
