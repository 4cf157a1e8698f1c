"""Shards by a k-d tree over the documents' metadata.

A node of the tree is a set of texts and a number of shards.  It is cut along the
metadata dimension in which it is widest (of source, language, size and id, each
measured by the share of the whole table's range that the node still spans), at
the weighted median: the place where the bytes before it are to the bytes after
it as the numbers of shards that the two sides are to fill.  All nodes of a level
are cut together.  The tree ends with one shard in each leaf; without a given
number of shards their number follows from the target bytes.

The medians are exact and distributed: ranks are narrowed by counting bytes in
bins (``quarry.operators.quantiles``), so no node is sorted or gathered; texts
with equal coordinates are ordered by their hash.  Copies of a text are one unit,
counted before any shuffle, and stay together; only a unit with more bytes than
``unit`` times a shard's share is dealt into parts, by id, as it could not be placed
evenly.  A cut falls before or after the unit at the median, whichever is nearer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import stored
from quarry.operators.quantiles import narrowed
from quarry.operators.running import numbered

DIMENSIONS = ("in_source", "in_lang", "in_size", "in_id")
#: copies of a text stay together up to this share of a shard; beyond it they are dealt into parts of a fifth of that
UNIT = 0.025


#: steps into which the table's range of a dimension is divided
STEPS = 1 << 30
FINISH, BINS = 1 << 16, 4096


def _prefix(text: Column) -> Column:
    """A text's first six bytes as a number: order is kept, later bytes are left to the hash."""
    raw = F.substring(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 1, 6)
    return F.conv(F.rpad(F.hex(raw), 12, "0"), 16, 10).cast("long")


def _documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, unit (text hash), and a coordinate for each dimension."""
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    column = {c.lower(): F.col(c) for c in docs.columns}
    nothing = F.lit(None).cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.xxhash64(raw).alias("unit"),
        _prefix(column.get("source", nothing)).alias("source"), _prefix(column.get("lang", nothing)).alias("lang"))


def units(rows: DataFrame, limit: int) -> DataFrame:
    """One row for each text (unit, part): its bytes, rows and coordinates.  Texts whose copies together have more than
    ``limit`` bytes have several parts, each with the copies of some ids."""
    whole = rows.groupBy("unit", "size").agg(F.count(F.lit(1)).alias("n"))
    parts = whole.where((F.col("size") * F.col("n") > limit) & (F.col("n") > 1)).select(
        "unit", "size", F.least(F.ceil(F.col("size") * F.col("n") / limit) * 5, F.col("n")).alias("parts"))
    split = rows.join(parts, ["unit", "size"], "left").withColumn(
        "part", F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("doc_id", "row"), F.col("parts"))).otherwise(F.lit(0)))
    return split.drop("parts")


def _numbers(spark: SparkSession, rows: list[tuple[int, ...]], names: str) -> DataFrame:
    """Rows of longs as a table of values."""
    values = ", ".join("(" + ", ".join(f"{x}L" for x in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def cut(nodes: DataFrame, shards: int) -> DataFrame:
    """unit, part, size and shard of every unit; ``nodes`` has unit, part, size, bytes, tie (31 bits) and the dimensions.

    The driver holds a few numbers for each shard, never a unit.
    """
    spark = nodes.sparkSession
    whole = nodes.agg(*[F.min(d).alias(d) for d in DIMENSIONS], *[F.max(d).alias(f"{d}_hi") for d in DIMENSIONS]).first()
    # a place in the table's range, then the hash: one number that orders the units along a dimension
    for d in DIMENSIONS:
        low, high = whole[d] or 0, whole[f"{d}_hi"] or 0
        step = F.floor((F.col(d) - low).cast("double") / float(max(high - low, 1)) * (STEPS - 1))
        nodes = nodes.withColumn(d, F.shiftleft(step, 31).bitwiseOR(F.col("tie")))
    nodes = stored(nodes.withColumn("node", F.lit(0).cast("long")), "coordinates")
    leaves, level = {0: shards}, 0  # first shard of each node: number of its shards
    while max(leaves.values()) > 1:
        todo = _numbers(spark, [(k, n) for k, n in leaves.items() if n > 1], "node, fill")
        facts = nodes.join(todo, "node").groupBy("node", "fill").agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"), *[F.min(d).alias(f"{d}_lo") for d in DIMENSIONS],
            *[F.max(d).alias(f"{d}_hi") for d in DIMENSIONS]).collect()
        state, done, ways = [], {}, {}
        for f in facts:
            width = [(f[f"{d}_hi"] >> 31) - (f[f"{d}_lo"] >> 31) for d in DIMENSIONS]
            ways[f["node"]] = along = width.index(max(width))
            need = max(1, -(-f["bytes"] * (f["fill"] // 2) // f["fill"]))
            state.append((f["node"], along, need, f[f"{DIMENSIONS[along]}_lo"], f[f"{DIMENSIONS[along]}_hi"], f["n"], 0))
        place = F.element_at(F.array(*DIMENSIONS), (F.col("along") + 1).cast("int"))
        while state:
            done |= {s[0]: s[3] for s in state if s[3] == s[4] and s[0] not in done}
            state = [s for s in state if s[3] < s[4]]
            if not state:
                break
            bounds = _numbers(spark, state, "node, along, need, _lo, _hi, _n, _below").drop("_n")
            inside = nodes.select("node", "bytes", *DIMENSIONS).join(bounds, "node") \
                .withColumn("_k", place).withColumn("_w", F.col("bytes")).where(F.col("_k").between(F.col("_lo"), F.col("_hi")))
            found = narrowed(inside, ["node"], BINS, max(s[5] for s in state) <= FINISH).collect()
            # the unit at the median goes left unless the cut before it is nearer to the wanted bytes
            done |= {r["node"]: r["_lo"] - 1 for r in found if r["_lo"] == r["_hi"] and 0 < r["_below"]
                     and r["need"] - r["_below"] < r["_upto"] - r["need"]}
            state = [(r["node"], ways[r["node"]], r["need"], r["_lo"], r["_hi"], r["_n"], r["_below"]) for r in found]
        if done:
            cuts = _numbers(spark, [(k, ways[k], v, leaves[k] // 2) for k, v in done.items()], "node, along, upto, half")
            nodes = nodes.join(cuts, "node", "left").withColumn(
                "node", F.when(place > F.col("upto"), F.col("node") + F.col("half")).otherwise(F.col("node"))).drop("along", "upto", "half")
        leaves = {m: x for k, n in leaves.items() for m, x in ([(k, n // 2), (k + n // 2, n - n // 2)] if n > 1 else [(k, n)])}
        level += 1
        if level % 4 == 0:
            nodes = stored(nodes, f"level-{level}")
    return nodes.withColumnRenamed("node", "shard")


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int = 1 << 30, unit: float = UNIT) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot and grown_shard (null) of every row.

    ``shards`` shards, or else as many as the whole needs at ``target_bytes``
    each.  Slots number a shard's rows from 0, by id.  Defined cases: a null text
    is empty (size 1); null ids, sources and languages are smallest; a table
    without source or lang has one of each; repeated rows are copies, each with
    its own slot; with fewer texts than shards, some stay empty; an empty table
    gives no rows; other columns are not read.
    """
    if shards is not None and shards < 1:
        raise ValueError("at least one shard")
    # each row's own number tells repeated rows apart
    rows = stored(_documents(docs).withColumn("row", F.monotonically_increasing_id()), "sizes")
    total = rows.agg(F.sum("size")).first()[0] or 0
    shards = shards or max(1, -(-total // target_bytes))
    rows = stored(units(rows, max(1, int(total * unit / shards))), "parts")
    nodes = rows.groupBy("unit", "size", "part").agg(
        F.sum("size").alias("bytes"), F.min("source").alias("in_source"), F.min("lang").alias("in_lang"),
        F.first("size").alias("in_size"), F.coalesce(F.min("doc_id"), F.lit(-1).cast("long")).alias("in_id"))
    nodes = nodes.withColumn("tie", F.shiftrightunsigned(F.xxhash64("unit", "size", "part"), 33))
    placed = cut(nodes, shards).select("unit", "size", "part", "shard")
    out = rows.join(placed, ["unit", "size", "part"]).select("doc_id", "size", "text_crc32", "row", "shard")
    ordered = numbered(out, [F.col("shard"), F.col("doc_id").asc_nulls_first(), F.col("row")])
    first = ordered.groupBy("shard").agg(F.min("_at").alias("_first"))  # a row for each shard
    return ordered.join(first, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("_at") - F.col("_first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
