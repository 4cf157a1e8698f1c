"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in hash order, form blocks.  With the share ``w`` of all
weights, the j-th block of a source (from 0) may not come before its release
floor(j / w) and must have come by its deadline ceil((j + 1) / w); in each slot
the released block with the earliest deadline is taken.  As the shares add up to
one, every deadline is met: at any slot each source is less than one block away
from its weight.  Releases and deadlines are taken from the weights in whole
numbers over the whole schedule, so nothing is rounded and no error adds up.

A turn depends on those before it, so one task deals them out, with a few
numbers a source in memory; it writes a row for each turn, and the documents are
joined to these.  A source that runs out starts over (a new epoch), and the
schedule ends when every block has come at least once; no document is dropped.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import fresh, ship, stored

#: documents of a block, and turns dealt out at a time
BLOCK_DOCS, FRAME = 8, 2_000
#: hash buckets a source's documents are ranked in, so that a large source is spread
BUCKETS = 4_096
_TURN = ("slot", "place", "block", "epoch")


def whole(weights: list[float]) -> list[int]:
    """Whole numbers in exactly the proportions of the weights."""
    exact = [Fraction(w) for w in weights]
    scale = math.lcm(*[x.denominator for x in exact])
    return [int(x * scale) for x in exact]


def deal(weights: list[int], need: list[int]) -> Iterator[int]:
    """The source of each slot, until every source has had as many as it needs."""
    total, missing = sum(weights), sum(n > 0 for n in need)
    had = [0] * len(weights)
    waiting = [(0, i) for i in range(len(weights))]
    ready: list[tuple[int, int]] = []
    t = 0
    while missing:
        while waiting and waiting[0][0] <= t:
            i = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(had[i] + 1) * total // weights[i]), i))
        i = heapq.heappop(ready)[1]
        yield i
        had[i] += 1
        missing -= had[i] == need[i]
        heapq.heappush(waiting, (had[i] * total // weights[i], i))
        t += 1


def schedule(docs: DataFrame, weights: dict | None = None, exponent: float = 0.7, block_docs: int = BLOCK_DOCS,
             frame: int = FRAME, source: str = "source") -> DataFrame:
    """The rows of ``docs`` with slot, place, block and epoch (long).

    ``slot`` is the block's turn, ``place`` the row's place in its block, and
    (slot, place) the mixed order.  ``weights``: target weight by source; by
    default a source's number of rows to the power ``exponent``.  ``frame``:
    turns dealt out at a time, without effect on the result.  A row comes
    once for each epoch that reaches it, always at least once.  Defined cases:
    null is a source of its own; a source without a weight, or with a weight
    that is not positive and finite, raises; sources may be any number; rows
    alike in all columns are ranked one after the other; an empty table gives
    no rows; columns that clash with the four names are replaced.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.drop(*_TURN)
    name = {x: fresh(docs.columns, f"_{x}") for x in ("source", "key", "n", "hash", "bucket", "before", "rank", "block")}
    sizes = docs.groupBy(F.col(source).alias(name["source"])).agg(F.count("*").alias(name["n"]))
    order = Window.orderBy(F.col(name["source"]).asc_nulls_first())
    sizes = stored(sizes.withColumn(name["key"], F.row_number().over(order) - 1), "sources")
    given = None
    if weights is not None:
        # one source more than there are weights is enough to see that one has none
        found = sizes.orderBy(name["key"]).limit(len(weights) + 1).collect()
        given = [weights.get(r[name["source"]], 0) for r in found]
        if not all(0 < w < math.inf for w in given):
            raise ValueError("every source needs a positive weight")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [x for b in batches for x in b.column(0).to_pylist()]
        need = [-(-x // block_docs) for x in n]
        had, rows = [0] * len(n), []

        def batch() -> pa.RecordBatch:
            key, turn, slot = zip(*rows)
            own = [need[i] for i in key]
            columns = [key, [t % o for t, o in zip(turn, own)], [t // o for t, o in zip(turn, own)], slot]
            return pa.RecordBatch.from_arrays([pa.array(key, pa.int32()), *[pa.array(c, pa.int64()) for c in columns[1:]]],
                                              [name["key"], name["block"], "epoch", "slot"])

        for t, i in enumerate(deal(whole([x ** exponent for x in n] if given is None else given), need)):
            rows.append((i, had[i], t))
            had[i] += 1
            if len(rows) == frame:
                yield batch()
                rows = []
        if rows:
            yield batch()

    # the sort by key comes in one partition, a row for each source
    turns = sizes.select(name["n"], name["key"]).repartition(1).sortWithinPartitions(name["key"]).select(name["n"]) \
        .mapInArrow(run, f"{name['key']} int, {name['block']} long, epoch long, slot long")
    turns = stored(turns, "turns")
    spot = [name["key"], name["bucket"]]
    keys = sizes.select(name["source"], name["key"])
    rows = docs.join(keys, F.col(source).eqNullSafe(F.col(name["source"]))).drop(name["source"]) \
        .withColumn(name["hash"], F.xxhash64(*docs.columns)).withColumn(name["bucket"], F.pmod(name["hash"], F.lit(BUCKETS)))
    # a row's rank in its source: rows in the buckets before, and its rank in its bucket
    below = Window.partitionBy(name["key"]).orderBy(name["bucket"]).rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy(*spot).count().select(*spot, F.coalesce(F.sum("count").over(below), F.lit(0)).alias(name["before"]))
    ranked = rows.withColumn(name["rank"], F.row_number().over(Window.partitionBy(*spot).orderBy(name["hash"])) - 1)
    ranked = ranked.join(before, spot).withColumn(name["rank"], F.col(name["rank"]) + F.col(name["before"])) \
        .withColumn(name["block"], F.expr(f"`{name['rank']}` div {int(block_docs)}")) \
        .withColumn("place", F.pmod(name["rank"], F.lit(block_docs)).cast("long"))
    return ranked.join(turns, [name["key"], name["block"]]) \
        .select(*docs.columns, "slot", "place", F.col(name["block"]).alias("block"), "epoch")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` in mixed order (range-partitioned and sorted by turn), with its own
    columns, also those that are named like the schedule's."""
    clash = {c: fresh([*docs.columns, *_TURN], c) for c in docs.columns if c.lower() in _TURN}
    ordered = schedule(docs.withColumnsRenamed(clash), **options)
    ordered = ordered.repartitionByRange("slot").sortWithinPartitions("slot", "place")
    return ordered.select(*[F.col(clash.get(c, c)).alias(c) for c in docs.columns])
