"""Skew check: one key holding a third of all rows must not land whole in one
task.  Builds skewed inputs from the sf tables (a third of the rows re-keyed to
one hot key), runs the analytics with broadcast joins disabled (the plans a
cluster-sized input gets), and reads Spark's event log: for every shuffle-
reading stage, the largest task's share of the records read.

Usage: python tools/skew_check.py [sf_dir] [part of a name]   (checkpoints and log: temp folders of this local session)
"""

from __future__ import annotations

import glob
import json
import sys
import tempfile
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from quarry.plans import commerce as C  # noqa: E402
from quarry.operators.asof import as_of_join  # noqa: E402
from quarry.operators.cube import cube_sets, grouped_sets  # noqa: E402
from quarry.operators.intervals import overlap_join  # noqa: E402
from quarry.operators.quantiles import exact_quantiles  # noqa: E402
from quarry.operators.ranking import global_rank  # noqa: E402
from quarry.operators.running import row_frames, running  # noqa: E402
from quarry.plans import reviews as V  # noqa: E402
from quarry.plans import ratings as R  # noqa: E402
from quarry.session import build_session  # noqa: E402


def hot(col, key):
    """A third of the rows (by a hash of the row) get the hot key."""
    return F.when(F.abs(F.xxhash64(F.monotonically_increasing_id())) % 3 == 0, F.lit(key)).otherwise(F.col(col))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="quarry-eventlog-")
    spark = build_session(master="local[8]", shuffle_partitions=16, app="quarry-skew", extra={
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="quarry-checkpoints-"),
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir, "spark.eventLog.compress": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"})

    def load(name):
        # the test tables are single row groups; a cluster input arrives in
        # many splits, which is what lets AQE split a skewed partition by map
        # ranges -- simulate that with 32 input splits
        return spark.read.parquet(f"{sf}/{name}.parquet").repartition(32)

    li, part, ev, cust, orders = (load(n) for n in ("lineitem", "part", "events", "customer", "orders"))
    docs, labels = load("documents"), load("labels")

    ratings = li.select(hot("l_partkey", 1).alias("item_id"), F.col("l_quantity").alias("rating"))
    items = part.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))
    ev_hot = ev.select(hot("user_id", 0).alias("user_id"), F.col("event_type").alias("item_id"),
                       F.col("value").alias("rating"))
    users = cust.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    supplied_user = li.select(hot("l_suppkey", 1).alias("user_id"), F.col("l_partkey").alias("item_id"),
                              F.col("l_quantity").alias("rating"))
    supplied_item = li.select(F.col("l_suppkey").alias("user_id"), hot("l_partkey", 1).alias("item_id"),
                              F.col("l_quantity").alias("rating"))
    suppliers = load("supplier").select(F.col("s_suppkey").alias("user_id"), "s_acctbal",
                                        F.pmod("s_nationkey", F.lit(4)).cast("string").alias("grp"))
    ec_items = li.select(hot("l_orderkey", 1).alias("Order_ID"), F.col("l_linenumber").alias("Order_Item_ID"),
                         F.col("l_partkey").alias("Product_ID"), F.col("l_suppkey").alias("Seller_ID"),
                         F.col("l_extendedprice").alias("Price"), F.col("l_tax").alias("Freight_Value"))
    # only the product is hot here: rows hot on every key at once are near-identical
    # and compress to nothing, which hides them from AQE's byte-size skew test
    ec_items_hot_product = li.select(F.col("l_orderkey").alias("Order_ID"),
                                     F.col("l_linenumber").alias("Order_Item_ID"),
                                     hot("l_partkey", 1).alias("Product_ID"))
    ec_orders = orders.select(F.col("o_orderkey").alias("Order_ID"), F.col("o_custkey").alias("Customer_Trx_ID"),
                              F.col("o_orderdate").alias("Order_Purchase_Timestamp"))
    products = part.select(F.col("p_partkey").alias("Product_ID"), F.col("p_type").alias("Product_Category_Name"))
    reviews = ev.select(hot("event_id", 1).alias("Order_ID"),
                        F.get_json_object("props", "$.k").alias("Review_Score"))

    stop = spark.range(1).select(F.explode(F.array(*[F.lit(w) for w in ("the", "of", "and")])).alias("stopword"))
    docs_hot_lang = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("comment"),
                                hot("lang", "en").alias("dim3"))
    label_rows = labels.select(hot("doc_id", 1).alias("doc_id"),
                               F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("s"))
    label_counts = label_rows.groupBy("doc_id", "s").agg(F.count(F.lit(1)).alias("n"))
    docs_labelled = docs.select("doc_id", "source").join(label_counts, "doc_id")

    jobs = {
        "global_rank (hot sort key)": lambda: global_rank(
            li.select(hot("l_partkey", 1).alias("k"), "l_orderkey"), ["k"]),
        "top_words (hot language)": lambda: V.top_words(docs_hot_lang, stop, "dim3", None, 5),
        "frequent_words (hot words)": lambda: V.frequent_words(V.clean_tokens(docs_hot_lang, stop), 500),
        "top_source_by_sentiment (hot doc labels)": lambda: V.top_value_by_sentiment(
            docs_labelled, "source", "s", "doc_id", weight="n"),
        "item_rating_stats (hot item)": lambda: R.item_rating_stats(ratings, items, item_key="item_id"),
        "item_by_two_groups (hot user)": lambda: R.item_by_two_groups(
            ev_hot, users, None, item_key="item_id", group="c_mktsegment", groups=("BUILDING", "MACHINERY"),
            names=("a", "b")),
        "item_by_two_groups titled (hot user)": lambda: R.item_by_two_groups(
            supplied_user, suppliers, items, item_key="item_id", group="grp", groups=("1", "3"), names=("a", "b")),
        "item_by_two_groups titled (hot item)": lambda: R.item_by_two_groups(
            supplied_item, suppliers, items, item_key="item_id", group="grp", groups=("1", "3"), names=("a", "b")),
        "item_by_group_long titled (hot user)": lambda: R.item_by_group_long(
            supplied_user, suppliers, items, item_key="item_id", group="grp", numeric_item=False),
        "item_by_bin_long titled (hot item)": lambda: R.item_by_bin_long(
            supplied_item, suppliers, items, item_key="item_id", value="s_acctbal", value_type="double", numeric_item=False),
        "customer_segments (hot order)": lambda: C.customer_segments(ec_orders, ec_items),
        "category_sales (hot order, hot review)": lambda: C.category_sales_and_score(ec_items, products, reviews),
        "seller_ranking (hot order)": lambda: C.seller_ranking(ec_items),
        "revenue_by_category (hot order)": lambda: C.revenue_by_category(ec_items, ec_orders, products, 1998),
        "category_sales (hot product)": lambda: C.category_sales_and_score(ec_items_hot_product, products, reviews),
        "delivery join (hot order, SMJ)": lambda: ec_orders.join(ec_items, "Order_ID").select("Order_ID", "Product_ID"),
    }
    span = lambda df, start, days: df.withColumn("starts", F.col(start)).withColumn("ends", F.col(start) + F.make_dt_interval(days))
    shipped = li.select(hot("l_partkey", 1).alias("k"), F.col("l_shipdate").alias("seen"), F.col("l_extendedprice").alias("price"))
    asked = li.select(hot("l_partkey", 1).alias("k"), F.col("l_shipdate").alias("t"), "l_orderkey")
    jobs |= {
        "as_of_join (hot key on both sides)": lambda: as_of_join(asked, shipped, ["k"], "t", "seen", ["price"]),
        "running (hot key)": lambda: running(asked, ["k"], [F.col("t")], {"n": F.lit(1)}),
        "row_frames (hot key)": lambda: row_frames(asked, ["k"], [F.col("t")], {"before": (F.max("l_orderkey"), -1, -1)}),
        "exact_quantiles (hot group)": lambda: exact_quantiles(shipped, ["k"], "price", {"median": 0.5}),
        "overlap_join (hot key)": lambda: overlap_join(
            span(li.select(hot("l_partkey", 1).alias("k"), "l_shipdate"), "l_shipdate", F.lit(1)),
            span(orders.limit(3_000).select(F.lit(1).cast("long").alias("k"), "o_orderdate"), "o_orderdate", F.lit(2)),
            ("starts", "ends"), ("starts", "ends"), ["k"], dense=2_000),
        "grouped_sets (hot group and value)": lambda: grouped_sets(
            li.select(hot("l_partkey", 1).alias("a"), "l_returnflag", hot("l_suppkey", 1).alias("v")), ["a", "l_returnflag"],
            cube_sets(["a", "l_returnflag"]), {"n": F.lit(1)}, "v"),
    }
    marks = {}
    for name, fn in jobs.items():
        if len(sys.argv) > 2 and sys.argv[2] not in name:
            continue
        spark.sparkContext.setJobGroup(name, name)
        fn().write.format("noop").mode("overwrite").save()
        marks[name] = True
    spark.stop()

    # Parse the event log: records read per task, per stage, per job group.
    log = glob.glob(f"{logdir}/*")[0]
    files = sorted(glob.glob(f"{log}/events_*"), key=lambda f: int(f.rsplit("_", 2)[1])) if Path(log).is_dir() \
        else [log]
    lines = (ln for f in files for ln in open(f, encoding="utf-8"))
    stage_group, tasks = {}, defaultdict(list)
    for line in lines:
        e = json.loads(line)
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = group
        elif kind == "SparkListenerTaskEnd":
            m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
            n = m.get("Total Records Read", 0)
            if n:
                tasks[(e["Stage ID"], e["Stage Attempt ID"])].append(n)
    print(f"event log: {log}")
    worst = {}
    for (sid, _), reads in sorted(tasks.items()):
        g = stage_group.get(sid)
        total = sum(reads)
        share = max(reads) / total if total else 0
        if total >= 20000:
            worst[g] = max(worst.get(g, 0), share)
            print(f"  {g:42s} stage {sid:3d}: tasks={len(reads):3d} records={total:8d} "
                  f"largest task={max(reads):7d} ({share:.0%})")
    print(json.dumps({g: round(s, 3) for g, s in worst.items()}))


if __name__ == "__main__":
    main()
