"""Bucketed order lines and orders: the order-key join and aggregation run
without shuffling either side, with the same results."""

from pyspark.sql import functions as F

from quarry.plans import commerce as C
from quarry.sources import bucketed_table, table, write_bucketed

SF = "/root/testdata/sf0.01"


def test_customer_segments_on_bucketed_tables(spark):
    li = table(spark, SF, "lineitem")
    items = li.select(F.col("l_orderkey").alias("Order_ID"), F.col("l_extendedprice").alias("Price"),
                      (F.col("l_extendedprice") * F.col("l_tax")).alias("Freight_Value"))
    orders = table(spark, SF, "orders").select(F.col("o_orderkey").alias("Order_ID"),
                                               F.col("o_custkey").alias("Customer_Trx_ID"))
    write_bucketed(items, "items_by_order", "Order_ID", 8)
    write_bucketed(orders, "orders_by_order", "Order_ID", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = C.customer_segments(bucketed_table(spark, "orders_by_order"), bucketed_table(spark, "items_by_order"))
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
        plan = result._jdf.queryExecution().explainString(mode)
        exchanges = [ln for ln in plan.splitlines() if "Exchange " in ln]
        # the per-order aggregation and the order join are shuffle-free; only the
        # final per-customer aggregation shuffles
        assert len(exchanges) == 1 and "hashpartitioning(Customer_Trx_ID" in exchanges[0]
        assert "SortMergeJoin" in plan and plan.count("Bucketed: true") == 2
        plain = C.customer_segments(orders, items)
        assert sorted(map(tuple, result.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
