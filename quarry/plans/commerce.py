"""E-commerce analytics over Orders, Order_Items, Products, Customer_List and
Order_Reviews (column names default to those tables' names).

Join semantics are kept exactly -- including fan-out: an order item joined to
an order's several reviews counts once per review -- but the fan-out is never
materialised.  Each side is first reduced on its join key to counts and exact
sums (a "weight"), the join then carries one row per key, and products of
weights rebuild what the row-level join would have summed.  A key holding a
third of all rows therefore neither multiplies rows nor lands whole in one
task: it is collapsed by map-side partial aggregation before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.numeric import lossless, round_half_up, round_ratio, total
from quarry.functions.parsing import parsed_once, to_timestamp_any
from quarry.operators.aggregates import distinct_count, distinct_totals
from quarry.operators.ranking import global_rank

PURCHASE_TS = "Order_Purchase_Timestamp"

# The customer segmentation rule.
VIP_MIN_ORDERS = 10
VIP_MIN_AVG = 500
FREQUENT_MIN_ORDERS = 5
VIP = "VIP Customer"
FREQUENT = "Frequent Customer"
REGULAR = "Regular Customer"
LATE = "Late"
ON_TIME = "On Time / Early"


def revenue(items: DataFrame, price: str = "Price", freight: str = "Freight_Value") -> tuple[Column, Column]:
    """(exact, rest) of price + freight; both null when one of the two is missing."""
    (pe, pr), (fe, fr) = (lossless(c, items.schema[c].dataType) for c in (price, freight))
    both = F.col(price).isNotNull() & F.col(freight).isNotNull()
    exact = F.when(pe.isNotNull() & fe.isNotNull(), pe + fe).otherwise(F.coalesce(pe, fe))
    rest = F.when(pr.isNotNull() & fr.isNotNull(), pr + fr).otherwise(F.coalesce(pr, fr))
    return F.when(both, exact), F.when(both, rest)


def entity_totals(orders: DataFrame, customers: DataFrame, items: DataFrame, order_id: str = "Order_ID",
                  customer_id: str = "Customer_Trx_ID", seller_id: str = "Seller_ID",
                  approx_distinct: bool = False) -> DataFrame:
    """One row (total_orders, total_customers, total_sellers); each a
    distinct count in which null counts as one value (``approx_distinct``:
    inexact, one sketch per entity instead of shuffling every key)."""
    return distinct_totals([("total_orders", orders, order_id), ("total_customers", customers, customer_id),
                            ("total_sellers", items, seller_id)], approx=approx_distinct)


def orders_by_country(orders: DataFrame, customers: DataFrame, customer_id: str = "Customer_Trx_ID",
                      country: str = "Customer_Country", order_id: str = "Order_ID",
                      approx_distinct: bool = False) -> DataFrame:
    """(country, total_orders = distinct orders), most orders first."""
    joined = orders.select(customer_id, order_id).join(customers.select(customer_id, country), customer_id)
    return (joined.groupBy(F.col(country).alias("country"))
                  .agg(distinct_count(order_id, approx_distinct).cast("bigint").alias("total_orders"))
                  .orderBy(F.col("total_orders").desc(), F.col("country").asc()))


def orders_by_year_month(orders: DataFrame, ts: str = PURCHASE_TS, order_id: str = "Order_ID") -> DataFrame:
    """(year, month, total_orders = count of order ids), year ascending,
    month descending."""
    t = to_timestamp_any(orders, ts)
    return (orders.select(F.year(t).alias("year"), F.month(t).alias("month"), order_id)
                  .groupBy("year", "month").agg(F.count(order_id).alias("total_orders"))
                  .orderBy(F.col("year").asc(), F.col("month").desc()))


def clean_scores(reviews: DataFrame, score: str = "Review_Score", out: str = "score") -> DataFrame:
    """Reviews with an integer score in 1..5 (text such as 'abc' or '4.5',
    nulls and out-of-range values are dropped)."""
    s = F.col(score).try_cast("int")
    cols = [F.col(c) for c in reviews.columns if c != out]
    return parsed_once(reviews, *cols, s.alias(out)).where(F.col(out).between(1, 5))


def review_average(reviews: DataFrame, score: str = "Review_Score") -> DataFrame:
    """One row, average_score rounded to 2 places (HALF_UP)."""
    c = clean_scores(reviews.select(score), score)
    return c.agg(round_ratio(F.sum("score").cast("decimal(20,0)"), None, F.count("score")).alias("average_score"))


def review_distribution(reviews: DataFrame, score: str = "Review_Score") -> DataFrame:
    """(score, total_reviews) for scores 1..5 present, ascending."""
    return (clean_scores(reviews.select(score), score).groupBy("score").agg(F.count(F.lit(1)).alias("total_reviews"))
                                        .orderBy("score"))


def _year_filter(orders: DataFrame, ts: str, year: int):
    """Rows of one calendar year.  On a timestamp column this is a range on the
    raw column, so it reaches the file scan as a pushed filter."""
    dtype = orders.schema[ts].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        lo = F.lit(f"{year}-01-01 00:00:00").cast(dtype)
        hi = F.lit(f"{year + 1}-01-01 00:00:00").cast(dtype)
        return (F.col(ts) >= lo) & (F.col(ts) < hi)
    return F.year(to_timestamp_any(orders, ts)) == year


def _item_categories(items: DataFrame, products: DataFrame, cols, product_id: str, category: str) -> DataFrame:
    """Items with their category: a plain equi-join of the raw sides (a
    duplicated product row multiplies, as the row-level join does), which AQE
    can split when one product is hot."""
    return items.select(*cols).join(products.select(product_id, category), product_id)


def revenue_by_category(items: DataFrame, orders: DataFrame, products: DataFrame, year: int = 2024,
                        ts: str = PURCHASE_TS, order_id: str = "Order_ID", product_id: str = "Product_ID",
                        category: str = "Product_Category_Name") -> DataFrame:
    """(category, total_revenue) of items whose order was placed in
    ``year``; revenue = price + freight, exact sum, unrounded, highest first.

    Items meet the year's raw order rows (a plain equi-join: broadcast when
    the year is small, otherwise a sort-merge join that AQE splits when one
    order is hot), are reduced to one row per product, and only then meet the
    raw product rows; a product listed twice counts twice, as at row level."""
    year_orders = orders.where(_year_filter(orders, ts, year)).select(order_id)
    exact, rest = revenue(items)
    item_rev = items.select(order_id, product_id, exact.alias("_rev"), rest.alias("_rest"))
    per_product = (item_rev.join(year_orders, order_id).groupBy(product_id)
                           .agg(F.sum("_rev").alias("_rev"), F.sum("_rest").alias("_rest")))
    return (per_product.join(products.select(product_id, category), product_id)
                       .groupBy(F.col(category).alias("category"))
                       .agg(total(F.sum("_rev"), F.sum("_rest")).alias("total_revenue"))
                       .orderBy(F.col("total_revenue").desc(), F.col("category").asc()))


def category_sales_and_score(items: DataFrame, products: DataFrame, reviews: DataFrame,
                             order_id: str = "Order_ID", item_id: str = "Order_Item_ID",
                             product_id: str = "Product_ID", category: str = "Product_Category_Name",
                             score: str = "Review_Score", dedupe_reviews: bool = False) -> DataFrame:
    """Per category: total_orders = count of item ids over items joined
    (left) to their order's valid reviews -- one count per matching review, as
    the row-level join gives -- and average_review_score (2 places).
    ``dedupe_reviews=True`` counts each item once however many reviews its
    order has (the average is unchanged).

    Items become (order, category) counts before meeting the per-order review
    sums, so neither a hot order nor a hot review set multiplies rows."""
    rev = (clean_scores(reviews.select(order_id, score), score).groupBy(order_id)
           .agg(F.sum("score").alias("_s"), F.count("score").alias("_c"), F.count(F.lit(1)).alias("_r")))
    cat_items = _item_categories(items, products, [order_id, product_id, item_id], product_id, category)
    per_order_cat = cat_items.groupBy(order_id, category).agg(
        F.count(item_id).alias("_items"), F.count(F.lit(1)).alias("_rows"))
    joined = per_order_cat.join(rev, order_id, "left")
    w = F.lit(1) if dedupe_reviews else F.coalesce(F.col("_r"), F.lit(1))
    out = joined.groupBy(F.col(category).alias("category")).agg(
        F.sum(F.col("_items") * w).alias("total_orders"),
        F.sum(F.col("_rows") * F.coalesce(F.col("_s"), F.lit(0))).alias("_s"),
        F.sum(F.col("_rows") * F.coalesce(F.col("_c"), F.lit(0))).alias("_c"))
    return (out.select("category", F.col("total_orders").cast("bigint").alias("total_orders"),
                       round_ratio(F.col("_s").cast("decimal(20,0)"), None, "_c").alias("average_review_score"))
               .orderBy(F.col("total_orders").desc(), F.col("category").asc()))


def delivery_performance(orders: DataFrame, items: DataFrame, actual: str = "Order_Delivered_Carrier_Date",
                         expected: str = "Shipping_Limit_Date", order_id: str = "Order_ID",
                         product_id: str = "Product_ID") -> DataFrame:
    """One row per delivered order item: order_id, product_id,
    actual_date, expected_date, delivery_diff_days (whole days) and
    delivery_status ('Late' when diff > 0, else -- also when a date does not
    parse -- 'On Time / Early').  Rows without an actual date are dropped
    before the join."""
    def side(name):
        return orders if name in orders.columns else items
    a_side, e_side = side(actual), side(expected)
    o = orders.where(F.col(actual).isNotNull()) if a_side is orders else orders
    it = items.where(F.col(actual).isNotNull()) if a_side is items else items
    o_cols = [order_id] + [c for c in (actual, expected) if c in orders.columns]
    i_cols = [order_id, product_id] + [c for c in (actual, expected) if c in items.columns and c not in o_cols]
    joined = o.select(*o_cols).join(it.select(*i_cols), order_id)
    a = to_timestamp_any(a_side, actual)
    e = to_timestamp_any(e_side, expected)
    diff = F.datediff(a, e)
    return joined.select(F.col(order_id).alias("order_id"), F.col(product_id).alias("product_id"),
                         a.alias("actual_date"), e.alias("expected_date"), diff.alias("delivery_diff_days"),
                         F.when(diff > 0, F.lit(LATE)).otherwise(F.lit(ON_TIME)).alias("delivery_status"))


def customer_segments(orders: DataFrame, items: DataFrame, order_id: str = "Order_ID",
                      customer_id: str = "Customer_Trx_ID", vip_min_orders: int = VIP_MIN_ORDERS,
                      vip_min_avg: float = VIP_MIN_AVG, frequent_min_orders: int = FREQUENT_MIN_ORDERS,
                      per_order: bool = False) -> DataFrame:
    """Per customer: total_orders (distinct), avg_order_value = average
    *item* value (price + freight, 2 places) and customer_group.
    ``per_order=True`` averages order totals instead (items summed per order
    first)."""
    exact, rest = revenue(items)
    valued = F.count(F.coalesce(F.col("_v").cast("double"), F.col("_r")))
    order_totals = (items.select(order_id, exact.alias("_v"), rest.alias("_r")).groupBy(order_id)
                         .agg(F.sum("_v").alias("_s"), F.sum("_r").alias("_r"), valued.alias("_c")))
    if per_order:
        order_totals = order_totals.select(order_id, "_s", "_r",
                                           F.when(F.col("_c") > 0, F.lit(1)).otherwise(F.lit(0)).alias("_c"))
    joined = orders.select(order_id, customer_id).join(order_totals, order_id)
    stats = (joined.groupBy(customer_id)
                   .agg(F.count_distinct(order_id).alias("total_orders"), F.sum("_s").alias("_s"),
                        F.sum("_r").alias("_r"), F.sum("_c").alias("_c"))
                   .select(F.col(customer_id).alias("customer_id"), "total_orders",
                           round_ratio("_s", "_r", "_c").alias("avg_order_value")))
    group = (F.when((F.col("total_orders") >= vip_min_orders) & (F.col("avg_order_value") >= vip_min_avg), VIP)
              .when(F.col("total_orders") >= frequent_min_orders, FREQUENT)
              .otherwise(REGULAR))
    return stats.withColumn("customer_group", group)


def seller_ranking(items: DataFrame, seller_id: str = "Seller_ID", order_id: str = "Order_ID",
                   with_rank: bool = False, approx_distinct: bool = False) -> DataFrame:
    """Per seller: total_revenue (2 places) and total_orders (distinct),
    by revenue then orders, both descending.  ``with_rank`` adds a ``rank``
    column (ties share a rank), computed without a single-partition window;
    the rows are then not sorted again."""
    exact, rest = revenue(items)
    out = (items.select(seller_id, order_id, exact.alias("_v"), rest.alias("_r")).groupBy(seller_id)
                .agg(round_half_up(total(F.sum("_v"), F.sum("_r"))).alias("total_revenue"),
                     distinct_count(order_id, approx_distinct).cast("bigint").alias("total_orders")))
    out = out.select(F.col(seller_id).alias("seller_id"), "total_revenue", "total_orders")
    order = [F.col("total_revenue").desc(), F.col("total_orders").desc()]
    if with_rank:
        return global_rank(out, ["total_revenue", "total_orders"], ascending=False)
    return out.orderBy(*order, F.col("seller_id").asc())
