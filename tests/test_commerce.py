"""E-commerce jobs on hand-made tables; answers worked out by hand."""

import datetime as dt

import pytest

from quarry.plans import commerce as C

ORDERS = [("o1", "c1", "2024-01-05 10:00", "2024-01-10 09:00"),
          ("o2", "c1", "2024-02-10 11:30", None),
          ("o3", "c2", "2023-12-31 23:59", "2024-01-03 08:00"),
          ("o4", "c3", "2024-02-20 08:00", "bad-date"),
          ("o5", None, "2024-03-01 12:00", "2024-03-02 23:00")]
ITEMS = [("o1", 1, "p1", "s1", 100.00, 10.00, "2024-01-10 08:00"),
         ("o1", 2, "p2", "s2", 50.50, 5.25, "2024-01-09 23:00"),
         ("o2", 1, "p1", "s1", 200.00, 0.00, "2024-02-15 00:00"),
         ("o3", 1, "p3", "s1", 10.00, 1.00, "2024-01-05 00:00"),
         ("o4", 1, "p2", "s3", None, 3.00, "2024-02-25 00:00"),
         ("o5", 1, "p9", "s2", 20.00, 2.00, "garbage")]
PRODUCTS = [("p1", "toys"), ("p2", "books"), ("p3", "toys")]
CUSTOMERS = [("c1", "VN"), ("c2", "VN"), ("c3", "US"), ("c4", "FR"), (None, "JP")]
REVIEWS = [("o1", "5"), ("o1", "4"), ("o2", "0"), ("o3", "abc"), ("o3", "3"), ("o4", None), ("o5", "4.5"),
           ("o5", "6"), ("o6", "1")]


@pytest.fixture
def t(spark):
    return {
        "orders": spark.createDataFrame(ORDERS, "Order_ID string, Customer_Trx_ID string, "
                                        "Order_Purchase_Timestamp string, Order_Delivered_Carrier_Date string"),
        "items": spark.createDataFrame(ITEMS, "Order_ID string, Order_Item_ID int, Product_ID string, "
                                       "Seller_ID string, Price double, Freight_Value double, "
                                       "Shipping_Limit_Date string"),
        "products": spark.createDataFrame(PRODUCTS, "Product_ID string, Product_Category_Name string"),
        "customers": spark.createDataFrame(CUSTOMERS, "Customer_Trx_ID string, Customer_Country string"),
        "reviews": spark.createDataFrame(REVIEWS, "Order_ID string, Review_Score string"),
    }


def test_entity_totals_count_null_once(t):
    r = C.entity_totals(t["orders"], t["customers"], t["items"]).collect()
    assert [tuple(x) for x in r] == [(5, 5, 3)]


def test_orders_by_country(t):
    assert [tuple(r) for r in C.orders_by_country(t["orders"], t["customers"]).collect()] == [("VN", 3), ("US", 1)]


def test_orders_by_year_month(t):
    got = [tuple(r) for r in C.orders_by_year_month(t["orders"]).collect()]
    assert got == [(2023, 12, 1), (2024, 3, 1), (2024, 2, 2), (2024, 1, 1)]


def test_reviews(t):
    assert C.review_average(t["reviews"]).first().average_score == 3.25
    assert [tuple(r) for r in C.review_distribution(t["reviews"]).collect()] == [(1, 1), (3, 1), (4, 1), (5, 1)]


def test_revenue_by_category(t):
    got = [tuple(r) for r in C.revenue_by_category(t["items"], t["orders"], t["products"], year=2024).collect()]
    assert got == [("toys", 310.0), ("books", 55.75)]


def test_category_sales_fan_out(t):
    got = [tuple(r) for r in C.category_sales_and_score(t["items"], t["products"], t["reviews"]).collect()]
    assert got == [("toys", 4, 4.0), ("books", 3, 4.5)]


def test_delivery_performance(t):
    got = {(r.order_id, r.product_id): (r.delivery_diff_days, r.delivery_status)
           for r in C.delivery_performance(t["orders"], t["items"]).collect()}
    assert got == {("o1", "p1"): (0, "On Time / Early"), ("o1", "p2"): (1, "Late"),
                   ("o3", "p3"): (-2, "On Time / Early"), ("o4", "p2"): (None, "On Time / Early"),
                   ("o5", "p9"): (None, "On Time / Early")}
    first = C.delivery_performance(t["orders"], t["items"]).where("order_id = 'o1'").first()
    assert first.actual_date == dt.datetime(2024, 1, 10, 9, 0)


def test_customer_segments(t):
    default = {r.customer_id: tuple(r)[1:] for r in C.customer_segments(t["orders"], t["items"]).collect()}
    assert default == {"c1": (2, 121.92, "Regular Customer"), "c2": (1, 11.0, "Regular Customer"),
                       "c3": (1, None, "Regular Customer"), None: (1, 22.0, "Regular Customer")}
    low = {r.customer_id: r.customer_group for r in C.customer_segments(
        t["orders"], t["items"], vip_min_orders=2, vip_min_avg=100, frequent_min_orders=1).collect()}
    assert low == {"c1": "VIP Customer", "c2": "Frequent Customer", "c3": "Frequent Customer",
                   None: "Frequent Customer"}


def test_seller_ranking(t):
    got = [tuple(r) for r in C.seller_ranking(t["items"]).collect()]
    assert got == [("s1", 321.0, 3), ("s2", 77.75, 2), ("s3", None, 1)]


def test_options_dedupe_and_per_order(t):
    got = [tuple(r) for r in C.category_sales_and_score(t["items"], t["products"], t["reviews"],
                                                        dedupe_reviews=True).collect()]
    assert got == [("toys", 3, 4.0), ("books", 2, 4.5)]
    seg = {r.customer_id: r.avg_order_value for r in C.customer_segments(t["orders"], t["items"],
                                                                         per_order=True).collect()}
    assert seg["c1"] == round((110 + 55.75 + 200) / 2, 2) and seg["c3"] is None


def test_seller_rank_column(t):
    got = [(r.seller_id, r.rank) for r in C.seller_ranking(t["items"], with_rank=True).collect()]
    assert got == [("s1", 1), ("s2", 2), ("s3", 3)]


def test_entity_totals_approx_option(t):
    r = C.entity_totals(t["orders"], t["customers"], t["items"], approx_distinct=True).first()
    assert tuple(r) == (5, 5, 3)  # small inputs: the sketch is exact


def test_segment_boundaries_default_rule(spark):
    """4/5/10/12 orders around the 500 average; the average is rounded to 2
    places before it is compared (499.995 -> 500.00 -> VIP)."""
    orders, items = [], []

    def customer(cid, n_orders, value_cents_per_order):
        for k in range(n_orders):
            oid = f"{cid}-{k}"
            orders.append((oid, cid))
            cents = value_cents_per_order[k % len(value_cents_per_order)]
            items.append((oid, cents / 100.0, 0.0))

    customer("c4", 4, [100000])                  # 4 orders, avg 1000 -> Regular
    customer("c5", 5, [10])                      # 5 orders -> Frequent
    customer("c10", 10, [50000])                 # 10 orders, avg 500.00 -> VIP
    customer("c10b", 10, [49999])                # 10 orders, avg 499.99 -> Frequent
    customer("c12", 12, [49999, 50000])          # avg 499.995 -> rounds to 500.00 -> VIP
    o = spark.createDataFrame(orders, "Order_ID string, Customer_Trx_ID string")
    i = spark.createDataFrame(items, "Order_ID string, Price double, Freight_Value double")
    got = {r.customer_id: (r.total_orders, r.avg_order_value, r.customer_group)
           for r in C.customer_segments(o, i).collect()}
    assert got == {"c4": (4, 1000.0, "Regular Customer"), "c5": (5, 0.1, "Frequent Customer"),
                   "c10": (10, 500.0, "VIP Customer"), "c10b": (10, 499.99, "Frequent Customer"),
                   "c12": (12, 500.0, "VIP Customer")}
