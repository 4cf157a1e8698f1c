"""Registered queries of the operators for time, order and summaries: as-of and interval
joins, running totals, row frames, exact quantiles, cubes and kept statistics, with their
SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import summaries
from quarry.operators.asof import as_of_join
from quarry.operators.cube import cube_sets, grouped_sets, rollup_sets
from quarry.operators.intervals import overlap_join
from quarry.operators.quantiles import exact_quantiles
from quarry.operators.running import row_frames, running
from quarry.operators.similar import similar_strings
from quarry.plans.catalog import register
from quarry.session import checkpoint_dir
from quarry.sources.tables import table


@register("q_purchase_as_of_event", """
WITH p AS (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'purchase' AND ts IS NOT NULL AND user_id IS NOT NULL GROUP BY 1, 2)
SELECT e.event_id, e.user_id, e.ts, p.value AS last_value, p.ts AS last_ts
FROM (SELECT event_id, user_id, ts FROM events WHERE event_type <> 'purchase') e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts >= p.ts
""")
def q_purchase_as_of_event(spark: SparkSession, d: str) -> DataFrame:
    """Each other event with its user's last purchase at or before it."""
    e = table(spark, d, "events")
    bought = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("bought"), F.col("value").alias("last_value"))
    return as_of_join(e.where("event_type <> 'purchase'").select("event_id", "user_id", "ts"), bought, ["user_id"], "ts", "bought",
                      ["last_value"], out_time="last_ts")


@register("q_price_as_of_order", """
WITH q AS (SELECT l_partkey, l_shipdate, max(l_extendedprice / l_quantity) AS price FROM lineitem
           WHERE l_shipdate IS NOT NULL AND l_partkey IS NOT NULL GROUP BY 1, 2),
a AS (SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT a.*, q.price, q.l_shipdate AS priced_at FROM a ASOF LEFT JOIN q ON a.l_partkey = q.l_partkey AND a.o_orderdate >= q.l_shipdate
""")
def q_price_as_of_order(spark: SparkSession, d: str) -> DataFrame:
    """Each order line with the unit price at which its part was last shipped up to the day of the order.

    Of several prices of a part on a day, the as-of join takes the largest.  Parts with many lines are found in the lines,
    without joining them twice; many rows of one order are not seen there, and would only slow down its parts.
    """
    lines = table(spark, d, "lineitem")
    prices = lines.select("l_partkey", "l_shipdate", F.try_divide("l_extendedprice", "l_quantity").alias("price"))
    asked = lines.select("l_orderkey", "l_linenumber", "l_partkey").join(
        table(spark, d, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    return as_of_join(asked, prices, ["l_partkey"], "o_orderdate", "l_shipdate", ["price"], out_time="priced_at", sizes=lines)


def _cents(price: str) -> Column:
    return F.round(F.col(price) * 100).cast("long").alias("cents")


_CENTS_SQL = "cast(round(l_extendedprice * 100) AS bigint)"


@register("q_running_revenue", f"""
WITH l AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate, {_CENTS_SQL} AS cents FROM lineitem),
o AS (SELECT *, row_number() OVER (ORDER BY l_shipdate NULLS FIRST, l_orderkey, l_linenumber, l_suppkey, cents) AS place FROM l)
SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate, cents, place, cast(sum(cents) OVER (ORDER BY place) AS bigint) AS revenue FROM o
""")
def q_running_revenue(spark: SparkSession, d: str) -> DataFrame:
    """Revenue up to and with each line, over the whole table in the order of shipment."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", _cents("l_extendedprice"))
    order = [F.col("l_shipdate").asc_nulls_first(), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey"), F.col("cents")]
    return running(lines, [], order, {"place": F.lit(1), "revenue": F.col("cents")})


@register("q_priority_running_totals", """
WITH o AS (SELECT o_orderkey, o_orderpriority, o_orderdate, cast(round(o_totalprice * 100) AS bigint) AS cents FROM orders)
SELECT o_orderkey, o_orderpriority, o_orderdate,
       cast(sum(cents) OVER w AS bigint) AS revenue, count(*) OVER w AS n,
       last_value(CASE WHEN cents > 20000000 THEN o_orderkey END IGNORE NULLS) OVER w AS last_large
FROM o WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)
""")
def q_priority_running_totals(spark: SparkSession, d: str) -> DataFrame:
    """Per priority (five large groups): running revenue and count, and the last large order so far."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", _cents("o_totalprice"))
    out = running(orders, ["o_orderpriority"], [F.col("o_orderdate"), F.col("o_orderkey")], {"revenue": F.col("cents"), "n": F.lit(1)},
                  {"last_large": F.when(F.col("cents") > 20_000_000, F.col("o_orderkey"))})
    return out.drop("cents")


@register("q_order_neighbours", """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate, cast(round(o_totalprice * 100) AS bigint) AS cents FROM orders)
SELECT o_orderkey, o_custkey, o_orderdate,
       lag(o_orderdate) OVER w AS previous_date, lead(o_orderkey) OVER w AS next_order,
       cast(sum(cents) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS bigint) AS last_three
FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def q_order_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Per customer: the day of the order before, the next order, and the sum of the last three."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", _cents("o_totalprice"))
    out = row_frames(orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")],
                     {"previous_date": (F.max("o_orderdate"), -1, -1), "next_order": (F.max("o_orderkey"), 1, 1),
                      "last_three": (F.sum("cents"), -2, 0)})
    return out.drop("cents")


_SHARES = {"tenth": 0.1, "median": 0.5, "ninety": 0.9, "most": 0.99}


@register("q_price_quantiles", f"""
SELECT l_returnflag, {', '.join(f'quantile_disc(l_extendedprice, {q}) AS {n}' for n, q in _SHARES.items())} FROM lineitem GROUP BY l_returnflag
""")
def q_price_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Exact price quantiles of three groups with a third of the lines each."""
    return exact_quantiles(table(spark, d, "lineitem").select("l_returnflag", "l_extendedprice"), ["l_returnflag"], "l_extendedprice", _SHARES)


@register("q_part_quantity_quantiles", f"""
SELECT l_partkey, {', '.join(f'quantile_disc(l_quantity, {q}) AS {n}' for n, q in _SHARES.items())} FROM lineitem GROUP BY l_partkey
""")
def q_part_quantity_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Exact quantity quantiles of many small groups."""
    return exact_quantiles(table(spark, d, "lineitem").select("l_partkey", "l_quantity"), ["l_partkey"], "l_quantity", _SHARES)


@register("q_deliveries_in_promotions", f"""
WITH promo AS (SELECT p_partkey AS promo_id, p_brand AS brand, TIMESTAMP '1995-01-01' + to_days(cast(p_partkey % 2000 AS integer)) AS starts,
                      TIMESTAMP '1995-01-01' + to_days(cast(p_partkey % 2000 + p_size AS integer)) AS ends FROM part),
line AS (SELECT p_brand AS brand, l_shipdate AS starts, l_shipdate + to_days(l_linenumber) AS ends, {_CENTS_SQL} AS cents
         FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT promo_id, promo.brand, count(*) AS n_lines, cast(sum(cents) AS bigint) AS cents
FROM promo JOIN line ON promo.brand = line.brand AND line.starts < promo.ends AND promo.starts < line.ends GROUP BY 1, 2
""")
def q_deliveries_in_promotions(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries (some days from shipment on) against promotion periods of the same brand (one per part, as long as its size).

    Promotions start and end at midnight, so a delivery meets those that the whole days it touches meet.  Deliveries on
    the same days are summed before the join: a promotion meets no more of them than its days allow, however many lines
    there are.
    """
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    first = F.lit("1995-01-01").cast("timestamp_ntz")
    day = lambda c: F.make_dt_interval(c.cast("int"))
    offset = F.col("p_partkey") % 2000
    promo = part.select(F.col("p_partkey").alias("promo_id"), F.col("p_brand").alias("brand"), (first + day(offset)).alias("starts"),
                        (first + day(offset + F.col("p_size"))).alias("ends"))
    lines = table(spark, d, "lineitem").select("l_partkey", "l_shipdate", "l_linenumber", _cents("l_extendedprice")).join(
        part.select("p_partkey", F.col("p_brand").alias("brand")), F.col("l_partkey") == F.col("p_partkey"))
    lines = lines.select("brand", F.col("l_shipdate").cast("timestamp_ntz").alias("starts"),
                         (F.col("l_shipdate").cast("timestamp_ntz") + day(F.col("l_linenumber"))).alias("ends"), "cents")
    midnight = lambda c: F.col(c).cast("date").cast("timestamp_ntz")
    # an empty period meets nothing, and must not become a day
    days = lines.where("starts < ends").groupBy("brand", midnight("starts").alias("starts"), F.when(
        F.col("ends") == midnight("ends"), F.col("ends")).otherwise(midnight("ends") + day(F.lit(1))).alias("ends")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))
    pairs = overlap_join(promo, days, ("starts", "ends"), ("starts", "ends"), ["brand"])
    return pairs.groupBy(F.col("left.promo_id").alias("promo_id"), F.col("left.brand").alias("brand")).agg(
        F.sum("right.n").alias("n_lines"), F.sum("right.cents").alias("cents"))


@register("q_sales_cube", f"""
WITH l AS (SELECT l_returnflag, l_linestatus, year(l_shipdate) AS year, l_suppkey, {_CENTS_SQL} AS cents FROM lineitem)
SELECT l_returnflag, l_linestatus, cast(year AS integer) AS year, cast(grouping_id(l_returnflag, l_linestatus, year) AS integer) AS grouping_id,
       cast(sum(cents) AS bigint) AS cents, count(*) AS n_lines, count(DISTINCT l_suppkey) AS n_suppliers
FROM l GROUP BY CUBE (l_returnflag, l_linestatus, year)
""")
def q_sales_cube(spark: SparkSession, d: str) -> DataFrame:
    """Revenue, lines and distinct suppliers for every combination of return flag, status and year of shipment."""
    lines = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", F.year("l_shipdate").alias("year"), "l_suppkey",
                                               _cents("l_extendedprice"))
    dims = ["l_returnflag", "l_linestatus", "year"]
    return grouped_sets(lines, dims, cube_sets(dims), {"cents": F.col("cents"), "n_lines": F.lit(1)}, "l_suppkey", "n_suppliers")


@register("q_order_rollup", """
SELECT year(o_orderdate)::integer AS year, month(o_orderdate)::integer AS month, o_orderpriority,
       cast(grouping_id(year(o_orderdate), month(o_orderdate), o_orderpriority) AS integer) AS grouping_id,
       count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers
FROM orders GROUP BY ROLLUP (year(o_orderdate), month(o_orderdate), o_orderpriority)
""")
def q_order_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Orders and distinct customers by year, month and priority, with all subtotals."""
    orders = table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_orderpriority", "o_custkey")
    dims = ["year", "month", "o_orderpriority"]
    return grouped_sets(orders, dims, rollup_sets(dims), {"n_orders": F.lit(1)}, "o_custkey", "n_customers")


@register("q_event_stats_by_week", """
WITH e AS (SELECT date_trunc('week', ts)::date AS week, event_type, cast(value AS decimal(18,2)) AS v FROM events),
s AS (SELECT week, event_type, count(v) AS n, sum(v) AS total, cast(sum(v) AS double) AS t, cast(sum(v * v) AS double) AS q, min(v) AS low, max(v) AS high
      FROM e GROUP BY 1, 2)
SELECT week, event_type, n, t AS total, t / n AS mean,
       CASE WHEN n > 1 THEN sqrt(greatest((q - t * t / n) / (n - 1), 0)) END AS stddev, cast(low AS double) AS low, cast(high AS double) AS high FROM s
""")
def q_event_stats_by_week(spark: SparkSession, d: str) -> DataFrame:
    """Weekly statistics merged from daily states that were stored before."""
    store = f"{checkpoint_dir(spark).rstrip('/')}/event-states-{uuid.uuid4().hex}"
    summaries.refresh(spark, f"{d}/events.parquet", store,
                      lambda e: summaries.summarise(e.select(F.to_date("ts").alias("day"), "event_type", "value", "user_id"), ["day", "event_type"],
                                                    "value", "user_id"), ["day", "event_type"])
    weekly = summaries.merge(summaries.states(spark, store), [F.to_date(F.date_trunc("week", "day")).alias("week"), "event_type"])
    out = summaries.finished(weekly).drop("approx_distinct")
    return out.withColumns({c: F.col(c).cast("double") for c in ("total", "low", "high")})


@register("q_similar_names", """
WITH n AS (SELECT DISTINCT c_name AS s FROM customer WHERE c_name IS NOT NULL)
SELECT a.s AS "left", b.s AS "right", levenshtein(a.s, b.s)::integer AS distance FROM n a JOIN n b ON levenshtein(a.s, b.s) <= 1
""")
def q_similar_names(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of customer names that differ by one edit at most."""
    names = table(spark, d, "customer").select("c_name")
    return similar_strings(names, names, "c_name", "c_name", 1)
