"""The registered queries: each analytic run on the parquet test tables.

The analytics are written for their original inputs (movie ratings, hotel
reviews, e-commerce orders); here each is pointed at the star-schema tables
with a fixed column mapping, documented per query.  Every query reads whole
tables; nothing is sampled or capped.  ``ORACLE_SQL`` holds, per query, the
same computation in plain SQL (DuckDB dialect) used as the correctness check.

The ``*_text`` queries exercise the line-oriented readers: Spark renders the
tables as the original comma-separated text lines (in either dialect) and the
analytics read them back through the same parsers the original files use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.joins import ORDER, lookup_inner
from quarry.operators.sets import spread, union_all
from quarry.plans import commerce as C
from quarry.plans import ratings as R
from quarry.plans import reports as P
from quarry.plans import reviews as V
from quarry.session import materialize
from quarry.sinks.text import nested_bag_text, ordered
from quarry.sources.delimited import parse_delimited
from quarry.sources.ratings_text import JAVA, PYTHON, parse_movies, parse_occupations, parse_ratings, parse_users
from quarry.sources.tables import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return wrap


# ---------------------------------------------------------------- mappings

def _line_ratings(spark, d):
    """lineitem as ratings: item = l_partkey, rating = l_quantity."""
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("item_id"), F.col("l_quantity").alias("rating"))


def _parts(spark, d):
    """part as the item dimension: title = p_name (not unique), tags = words of p_name."""
    return table(spark, d, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))


def _event_ratings(spark, d):
    """events as ratings: user = user_id, item = event_type, rating = value."""
    return table(spark, d, "events").select("user_id", F.col("event_type").alias("item_id"), F.col("value").alias("rating"))


def _customers(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment", "c_acctbal", "c_nationkey")


# ------------------------------------------------------------------ ratings

# two decimals, HALF_UP, of the true quotient of an exact sum (at most four decimals) and a count
def _round2(total: str, count: str) -> str:
    return (f"CAST((CAST({total} * 10000 AS HUGEINT) * 200 + {count} * 10000) // NULLIF({count} * 20000, 0) AS DOUBLE)"
            " / 100")


# exact mean used everywhere: decimal sum -> double, divided by the count
_AVG_QTY = "CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / COUNT(l_quantity)"


_STATS_CTE = f"""WITH s AS (
  SELECT p_name AS title, {_AVG_QTY} AS avg_rating, COUNT(l_quantity) AS n_ratings
  FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE l_quantity IS NOT NULL
  GROUP BY p_name)"""

@register("q_item_rating_stats", f"""{_STATS_CTE}
SELECT title, avg_rating, n_ratings FROM s""")
def q_item_rating_stats(spark: SparkSession, d: str) -> DataFrame:
    """item = l_partkey, title = p_name, rating = l_quantity."""
    return R.item_rating_stats(_line_ratings(spark, d), _parts(spark, d), item_key="item_id")


@register("q_best_item", f"""{_STATS_CTE}
SELECT title, avg_rating, n_ratings FROM s WHERE n_ratings >= 5
ORDER BY avg_rating DESC, title ASC LIMIT 1
""")
def q_best_item(spark, d):
    """N2 with min_count 5."""
    return R.best_item(q_item_rating_stats(spark, d), min_count=5)


# Java split of p_name on ' ' (trailing empty fields dropped), each tag Java-trimmed.
_JAVA_TAGS = ("CASE WHEN p_name <> '' AND rtrim(p_name, ' ') = '' THEN []::VARCHAR[] "
              "ELSE string_split(rtrim(p_name, ' '), ' ') END")
_JTRIM = "regexp_replace(tag, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


@register("q_tag_rating_stats", f"""
SELECT {_JTRIM} AS tag, {_AVG_QTY} AS avg_rating, COUNT(l_quantity) AS n_ratings
FROM lineitem
JOIN (SELECT p_partkey, unnest({_JAVA_TAGS}) AS tag FROM part WHERE p_name IS NOT NULL) t
  ON l_partkey = p_partkey
WHERE l_quantity IS NOT NULL
GROUP BY 1
""")
def q_tag_rating_stats(spark, d):
    """tags = words of p_name."""
    items = table(spark, d, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("tags"))
    return R.tag_rating_stats(_line_ratings(spark, d), items, item_key="item_id", tags="tags", sep=" ",
                              tag_out="tag")


_AVG_VAL = "CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value)"


def _cond_avg(label, name):
    return (f"COALESCE(CAST(SUM(CASE WHEN grp = '{label}' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE)"
            f" / NULLIF(COUNT(CASE WHEN grp = '{label}' THEN value END), 0), 0.0) AS {name}")


@register("q_item_by_two_groups", f"""
WITH j AS (
  SELECT e.event_type AS item_id, upper(c.c_mktsegment) AS grp, e.value
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
  WHERE e.value IS NOT NULL AND upper(c.c_mktsegment) IN ('BUILDING', 'MACHINERY'))
SELECT item_id, {_cond_avg('BUILDING', 'avg_building')}, {_cond_avg('MACHINERY', 'avg_machinery')}
FROM j GROUP BY item_id
""")
def q_item_by_two_groups(spark, d):
    """item = event_type, two listed groups of c_mktsegment (others ignored)."""
    return R.item_by_two_groups(_event_ratings(spark, d), _customers(spark, d), None, item_key="item_id",
                                group="c_mktsegment", groups=("BUILDING", "MACHINERY"),
                                names=("avg_building", "avg_machinery"))


# Fixed values of the account-balance bins used for the two bucketing queries.
ACCT_EDGES_RIGHT = (1000, 3000, 6000)
ACCT_LABELS_RIGHT = ("le_1000", "1000_3000", "3000_6000", "gt_6000")
ACCT_EDGES_LEFT = (0, 2000, 4000, 6000, 8000)
ACCT_LABELS_LEFT = ("<0", "0-2000", "2000-4000", "4000-6000", "6000-8000", "8000+")


@register("q_item_by_bucket", f"""
WITH j AS (
  SELECT e.event_type AS item_id, e.value,
         CASE WHEN c.c_acctbal <= 1000 THEN 'le_1000' WHEN c.c_acctbal <= 3000 THEN '1000_3000'
              WHEN c.c_acctbal <= 6000 THEN '3000_6000' WHEN c.c_acctbal IS NOT NULL THEN 'gt_6000' END AS grp
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
  WHERE e.value IS NOT NULL)
SELECT item_id, {_cond_avg('le_1000', 'avg_le_1000')}, {_cond_avg('1000_3000', 'avg_1000_3000')},
       {_cond_avg('3000_6000', 'avg_3000_6000')}, {_cond_avg('gt_6000', 'avg_gt_6000')}
FROM j WHERE grp IS NOT NULL GROUP BY item_id
""")
def q_item_by_bucket(spark, d):
    """Right-closed bins of c_acctbal (1000, 3000, 6000)."""
    return R.item_by_bucket(_event_ratings(spark, d), _customers(spark, d), None, item_key="item_id",
                            value="c_acctbal", value_type="double", edges=ACCT_EDGES_RIGHT,
                            labels=ACCT_LABELS_RIGHT, names=tuple("avg_" + x for x in ACCT_LABELS_RIGHT))


MIN_RATINGS_BY_ID = 30

_BY_ID = f"""WITH s AS (
  SELECT l_partkey AS item_id, {_AVG_QTY} AS avg_rating, COUNT(l_quantity) AS n_ratings
  FROM lineitem WHERE l_quantity IS NOT NULL
  GROUP BY l_partkey HAVING COUNT(l_quantity) >= {MIN_RATINGS_BY_ID}),
b AS (SELECT s.item_id, p.p_name AS title, s.avg_rating, s.n_ratings FROM s JOIN part p ON s.item_id = p.p_partkey)"""


@register("q_item_stats_min_ratings", f"""{_BY_ID}
SELECT item_id, title, avg_rating, n_ratings FROM b""")
def q_item_stats_min_ratings(spark, d):
    """Per l_partkey, kept when it has at least 30 line items."""
    return R.item_stats_min_ratings(_line_ratings(spark, d), _parts(spark, d), item_key="item_id",
                                    min_count=MIN_RATINGS_BY_ID)


@register("q_best_item_by_id", f"""{_BY_ID}
SELECT item_id, title, avg_rating, n_ratings FROM b ORDER BY avg_rating DESC, item_id ASC LIMIT 1""")
def q_best_item_by_id(spark, d):
    """N15."""
    return R.best_item_by_id(q_item_stats_min_ratings(spark, d), item_key="item_id")


@register("q_tag_avg_sorted", f"""
SELECT tag, {_AVG_QTY} AS avg_rating
FROM lineitem
JOIN (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS tag FROM part WHERE p_name IS NOT NULL) t
  ON l_partkey = p_partkey
WHERE l_quantity IS NOT NULL
GROUP BY tag ORDER BY avg_rating DESC, tag ASC
""")
def q_tag_avg_sorted(spark, d):
    """Python split of p_name on ' ', untrimmed."""
    items = table(spark, d, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("tags"))
    return R.tag_avg_sorted(_line_ratings(spark, d), items, item_key="item_id", tags="tags", sep=" ", tag_out="tag")


@register("q_item_by_group_long", f"""
SELECT e.event_type AS item_id, c.c_mktsegment, {_AVG_VAL} AS avg_rating
FROM events e JOIN customer c ON e.user_id = c.c_custkey
WHERE e.value IS NOT NULL
GROUP BY 1, 2 ORDER BY 1, 2
""")
def q_item_by_group_long(spark, d):
    """(event_type, c_mktsegment) long form."""
    return R.item_by_group_long(_event_ratings(spark, d), _customers(spark, d), None, item_key="item_id",
                                group="c_mktsegment", numeric_item=False)


@register("q_item_by_bin_long", f"""
SELECT e.event_type AS item_id,
       CASE WHEN c.c_acctbal < 0 THEN '<0' WHEN c.c_acctbal < 2000 THEN '0-2000'
            WHEN c.c_acctbal < 4000 THEN '2000-4000' WHEN c.c_acctbal < 6000 THEN '4000-6000'
            WHEN c.c_acctbal < 8000 THEN '6000-8000' WHEN c.c_acctbal IS NOT NULL THEN '8000+'
            ELSE 'Unknown' END AS acct_group,
       {_AVG_VAL} AS avg_rating
FROM events e JOIN customer c ON e.user_id = c.c_custkey
WHERE e.value IS NOT NULL
GROUP BY 1, 2 ORDER BY 1, 2
""")
def q_item_by_bin_long(spark, d):
    """Six half-open bins of c_acctbal, unparsable -> Unknown."""
    return R.item_by_bin_long(_event_ratings(spark, d), _customers(spark, d), None, item_key="item_id",
                              value="c_acctbal", value_type="double", edges=ACCT_EDGES_LEFT,
                              labels=ACCT_LABELS_LEFT, group_out="acct_group", numeric_item=False)


@register("q_occupation_stats", f"""
WITH u AS (
  SELECT e.value, COALESCE(c.c_nationkey, -1) AS occ
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
  WHERE e.value IS NOT NULL)
SELECT COALESCE(n.n_name, 'Unknown') AS occupation, {_AVG_VAL} AS avg_rating, COUNT(value) AS n_ratings
FROM u LEFT JOIN (SELECT n_nationkey + 5 AS n_nationkey, n_name FROM nation) n ON u.occ = n.n_nationkey
GROUP BY 1 ORDER BY avg_rating DESC, occupation ASC
""")
def q_occupation_stats(spark, d):
    """User -> c_nationkey (default -1) -> n_name of the nation five keys before (the first five keys
    miss: default Unknown)."""
    users = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"),
                                                F.col("c_nationkey").alias("occupation_id"))
    occ = table(spark, d, "nation").select((F.col("n_nationkey") + 5).alias("occupation_id"), F.col("n_name").alias("occupation"))
    return R.occupation_stats(_event_ratings(spark, d), users, occ, missing_key=-1)


def epoch_seconds_text(ts):
    """Epoch-seconds text of a zone-less timestamp (the ratings files' format)."""
    c = F.col(ts)
    secs = (F.unix_date(F.to_date(c)).cast("bigint") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
            + F.floor(F.second(c)))
    return secs.cast("string")


@register("q_year_stats", """
SELECT CAST(year(DATE '1970-01-01' + CAST(floor(epoch(o_orderdate) / 86400) AS INTEGER)) AS INTEGER) AS year,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice) AS avg_rating,
       COUNT(o_totalprice) AS n_ratings
FROM orders WHERE o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL
GROUP BY 1 ORDER BY 1
""")
def q_year_stats(spark, d):
    """Orders as ratings (o_totalprice) stamped with the epoch-seconds text of o_orderdate."""
    o = table(spark, d, "orders").select(epoch_seconds_text("o_orderdate").alias("ts"),
                                         F.col("o_totalprice").alias("rating"))
    return R.year_stats(o)


# ------------------------------------------------------------------ reviews
# documents as reviews: id = doc_id, comment = text, dim3 = lang, dim4 = source;
# sentiment from labels (quality 1 = positive, 0 = negative).

# The stop list used on the documents (function words of the
# four languages; one two-word entry that can never match a single token and
# one repeated entry, as in the original list).
DOC_STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was", "as", "with",
    "be", "by", "this", "are", "at", "an", "from",
    "de", "la", "le", "les", "des", "et", "en", "un", "que", "du",
    "der", "die", "das", "und", "den", "ist", "es",
    "el", "los", "y", "las", "del",
    "of the", "the",
)
FREQUENT_THRESHOLD = 500
TOP_K = 5


def _stop(spark):
    # A list fixed in code: bounded by construction, so it is broadcast.  Built
    # as a literal relation on the JVM side (no Python-backed scan).
    words = spark.range(1).select(F.explode(F.array(*[F.lit(w) for w in DOC_STOP_WORDS])).alias("stopword"))
    return F.broadcast(words)


def _stop_sql():
    vals = ", ".join("('" + w.replace("'", "''") + "')" for w in DOC_STOP_WORDS)
    return f"(VALUES {vals}) AS stop(stopword)"


_TOKENS = "unnest(list_filter(string_split_regex(lower(text), '[ \",()*]+'), lambda x: x <> ''))"


def _documents(spark, d, *cols):
    return table(spark, d, "documents").select(*cols)


def _texts(spark, d, *cols):
    """The documents scan for tokenising: spread by doc_id when the files give
    fewer splits than the cluster has cores (tokenising whole texts is CPU-bound)."""
    keep = list(cols) if "doc_id" in cols else ["doc_id", *cols]
    return spread(table(spark, d, "documents").select(*keep), "doc_id").select(*cols)


def _label_counts(spark, d, only: str | None = None):
    """labels pre-aggregated to (doc_id, sentiment, n): a document with many
    label rows becomes a weight instead of many copies of its text."""
    lab = table(spark, d, "labels")
    s = (F.when(F.col("quality") == 1, F.lit("positive"))
          .when(F.col("quality") == 0, F.lit("negative")))
    counted = lab.groupBy("doc_id", s.alias("sentiment")).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("sentiment") == only) if only else counted


_SENT_SQL = "CASE WHEN l.quality = 1 THEN 'positive' WHEN l.quality = 0 THEN 'negative' END"


@register("q_clean_tokens", f"""
WITH t AS (SELECT doc_id, {_TOKENS} AS word FROM documents)
SELECT doc_id, word FROM t
WHERE NOT EXISTS (SELECT 1 FROM {_stop_sql()} WHERE stop.stopword = t.word)
""")
def q_clean_tokens(spark, d):
    """(doc_id, word) for every non-stop token of every document."""
    return V.clean_tokens(_texts(spark, d, "doc_id", "text"), _stop(spark), id_col="doc_id", text_col="text")


@register("q_frequent_words", f"""
WITH t AS (SELECT doc_id, {_TOKENS} AS word FROM documents)
SELECT word, COUNT(doc_id) AS word_count FROM t
WHERE NOT EXISTS (SELECT 1 FROM {_stop_sql()} WHERE stop.stopword = t.word)
GROUP BY word HAVING COUNT(doc_id) > {FREQUENT_THRESHOLD}
""")
def q_frequent_words(spark, d):
    """Non-stop words seen more than 500 times."""
    return V.frequent_words(q_clean_tokens(spark, d), FREQUENT_THRESHOLD, id_col="doc_id")


@register("q_docs_per_source", """
SELECT source, COUNT(DISTINCT doc_id) AS num_docs FROM documents GROUP BY source
""")
def q_docs_per_source(spark, d):
    """N8 (4th column -> source)."""
    return V.comments_per_value(_documents(spark, d, "doc_id", "source"), "source", "doc_id", out="num_docs")


@register("q_docs_per_lang", """
SELECT lang, COUNT(DISTINCT doc_id) AS num_docs FROM documents GROUP BY lang
""")
def q_docs_per_lang(spark, d):
    """N9 (3rd column -> lang)."""
    return V.comments_per_value(_documents(spark, d, "doc_id", "lang"), "lang", "doc_id", out="num_docs")


@register("q_top_source_by_sentiment", f"""
WITH c AS (
  SELECT {_SENT_SQL} AS sentiment, d.source, COUNT(d.doc_id) AS total
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
  WHERE {_SENT_SQL} IN ('positive', 'negative')
  GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY total DESC, source ASC NULLS FIRST) AS rn FROM c)
SELECT sentiment, source, total FROM r WHERE rn = 1
""")
def q_top_source_by_sentiment(spark, d):
    """The source with most positive rows and the one with most negative rows."""
    docs = _documents(spark, d, "doc_id", "source").join(_label_counts(spark, d), "doc_id")
    return V.top_value_by_sentiment(docs, "source", "sentiment", "doc_id", weight="n")


def _top_words_sql(where: str, join: str) -> str:
    return f"""
WITH t AS (SELECT d.lang, {_TOKENS} AS word FROM documents d {join} {where}),
c AS (SELECT lang, word, COUNT(lang) AS cnt FROM t
      WHERE NOT EXISTS (SELECT 1 FROM {_stop_sql()} WHERE stop.stopword = t.word)
      GROUP BY lang, word),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY cnt DESC, word ASC) AS rn FROM c)
SELECT lang, word, cnt FROM r WHERE rn <= {TOP_K}"""


def _labelled(spark, d, sentiment):
    """Texts with their label.  The planner and the measured sizes choose: labels are broadcast while they are small, else both
    sides are sorted (which spills), after a filter of the labelled ids has reached the scan of the texts."""
    docs = _texts(spark, d, "doc_id", "text", "lang")
    return docs.join(_label_counts(spark, d, sentiment), "doc_id")


@register("q_top_words_positive", _top_words_sql("WHERE l.quality = 1", "JOIN labels l ON d.doc_id = l.doc_id"))
def q_top_words_positive(spark, d):
    """Per lang, top 5 words of positively labelled documents."""
    counts = V.word_counts(_labelled(spark, d, "positive"), _stop(spark), "lang", "sentiment", "text", weight="n")
    return V.top_words(None, None, "lang", "positive", TOP_K, counts=counts)


@register("q_top_words_negative", _top_words_sql("WHERE l.quality = 0", "JOIN labels l ON d.doc_id = l.doc_id"))
def q_top_words_negative(spark, d):
    """Per lang, top 5 words of negatively labelled documents."""
    counts = V.word_counts(_labelled(spark, d, "negative"), _stop(spark), "lang", "sentiment", "text", weight="n")
    return V.top_words(None, None, "lang", "negative", TOP_K, counts=counts)


@register("q_top_words", _top_words_sql("", ""))
def q_top_words(spark, d):
    """Per lang, top 5 words of all documents."""
    return V.top_words(_texts(spark, d, "text", "lang"), _stop(spark), "lang", None, TOP_K, text_col="text")


@register("q_nested_top_words", f"""
WITH t AS (SELECT lang, {_TOKENS} AS word FROM documents),
c AS (SELECT lang, word, COUNT(lang) AS cnt FROM t
      WHERE NOT EXISTS (SELECT 1 FROM {_stop_sql()} WHERE stop.stopword = t.word)
      GROUP BY lang, word),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY cnt DESC, word ASC) AS rn FROM c)
SELECT lang || ',{{' || string_agg('(' || lang || ',' || word || ',' || CAST(cnt AS VARCHAR) || ')', ',' ORDER BY rn) || '}}' AS line
FROM r WHERE rn <= {TOP_K} GROUP BY lang
""")
def q_nested_top_words(spark, d):
    """N13 in its nested-bag text form: ``lang,{(lang,word,cnt),...}``."""
    nested = V.top_words_nested(_texts(spark, d, "text", "lang"), _stop(spark), "lang", None, TOP_K,
                                text_col="text")
    return nested_bag_text(nested, "lang", "top_words", ["lang", "word", "cnt"])


# ----------------------------------------------------------------- commerce
# The star-schema tables seen as the e-commerce tables:
#   Orders        Order_ID = o_orderkey, Customer_Trx_ID = o_custkey,
#                 Order_Purchase_Timestamp = o_orderdate, expected delivery = o_orderdate + 30 days
#   Order_Items   Order_ID = l_orderkey, Order_Item_ID = l_linenumber, Product_ID = l_partkey,
#                 Seller_ID = l_suppkey, Price = l_extendedprice, Freight_Value = l_extendedprice * l_tax
#                 (exact decimals), actual delivery = l_shipdate
#   Products      Product_ID = p_partkey, Product_Category_Name = p_type
#   Customer_List Customer_Trx_ID = c_custkey, Customer_Country = n_name
#   Order_Reviews Order_ID = event_id, Review_Score = the text of props.k


REVENUE_YEAR = 1998
SEGMENT_VIP_MIN_AVG = 50000

_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
_REV = f"({_PRICE} + {_PRICE} * CAST(l_tax AS DECIMAL(18,2)))"
_SCORE = "TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)"


def _ec_orders(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("Order_ID"), F.col("o_custkey").alias("Customer_Trx_ID"),
                    F.col("o_orderdate").alias("Order_Purchase_Timestamp"))


def _ec_items(spark, d):
    li = table(spark, d, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return li.select(F.col("l_orderkey").alias("Order_ID"), F.col("l_linenumber").alias("Order_Item_ID"),
                     F.col("l_partkey").alias("Product_ID"), F.col("l_suppkey").alias("Seller_ID"),
                     price.alias("Price"), (price * F.col("l_tax").cast("decimal(18,2)")).alias("Freight_Value"))


def _ec_products(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("Product_ID"),
                                          F.col("p_type").alias("Product_Category_Name"))


def _ec_customers(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("Customer_Trx_ID"), "c_nationkey")
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"),
                                         F.col("n_name").alias("Customer_Country"))
    return lookup_inner(c, n, "c_nationkey").select("Customer_Trx_ID", "Customer_Country")


def _ec_reviews(spark, d):
    e = table(spark, d, "events")
    return e.select(F.col("event_id").alias("Order_ID"),
                    F.get_json_object("props", "$.k").alias("Review_Score"))


@register("q_entity_totals", """
SELECT (SELECT COUNT(DISTINCT o_orderkey) + MAX(CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END) FROM orders) AS total_orders,
       (SELECT COUNT(DISTINCT c_custkey) + MAX(CASE WHEN c_custkey IS NULL THEN 1 ELSE 0 END) FROM customer) AS total_customers,
       (SELECT COUNT(DISTINCT l_suppkey) + MAX(CASE WHEN l_suppkey IS NULL THEN 1 ELSE 0 END) FROM lineitem) AS total_sellers
""")
def q_entity_totals(spark, d):
    """Distinct orders, customers and sellers (null counted as a value)."""
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("Customer_Trx_ID"))
    return C.entity_totals(_ec_orders(spark, d), customers, _ec_items(spark, d))


@register("q_orders_by_country", """
SELECT n.n_name AS country, COUNT(DISTINCT o.o_orderkey) AS total_orders
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name ORDER BY total_orders DESC, country ASC
""")
def q_orders_by_country(spark, d):
    """N23."""
    return C.orders_by_country(_ec_orders(spark, d), _ec_customers(spark, d))


@register("q_orders_by_year_month", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       COUNT(o_orderkey) AS total_orders
FROM orders GROUP BY 1, 2 ORDER BY year ASC NULLS FIRST, month DESC NULLS LAST
""")
def q_orders_by_year_month(spark, d):
    """N24."""
    return C.orders_by_year_month(_ec_orders(spark, d))


@register("q_review_average", f"""
SELECT {_round2('SUM(s)', 'COUNT(s)')} AS average_score
FROM (SELECT {_SCORE} AS s FROM events) WHERE s BETWEEN 1 AND 5
""")
def q_review_average(spark, d):
    """scores = props.k kept when an integer in 1..5."""
    return C.review_average(_ec_reviews(spark, d))


@register("q_review_distribution", f"""
SELECT s AS score, COUNT(*) AS total_reviews
FROM (SELECT {_SCORE} AS s FROM events) WHERE s BETWEEN 1 AND 5
GROUP BY s ORDER BY s
""")
def q_review_distribution(spark, d):
    """N26."""
    return C.review_distribution(_ec_reviews(spark, d))


@register("q_revenue_by_category", f"""
SELECT p.p_type AS category, CAST(SUM({_REV}) AS DOUBLE) AS total_revenue
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
WHERE o.o_orderdate >= TIMESTAMP '{REVENUE_YEAR}-01-01' AND o.o_orderdate < TIMESTAMP '{REVENUE_YEAR + 1}-01-01'
GROUP BY p.p_type ORDER BY total_revenue DESC, category ASC
""")
def q_revenue_by_category(spark, d):
    """N27 for purchases in 1998."""
    return C.revenue_by_category(_ec_items(spark, d), _ec_orders(spark, d), _ec_products(spark, d),
                                 year=REVENUE_YEAR)


@register("q_category_sales_and_score", f"""
WITH r AS (SELECT event_id, {_SCORE} AS s FROM events),
rc AS (SELECT event_id, s FROM r WHERE s BETWEEN 1 AND 5),
j AS (SELECT p.p_type, l.l_linenumber, rc.s
      FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
      LEFT JOIN rc ON l.l_orderkey = rc.event_id)
SELECT p_type AS category, COUNT(l_linenumber) AS total_orders,
       {_round2('SUM(s)', 'COUNT(s)')} AS average_review_score
FROM j GROUP BY p_type ORDER BY total_orders DESC, category ASC
""")
def q_category_sales_and_score(spark, d):
    """Items x products, left-joined to the cleaned scores of their order."""
    return C.category_sales_and_score(_ec_items(spark, d), _ec_products(spark, d), _ec_reviews(spark, d))


@register("q_delivery_performance", """
SELECT l.l_orderkey AS order_id, l.l_partkey AS product_id, l.l_shipdate AS actual_date,
       o.o_orderdate + INTERVAL 30 DAY AS expected_date,
       CAST(date_diff('day', CAST(o.o_orderdate + INTERVAL 30 DAY AS DATE), CAST(l.l_shipdate AS DATE)) AS INTEGER) AS delivery_diff_days,
       CASE WHEN date_diff('day', CAST(o.o_orderdate + INTERVAL 30 DAY AS DATE), CAST(l.l_shipdate AS DATE)) > 0
            THEN 'Late' ELSE 'On Time / Early' END AS delivery_status
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE l.l_shipdate IS NOT NULL
""")
def q_delivery_performance(spark, d):
    """actual = l_shipdate, expected = o_orderdate + 30 days."""
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("Order_ID"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("Shipping_Limit_Date"))
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("Order_ID"),
                                               F.col("l_partkey").alias("Product_ID"),
                                               F.col("l_shipdate").alias("Order_Delivered_Carrier_Date"))
    return C.delivery_performance(orders, items)


@register("q_customer_segments", f"""
WITH j AS (SELECT o.o_custkey, o.o_orderkey, {_REV} AS v
           FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey),
s AS (SELECT o_custkey AS customer_id, COUNT(DISTINCT o_orderkey) AS total_orders,
             {_round2('SUM(v)', 'COUNT(v)')} AS avg_order_value
      FROM j GROUP BY o_custkey)
SELECT customer_id, total_orders, avg_order_value,
       CASE WHEN total_orders >= 10 AND avg_order_value >= {SEGMENT_VIP_MIN_AVG} THEN 'VIP Customer'
            WHEN total_orders >= 5 THEN 'Frequent Customer' ELSE 'Regular Customer' END AS customer_group
FROM s
""")
def q_customer_segments(spark, d):
    """N30 with the VIP average set to 50,000 (the rule's 500 scaled to these prices)."""
    return C.customer_segments(_ec_orders(spark, d), _ec_items(spark, d), vip_min_avg=SEGMENT_VIP_MIN_AVG)


@register("q_seller_ranking", f"""
SELECT l_suppkey AS seller_id, CAST(ROUND(SUM({_REV}), 2) AS DOUBLE) AS total_revenue,
       COUNT(DISTINCT l_orderkey) AS total_orders
FROM lineitem GROUP BY l_suppkey
ORDER BY total_revenue DESC, total_orders DESC, seller_id ASC
""")
def q_seller_ranking(spark, d):
    """N31."""
    return C.seller_ranking(_ec_items(spark, d))


# ------------------------------------------------------ operator-level queries


def _line(sep, *fields):
    """A text line; a null is an empty field."""
    texts = [(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields]
    return F.concat_ws(sep, *[F.coalesce(t, F.lit("")) for t in texts]).alias("value")


def _line_sql(sep, *fields):
    return f"concat_ws('{sep}', " + ", ".join(f"coalesce(CAST({f} AS VARCHAR), '')" for f in fields) + ")"


def _rating_lines(spark, d, sep):
    """lineitem rendered as rating text lines: user, item, rating, epoch seconds."""
    return table(spark, d, "lineitem").select(_line(sep, "l_orderkey", "l_partkey", "l_quantity",
                                                    epoch_seconds_text("l_shipdate")))


def _movie_lines(spark, d, sep):
    """part rendered as movie text lines: id, title, '|'-joined words of the name."""
    return table(spark, d, "part").select(_line(sep, "p_partkey", "p_name", F.regexp_replace("p_name", " ", "|")))


_JT = "regexp_replace({x}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


@register("q_item_rating_stats_text", f"""
WITH r AS (SELECT string_split({_line_sql(', ', "l_orderkey", "l_partkey", "l_quantity")}, ',') AS f
           FROM lineitem),
rp AS (SELECT {_JT.format(x='f[2]')} AS movie_id, TRY_CAST({_JT.format(x='f[3]')} AS DOUBLE) AS rating
       FROM r WHERE len(f) >= 3),
m AS (SELECT string_split({_line_sql(', ', "p_partkey", "p_name")}, ',') AS f FROM part),
mp AS (SELECT {_JT.format(x='f[1]')} AS movie_id, {_JT.format(x='f[2]')} AS title FROM m WHERE len(f) >= 2)
SELECT title, CAST(SUM(CAST(rating AS DECIMAL(18,2))) AS DOUBLE) / COUNT(rating) AS avg_rating,
       COUNT(rating) AS n_ratings
FROM rp JOIN mp ON rp.movie_id = mp.movie_id
WHERE rating IS NOT NULL GROUP BY title
""")
def q_item_rating_stats_text(spark, d):
    """N1 through the positional-text path: lineitem and part rendered as
    ', '-separated lines, parsed with Java split/trim/skip rules."""
    ratings = parse_ratings(_rating_lines(spark, d, ", "), JAVA, fields=("movie_id", "rating"))
    return R.item_rating_stats(ratings, parse_movies(_movie_lines(spark, d, ", "), JAVA))


@register("q_item_stats_text_strict", f"""
WITH r AS (SELECT string_split({_line_sql(',', "l_orderkey", "l_partkey", "l_quantity")}, ',') AS f
           FROM lineitem),
s AS (SELECT f[2] AS movie_id, CAST(SUM(CAST(CAST(f[3] AS DOUBLE) AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_rating,
             COUNT(*) AS n_ratings
      FROM r GROUP BY f[2] HAVING COUNT(*) >= {MIN_RATINGS_BY_ID}),
m AS (SELECT string_split({_line_sql(',', "p_partkey", "p_name", "replace(p_name, ' ', '|')")}, ',') AS f FROM part)
SELECT s.movie_id, array_to_string(m.f[2:len(m.f) - 1], ',') AS title, s.avg_rating, s.n_ratings
FROM s JOIN m ON s.movie_id = m.f[1]
""")
def q_item_stats_text_strict(spark, d):
    """N14 through the positional-text path with Python split rules, the title
    rebuilt from the middle fields, and a strict rating parse."""
    ratings = parse_ratings(_rating_lines(spark, d, ","), PYTHON, fields=("movie_id", "rating"))
    return R.item_stats_min_ratings(ratings, parse_movies(_movie_lines(spark, d, ","), PYTHON),
                                    min_count=MIN_RATINGS_BY_ID)


@register("q_union_all", """
SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01'
""")
def q_union_all(spark, d):
    """UNION ALL of two overlapping order slices (1997 appears twice)."""
    o = table(spark, d, "orders")
    cols = ["o_orderkey", "o_custkey", F.year("o_orderdate").alias("year")]
    ts = o.schema["o_orderdate"].dataType
    return union_all(o.where(F.col("o_orderdate") < F.lit("1998-01-01 00:00:00").cast(ts)).select(*cols),
                     o.where(F.col("o_orderdate") >= F.lit("1997-01-01 00:00:00").cast(ts)).select(*cols))


@register("q_distinct_pairs", """
SELECT DISTINCT o_custkey, o_orderstatus FROM orders
""")
def q_distinct_pairs(spark, d):
    """DISTINCT over a column pair."""
    return table(spark, d, "orders").select("o_custkey", "o_orderstatus").distinct()


# Java rounds the number's shortest decimal text, C and Python its binary value
_HALF_UP = "printf('%.2f', ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 2))"
_HALF_EVEN = "printf('%.2f', CAST({x} AS DOUBLE))"


@register("q_title_stats_lines", f"""{_STATS_CTE}
SELECT title || chr(9) || 'AverageRating: ' || {_HALF_UP.format(x='avg_rating')} || ' (TotalRatings: '
       || CAST(n_ratings AS VARCHAR) || ')' AS line FROM s
UNION ALL
SELECT * FROM (SELECT chr(10) || title || chr(9) || 'is the highest rated movie with an average rating of '
       || {_HALF_UP.format(x='avg_rating')} || ' among movies with at least 5 ratings.' AS line
       FROM s WHERE n_ratings >= 5 ORDER BY avg_rating DESC, title ASC LIMIT 1)
""")
def q_title_stats_lines(spark, d):
    """N1+N2 in the key<TAB>value text form (sorted lines, best title last)."""
    # a few rows for each title, used twice: the facts are joined once
    stats = materialize(q_item_rating_stats(spark, d))
    return ordered(P.title_stats_lines(stats, R.best_item(stats, min_count=5)))


@register("q_group_report_lines", f"""
WITH s AS (
  SELECT e.event_type AS item_id, c.c_mktsegment, {_AVG_VAL} AS avg_rating
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
  WHERE e.value IS NOT NULL GROUP BY 1, 2)
SELECT '--- DIEM TRUNG BINH PHIM THEO GIOI TINH ---' AS line
UNION ALL SELECT repeat('-', 40) FROM (SELECT DISTINCT item_id FROM s)
UNION ALL
SELECT 'ID: ' || rpad(item_id, CAST(greatest(length(item_id), 4) AS INTEGER), ' ') || ' | Phim: '
       || rpad(substr(item_id, 1, 25), CAST(greatest(length(substr(item_id, 1, 25)), 25) AS INTEGER), ' ')
       || ' | Giới tính: ' || c_mktsegment || ' | Điểm TB: ' || {_HALF_EVEN.format(x='avg_rating')}
FROM s
""")
def q_group_report_lines(spark, d):
    """N17 as a formatted report: header, a separator before each item,
    padded and cut fields, averages printed with ties to even."""
    stats = R.item_by_group_long(_event_ratings(spark, d), _customers(spark, d), None, item_key="item_id",
                                 group="c_mktsegment", numeric_item=False, ordered=False)
    return ordered(P.gender_report(stats, item_key="item_id", title="item_id", group="c_mktsegment"))


@register("q_year_report_lines", f"""
WITH s AS (
  SELECT CAST(year(DATE '1970-01-01' + CAST(floor(epoch(o_orderdate) / 86400) AS INTEGER)) AS INTEGER) AS year,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice) AS avg_rating,
         COUNT(o_totalprice) AS n_ratings
  FROM orders WHERE o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL GROUP BY 1)
SELECT '--- THONG KE DANH GIA THEO NAM ---' AS line
UNION ALL
SELECT 'Năm: ' || CAST(year AS VARCHAR) || ' | Điểm TB: ' || {_HALF_EVEN.format(x='avg_rating')}
       || ' | Tổng số lượt đánh giá: ' || CAST(n_ratings AS VARCHAR) FROM s
""")
def q_year_report_lines(spark, d):
    """N20 as a formatted report."""
    o = table(spark, d, "orders").select(epoch_seconds_text("o_orderdate").alias("ts"),
                                         F.col("o_totalprice").alias("rating"))
    return ordered(P.year_report(R.year_stats(o, ordered=False)))


@register("q_seller_rank", f"""
WITH s AS (SELECT l_suppkey AS seller_id, CAST(ROUND(SUM({_REV}), 2) AS DOUBLE) AS total_revenue,
                  COUNT(DISTINCT l_orderkey) AS total_orders
           FROM lineitem GROUP BY l_suppkey)
SELECT seller_id, total_revenue, total_orders,
       rank() OVER (ORDER BY total_revenue DESC NULLS LAST, total_orders DESC NULLS LAST) AS rank
FROM s
""")
def q_seller_rank(spark, d):
    """N31 with its rank column (distributed global rank, ties share a rank)."""
    return C.seller_ranking(_ec_items(spark, d), with_rank=True)


@register("q_category_sales_fan_out", f"""
WITH rc AS (SELECT user_id AS oid, s FROM (SELECT user_id, {_SCORE} AS s FROM events) WHERE s BETWEEN 1 AND 5),
j AS (SELECT p.p_type, l.l_linenumber, rc.s
      FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
      LEFT JOIN rc ON l.l_orderkey = rc.oid)
SELECT p_type AS category, COUNT(l_linenumber) AS total_orders,
       {_round2('SUM(s)', 'COUNT(s)')} AS average_review_score
FROM j GROUP BY p_type ORDER BY total_orders DESC, category ASC
""")
def q_category_sales_fan_out(spark, d):
    """N28 with several reviews per order: the scores are keyed by the event's
    user_id, so each of the orders 0..149 has dozens of review rows and every
    one of its items is counted once per valid review (the row-level join)."""
    e = table(spark, d, "events")
    reviews = e.select(F.col("user_id").alias("Order_ID"), F.get_json_object("props", "$.k").alias("Review_Score"))
    return C.category_sales_and_score(_ec_items(spark, d), _ec_products(spark, d), reviews)


@register("q_tag_rating_stats_text", f"""
WITH r AS (SELECT string_split({_line_sql(', ', "l_orderkey", "l_partkey", "l_quantity")}, ',') AS f
           FROM lineitem),
rp AS (SELECT {_JT.format(x='f[2]')} AS movie_id, TRY_CAST({_JT.format(x='f[3]')} AS DOUBLE) AS rating
       FROM r WHERE len(f) >= 3),
m AS (SELECT string_split({_line_sql(', ', "p_partkey", "p_name", "replace(p_name, ' ', '|')")}, ',') AS f FROM part),
mp AS (SELECT {_JT.format(x='f[1]')} AS movie_id, {_JT.format(x='f[len(f)]')} AS genres FROM m WHERE len(f) >= 3),
g AS (SELECT movie_id, unnest(string_split(genres, '|')) AS tag FROM mp)
SELECT {_JT.format(x='tag')} AS genre, CAST(SUM(CAST(rating AS DECIMAL(18,2))) AS DOUBLE) / COUNT(rating) AS avg_rating,
       COUNT(rating) AS n_ratings
FROM rp JOIN g ON rp.movie_id = g.movie_id
WHERE rating IS NOT NULL GROUP BY 1
""")
def q_tag_rating_stats_text(spark, d):
    """N3 through the Java text path: genres are the last field of each
    derived movie line ('|'-joined words of p_name), split with Java rules."""
    ratings = parse_ratings(_rating_lines(spark, d, ", "), JAVA, fields=("movie_id", "rating"))
    return R.tag_rating_stats(ratings, parse_movies(_movie_lines(spark, d, ", "), JAVA))


def _user_lines(spark, d):
    """customer rendered as user text lines: id, group (lower-cased segment),
    age (whole part of the balance), nation."""
    return table(spark, d, "customer").select(_line(", ", "c_custkey", F.lower("c_mktsegment"),
                                                    F.floor("c_acctbal").cast("int"), "c_nationkey"))


def _event_lines(spark, d):
    """events rendered as rating text lines: user, item (event type), value."""
    return table(spark, d, "events").select(_line(", ", "user_id", "event_type", "value"))


@register("q_item_by_two_groups_text", f"""
WITH u AS (SELECT string_split({_line_sql(', ', "c_custkey", "lower(c_mktsegment)", "CAST(floor(c_acctbal) AS INTEGER)", "c_nationkey")}, ',') AS f FROM customer),
up AS (SELECT {_JT.format(x='f[1]')} AS user_id, upper({_JT.format(x='f[2]')}) AS grp FROM u WHERE len(f) >= 2),
r AS (SELECT string_split({_line_sql(', ', "user_id", "event_type", "value")}, ',') AS f FROM events),
rp AS (SELECT {_JT.format(x='f[1]')} AS user_id, {_JT.format(x='f[2]')} AS item_id,
              TRY_CAST({_JT.format(x='f[3]')} AS DOUBLE) AS value FROM r WHERE len(f) >= 3),
j AS (SELECT rp.item_id, up.grp, rp.value FROM rp JOIN up ON rp.user_id = up.user_id
      WHERE rp.value IS NOT NULL AND up.grp IN ('BUILDING', 'MACHINERY'))
SELECT item_id AS movie_id, {_cond_avg('BUILDING', 'avg_building')}, {_cond_avg('MACHINERY', 'avg_machinery')}
FROM j GROUP BY item_id
""")
def q_item_by_two_groups_text(spark, d):
    """N4 through the Java text path: user lines from customer (group read
    upper-cased), rating lines from events; the item is its own title."""
    ratings = parse_ratings(_event_lines(spark, d), JAVA, fields=("user_id", "movie_id", "rating"))
    users = parse_users(_user_lines(spark, d), JAVA)
    return R.item_by_two_groups(ratings, users, None, groups=("BUILDING", "MACHINERY"),
                                names=("avg_building", "avg_machinery"))


@register("q_item_by_age_bucket_text", f"""
WITH u AS (SELECT string_split({_line_sql(', ', "c_custkey", "lower(c_mktsegment)", "CAST(floor(c_acctbal) AS INTEGER)", "c_nationkey")}, ',') AS f FROM customer),
up AS (SELECT {_JT.format(x='f[1]')} AS user_id, TRY_CAST({_JT.format(x='f[3]')} AS INTEGER) AS age
       FROM u WHERE len(f) >= 2),
ub AS (SELECT user_id, CASE WHEN age <= 18 THEN '0-18' WHEN age <= 35 THEN '18-35' WHEN age <= 50 THEN '35-50'
                            WHEN age IS NOT NULL THEN '50+' END AS grp FROM up),
r AS (SELECT string_split({_line_sql(', ', "user_id", "event_type", "value")}, ',') AS f FROM events),
rp AS (SELECT {_JT.format(x='f[1]')} AS user_id, {_JT.format(x='f[2]')} AS item_id,
              TRY_CAST({_JT.format(x='f[3]')} AS DOUBLE) AS value FROM r WHERE len(f) >= 3),
j AS (SELECT rp.item_id, ub.grp, rp.value FROM rp JOIN ub ON rp.user_id = ub.user_id
      WHERE rp.value IS NOT NULL AND ub.grp IS NOT NULL)
SELECT item_id AS movie_id, {_cond_avg('0-18', 'avg_0_18')}, {_cond_avg('18-35', 'avg_18_35')},
       {_cond_avg('35-50', 'avg_35_50')}, {_cond_avg('50+', 'avg_50_plus')}
FROM j GROUP BY item_id
""")
def q_item_by_age_bucket_text(spark, d):
    """N5 through the Java text path: the age field of the user lines is the
    whole part of the customer balance, parsed as an integer and binned
    <=18, <=35, <=50, above."""
    ratings = parse_ratings(_event_lines(spark, d), JAVA, fields=("user_id", "movie_id", "rating"))
    return R.item_by_bucket(ratings, parse_users(_user_lines(spark, d), JAVA), None)


@register("q_item_by_group_long_text", f"""
WITH u AS (SELECT string_split({_line_sql(',', "c_custkey", "c_mktsegment", "CAST(floor(c_acctbal) AS INTEGER)", "c_nationkey")}, ',') AS f FROM customer),
r AS (SELECT string_split({_line_sql(',', "user_id", "event_type", "value")}, ',') AS f FROM events),
j AS (SELECT r.f[2] AS item_id, u.f[2] AS gender, CAST(r.f[3] AS DOUBLE) AS value
      FROM r JOIN u ON r.f[1] = u.f[1])
SELECT item_id AS movie_id, gender, {_AVG_VAL} AS avg_rating
FROM j GROUP BY 1, 2
""")
def q_item_by_group_long_text(spark, d):
    """N17 through the Python text path: ',' lines without spaces, fields
    untrimmed, ratings parsed strictly; (event type, segment) long form."""
    def lines(df, *cols):
        return df.select(_line(",", *cols))
    c = table(spark, d, "customer")
    users = parse_users(lines(c, "c_custkey", "c_mktsegment", F.floor("c_acctbal").cast("int"), "c_nationkey"),
                        PYTHON)
    e = table(spark, d, "events")
    ratings = parse_ratings(lines(e, "user_id", "event_type", F.col("value").cast("string")), PYTHON,
                            fields=("user_id", "movie_id", "rating"))
    return R.item_by_group_long(ratings, users, None, numeric_item=False)



@register("q_occupation_stats_text", f"""
WITH u AS (SELECT string_split({_line_sql(',', "c_custkey", "c_mktsegment", "CAST(floor(c_acctbal) AS INTEGER)", "c_nationkey")}, ',') AS f FROM customer),
um AS (SELECT f[1] AS user_id, f[4] AS occ FROM u),
o AS (SELECT string_split({_line_sql(',', "n_nationkey + 5", "n_name")}, ',') AS f FROM nation),
om AS (SELECT f[1] AS occ, f[2] AS occupation FROM o),
r AS (SELECT string_split({_line_sql(',', "user_id", "event_type", "value")}, ',') AS f FROM events),
rp AS (SELECT f[1] AS user_id, CAST(f[3] AS DOUBLE) AS value FROM r),
j AS (SELECT COALESCE(om.occupation, 'Unknown') AS occupation, rp.value
      FROM rp LEFT JOIN um ON rp.user_id = um.user_id
      LEFT JOIN om ON COALESCE(um.occ, '-1') = om.occ)
SELECT occupation, {_AVG_VAL} AS avg_rating, COUNT(value) AS n_ratings
FROM j GROUP BY occupation ORDER BY avg_rating DESC, occupation ASC
""")
def q_occupation_stats_text(spark, d):
    """N19 through the Python text path: user lines from customer (occupation
    id = nation key), occupation lines from the nations with five added to their
    key, so that misses fall back to "-1" and then "Unknown"."""
    def lines(df, *cols):
        return df.select(_line(",", *cols))
    users = parse_users(lines(table(spark, d, "customer"), "c_custkey", "c_mktsegment",
                              F.floor("c_acctbal").cast("int"), "c_nationkey"), PYTHON)
    occupations = parse_occupations(lines(table(spark, d, "nation"), F.col("n_nationkey") + 5, "n_name"))
    ratings = parse_ratings(lines(table(spark, d, "events"), "user_id", "event_type", F.col("value").cast("string")),
                            PYTHON, fields=("user_id", "rating"))
    return R.occupation_stats(ratings, users, occupations)


# ------------------------------------- values, duplicates and lines that are not clean

@register("q_item_rating_stats_fine", """
SELECT p_name AS title, ROUND(AVG(CAST(l_extendedprice AS DOUBLE) * l_tax / 3), 4) AS avg_rating, COUNT(*) AS n_ratings
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_extendedprice IS NOT NULL AND l_tax IS NOT NULL GROUP BY p_name
""")
def q_item_rating_stats_fine(spark, d):
    """N1 on ratings with many decimals (price * tax / 3), rounded only at the end."""
    ratings = table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("item_id"), (F.col("l_extendedprice").cast("double") * F.col("l_tax") / 3).alias("rating"))
    stats = R.item_rating_stats(ratings, _parts(spark, d), item_key="item_id")
    return stats.withColumn("avg_rating", F.round("avg_rating", 4))


@register("q_item_rating_stats_last_wins", f"""
WITH dim AS (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders)
SELECT o_orderpriority AS title, {_AVG_VAL} AS avg_rating, COUNT(value) AS n_ratings
FROM events JOIN dim ON user_id = o_custkey AND rn = 1 WHERE value IS NOT NULL GROUP BY 1
""")
def q_item_rating_stats_last_wins(spark, d):
    """N1 with a dimension that repeats its keys: item = the event's user, title = the priority of that
    customer's last order (greatest o_orderkey), as a map filled in order keeps it."""
    items = table(spark, d, "orders").select(F.col("o_custkey").alias("item_id"), F.col("o_orderpriority").alias("title"),
                                             F.col("o_orderkey").alias(ORDER))
    ratings = table(spark, d, "events").select(F.col("user_id").alias("item_id"), F.col("value").alias("rating"))
    return R.item_rating_stats(ratings, items, item_key="item_id")


def _supplied(spark, d):
    """lineitem as ratings: user = l_suppkey, item = l_partkey (as text), rating = l_quantity."""
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("user_id"), F.col("l_partkey").cast("string").alias("item_id"),
                                              F.col("l_quantity").alias("rating"))


def _suppliers(spark, d):
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("user_id"),
                                              F.pmod("s_nationkey", F.lit(4)).cast("string").alias("grp"), "s_acctbal")


def _titles(spark, d):
    return _parts(spark, d).withColumn("item_id", F.col("item_id").cast("string"))


_SUPPLIED = """FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  WHERE l_quantity IS NOT NULL"""


@register("q_item_by_two_groups_titled", f"""
WITH j AS (SELECT p_name, CAST(s_nationkey % 4 AS VARCHAR) AS grp, l_quantity AS value {_SUPPLIED} AND s_nationkey % 4 IN (1, 3))
SELECT p_name AS title, {_cond_avg('1', 'avg_one')}, {_cond_avg('3', 'avg_three')} FROM j GROUP BY p_name
""")
def q_item_by_two_groups_titled(spark, d):
    """N4 with both dimensions: users = supplier (group = nation key mod 4), items = part."""
    return R.item_by_two_groups(_supplied(spark, d), _suppliers(spark, d), _titles(spark, d), item_key="item_id", group="grp",
                                groups=("1", "3"), names=("avg_one", "avg_three"))


@register("q_item_by_bucket_titled", f"""
WITH j AS (SELECT p_name, l_quantity AS value,
                  CASE WHEN s_acctbal <= 1000 THEN 'le_1000' WHEN s_acctbal <= 3000 THEN '1000_3000'
                       WHEN s_acctbal <= 6000 THEN '3000_6000' WHEN s_acctbal IS NOT NULL THEN 'gt_6000' END AS grp {_SUPPLIED})
SELECT p_name AS title, {_cond_avg('le_1000', 'avg_le_1000')}, {_cond_avg('1000_3000', 'avg_1000_3000')},
       {_cond_avg('3000_6000', 'avg_3000_6000')}, {_cond_avg('gt_6000', 'avg_gt_6000')}
FROM j WHERE grp IS NOT NULL GROUP BY p_name
""")
def q_item_by_bucket_titled(spark, d):
    """N5 with both dimensions: users = supplier (bins of s_acctbal), items = part."""
    return R.item_by_bucket(_supplied(spark, d), _suppliers(spark, d), _titles(spark, d), item_key="item_id", value="s_acctbal",
                            value_type="double", edges=ACCT_EDGES_RIGHT, labels=ACCT_LABELS_RIGHT,
                            names=tuple("avg_" + x for x in ACCT_LABELS_RIGHT))


@register("q_item_by_group_long_titled", f"""
SELECT l_partkey AS item_id, p_name AS title, CAST(s_nationkey % 4 AS VARCHAR) AS grp, {_AVG_QTY} AS avg_rating
{_SUPPLIED} GROUP BY 1, 2, 3 ORDER BY 1, 3
""")
def q_item_by_group_long_titled(spark, d):
    """N17 with titles and a numeric sort of the text item id: users = supplier, items = part."""
    return R.item_by_group_long(_supplied(spark, d), _suppliers(spark, d), _titles(spark, d), item_key="item_id", group="grp")


@register("q_item_by_bin_long_titled", f"""
SELECT l_partkey AS item_id, p_name AS title,
       CASE WHEN s_acctbal < 0 THEN '<0' WHEN s_acctbal < 2000 THEN '0-2000' WHEN s_acctbal < 4000 THEN '2000-4000'
            WHEN s_acctbal < 6000 THEN '4000-6000' WHEN s_acctbal < 8000 THEN '6000-8000'
            WHEN s_acctbal IS NOT NULL THEN '8000+' ELSE 'Unknown' END AS acct_group, {_AVG_QTY} AS avg_rating
{_SUPPLIED} GROUP BY 1, 2, 3 ORDER BY 1, 3
""")
def q_item_by_bin_long_titled(spark, d):
    """N18 with titles and a numeric sort of the text item id."""
    return R.item_by_bin_long(_supplied(spark, d), _suppliers(spark, d), _titles(spark, d), item_key="item_id", value="s_acctbal",
                              value_type="double", edges=ACCT_EDGES_LEFT, labels=ACCT_LABELS_LEFT, group_out="acct_group")


# Lines of lineitem of which some are cut short, some have an empty or unparsable rating (chosen by the order key).
def _spoilt_lines(spark, d):
    kind = F.pmod("l_orderkey", F.lit(11))
    rating = F.when(kind == 1, "").when(kind == 2, "n/a").when(kind == 3, " ").otherwise(F.col("l_quantity").cast("string"))
    whole = _line(", ", "l_orderkey", "l_partkey", rating, epoch_seconds_text("l_shipdate"))
    return table(spark, d, "lineitem").select(F.when(kind == 4, _line(", ", "l_orderkey", "l_partkey")).when(kind == 5, F.lit(",,"))
                                              .otherwise(whole).alias("value"))


@register("q_item_stats_spoilt_lines", f"""
WITH good AS (SELECT l_partkey, l_quantity FROM lineitem WHERE l_orderkey % 11 NOT IN (1, 2, 3, 4, 5) AND l_quantity IS NOT NULL)
SELECT p_name AS title, {_AVG_QTY} AS avg_rating, COUNT(l_quantity) AS n_ratings
FROM good JOIN part ON l_partkey = p_partkey GROUP BY p_name
""")
def q_item_stats_spoilt_lines(spark, d):
    """N1 on Java-rule lines of which five kinds in eleven are bad: empty, blank or unparsable ratings,
    short lines, lines of separators only (F1, F2)."""
    ratings = parse_ratings(_spoilt_lines(spark, d), JAVA, fields=("movie_id", "rating"))
    return R.item_rating_stats(ratings, parse_movies(_movie_lines(spark, d, ", "), JAVA))


@register("q_year_stats_spoilt_times", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_rating,
       COUNT(*) AS n_ratings
FROM orders WHERE o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL AND o_orderkey % 7 NOT IN (1, 2) GROUP BY 1 ORDER BY 1
""")
def q_year_stats_spoilt_times(spark, d):
    """N20 on Python-rule lines, two kinds in seven with an empty or unparsable timestamp."""
    kind = F.pmod("o_orderkey", F.lit(7))
    ts = F.when(kind == 1, "").when(kind == 2, "soon").otherwise(epoch_seconds_text("o_orderdate"))
    lines = table(spark, d, "orders").where(F.col("o_totalprice").isNotNull()).select(_line(",", "o_custkey", "o_orderkey", "o_totalprice", ts))
    return R.year_stats(parse_ratings(lines, PYTHON, fields=("rating", "ts")))


def _review_lines(spark, d):
    """documents as ';' review lines; separators and line breaks in a text become spaces."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), "[;\r\n]", " ")
    return _texts(spark, d, "doc_id", "text", "lang", "source").select(_line(";", "doc_id", text, "lang", "source"))


@register("q_frequent_words_lines", f"""
WITH t AS (SELECT {_TOKENS.replace('text', "regexp_replace(coalesce(text, ''), '[;\r\n]', ' ', 'g')")} AS word FROM documents)
SELECT word, COUNT(*) AS word_count FROM t WHERE NOT EXISTS (SELECT 1 FROM (SELECT lower(n_name) AS stopword FROM nation) s
                                                             WHERE s.stopword = t.word)
GROUP BY word HAVING COUNT(*) > {FREQUENT_THRESHOLD}
""")
def q_frequent_words_lines(spark, d):
    """N6 and N7 on declared-schema ';' lines, with a stop list read as lines (the nations' names)."""
    stop = table(spark, d, "nation").select(F.lower("n_name").alias("stopword"))
    reviews = parse_delimited(_review_lines(spark, d))
    return V.frequent_words(V.clean_tokens(reviews, stop), FREQUENT_THRESHOLD)


@register("q_orders_by_year_month_text", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, COUNT(o_orderkey) AS total_orders
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2 ORDER BY year ASC, month DESC
""")
def q_orders_by_year_month_text(spark, d):
    """N24 on text timestamps, with and without seconds by turns."""
    o = table(spark, d, "orders").where(F.col("o_orderdate").isNotNull())
    text = F.when(F.pmod("o_orderkey", F.lit(2)) == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm")) \
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return C.orders_by_year_month(o.select(F.col("o_orderkey").alias("Order_ID"), text.alias("Order_Purchase_Timestamp")))


# the queries of the other catalogue modules register themselves here
from quarry.plans import catalog_files, catalog_time  # noqa: E402, F401
