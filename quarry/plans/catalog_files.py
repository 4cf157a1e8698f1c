"""Registered queries that go through files: the tables are written by the library's
writers to a new folder beside the checkpoints, and read back by its readers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans import reviews as V
from quarry.plans.catalog import DOC_STOP_WORDS, FREQUENT_THRESHOLD, _stop_sql, _texts, _TOKENS, register
from quarry.session import checkpoint_dir
from quarry.sinks.text import write_delimited, write_kv_text, write_outputs
from quarry.sinks.versions import current, publish
from quarry.sources.csv import read_csv
from quarry.sources.delimited import read_delimited, read_wordlist
from quarry.sources.infer import read_inferred
from quarry.sources.tables import table


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _word_file(spark: SparkSession, words: list[str]) -> str:
    """The words as a text file, one to a line."""
    path = _folder(spark, "stopwords")
    spark.range(1).select(F.explode(F.array(*map(F.lit, words))).alias("value")).write.text(path)
    return path


@register("q_frequent_words_stored", f"""
WITH t AS (SELECT doc_id, {_TOKENS} AS word FROM documents)
SELECT word, COUNT(doc_id) AS word_count FROM t
WHERE NOT EXISTS (SELECT 1 FROM {_stop_sql()} WHERE stop.stopword = t.word) AND word NOT LIKE '%;%' AND word NOT LIKE '%' || chr(10) || '%'
      AND word NOT LIKE '%' || chr(13) || '%'
GROUP BY word HAVING COUNT(doc_id) > {FREQUENT_THRESHOLD}
""")
def q_frequent_words_stored(spark: SparkSession, d: str) -> DataFrame:
    """N6 written as (id; word) lines, then N7 on the lines read back (S4, S5, K2), with the lines published twice
    as versions of one output (K3).  Words with the separator or a line break in them do not fit such lines."""
    stop = read_wordlist(spark, _word_file(spark, DOC_STOP_WORDS))
    clean = V.clean_tokens(_texts(spark, d, "doc_id", "text"), stop, id_col="doc_id", text_col="text").where(~F.col("word").rlike("[;\\r\\n]"))
    path = _folder(spark, "clean-words")
    # a first, short version, which the second replaces
    publish(spark, path, lambda folder: write_delimited(clean.where("doc_id % 10 = 0"), folder, sep=";"))
    publish(spark, path, lambda folder: write_delimited(clean, folder, sep=";"))
    return V.frequent_words(read_delimited(spark, current(spark, path), columns=("id", "word")), FREQUENT_THRESHOLD)


@register("q_review_outputs", f"""
WITH t AS (SELECT doc_id, {_TOKENS} AS word FROM documents)
SELECT 'frequent_words' AS output, word AS value, COUNT(doc_id) AS total FROM t
WHERE NOT EXISTS (SELECT 1 FROM {_stop_sql()} WHERE stop.stopword = t.word)
GROUP BY word HAVING COUNT(doc_id) > {FREQUENT_THRESHOLD}
UNION ALL SELECT 'per_category', source, COUNT(DISTINCT doc_id) FROM documents GROUP BY source
UNION ALL SELECT 'per_aspect', lang, COUNT(DISTINCT doc_id) FROM documents GROUP BY lang
""")
def q_review_outputs(spark: SparkSession, d: str) -> DataFrame:
    """N7, N8 and N9 from one scan of the texts (K6)."""
    stop = spark.range(1).select(F.explode(F.array(*map(F.lit, DOC_STOP_WORDS))).alias("stopword"))
    return V.review_outputs(_texts(spark, d, "doc_id", "text", "source", "lang"), stop, FREQUENT_THRESHOLD, "doc_id", "text", "source", "lang")


@register("q_docs_per_label_outputs", """
SELECT 'source' AS output, source AS value, COUNT(*) AS n FROM documents GROUP BY source
UNION ALL SELECT 'lang', lang, COUNT(*) FROM documents GROUP BY lang
""")
def q_docs_per_label_outputs(spark: SparkSession, d: str) -> DataFrame:
    """Two outputs written by one job into folders of their own, and read back (K6)."""
    docs = table(spark, d, "documents")
    marked = docs.select(F.inline(F.array(*[F.struct(F.lit(c).alias("output"), F.col(c).alias("value")) for c in ("source", "lang")])))
    path = _folder(spark, "outputs")
    write_outputs(marked.groupBy("output", "value").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.schema("value string, n long, output string").csv(path).select("output", "value", "n")


@register("q_part_stats_csv", """
SELECT p_brand, COUNT(*) AS n, CAST(SUM(p_size) AS BIGINT) AS total_size, MAX(p_retailprice) AS max_price,
       MIN(TIMESTAMP '1992-01-01' + to_days(p_size)) AS first_day FROM part GROUP BY p_brand
""")
def q_part_stats_csv(spark: SparkSession, d: str) -> DataFrame:
    """The parts as a headered ';' CSV file, read back with inferred types (S7): sums, maxima and dates need them right."""
    path = _folder(spark, "part-csv")
    day = (F.lit("1992-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("p_size")))
    table(spark, d, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice", F.date_format(day, "yyyy-MM-dd HH:mm:ss").alias("made")) \
        .write.option("header", "true").option("sep", ";").csv(path)
    parts = read_csv(spark, path, infer=True)
    kinds = dict(parts.dtypes)
    if (kinds["p_size"], kinds["p_retailprice"], kinds["made"]) not in {("int", "double", "timestamp"), ("int", "double", "timestamp_ntz")}:
        raise TypeError(f"inferred as {kinds}")
    return parts.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("total_size"), F.max("p_retailprice").alias("max_price"),
                                        F.min(F.col("made").cast("timestamp_ntz")).alias("first_day"))


@register("q_parts_kv_lines", """
SELECT p_brand || chr(9) || 'parts: ' || CAST(COUNT(*) AS VARCHAR) AS line FROM part GROUP BY p_brand
""")
def q_parts_kv_lines(spark: SparkSession, d: str) -> DataFrame:
    """Key TAB value lines written sorted (K1) and read back."""
    path = _folder(spark, "kv")
    write_kv_text(table(spark, d, "part").groupBy("p_brand").count(), "p_brand", F.concat(F.lit("parts: "), F.col("count").cast("string")), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@register("q_orders_csv_merged", """
SELECT o_orderpriority, COUNT(*) AS n, COUNT(o_custkey) AS n_customers, CAST(SUM(ROUND(o_totalprice * 100)) AS BIGINT) AS cents,
       MIN(o_orderdate) AS first_day
FROM (SELECT o_custkey, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority, o_totalprice, o_orderdate
      FROM (SELECT * REPLACE (CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS o_custkey) FROM orders)) GROUP BY 1
""")
def q_orders_csv_merged(spark: SparkSession, d: str) -> DataFrame:
    """The orders as CSV files of two layouts (customers in one half, priorities in the other), read as one table with
    types inferred in one pass."""
    path = _folder(spark, "orders-csv")
    orders = table(spark, d, "orders")
    orders.where("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate") \
        .write.option("header", "true").option("sep", ";").csv(f"{path}/a")
    orders.where("o_orderkey % 2 = 1").select("o_orderdate", "o_orderpriority", "o_totalprice", "o_orderkey") \
        .write.option("header", "true").option("sep", ";").csv(f"{path}/b")
    read = read_inferred(spark, [f"{path}/a", f"{path}/b"])
    return read.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.count("o_custkey").alias("n_customers"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"), F.min(F.col("o_orderdate").cast("timestamp_ntz")).alias("first_day"))
