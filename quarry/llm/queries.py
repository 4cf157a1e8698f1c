"""The registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (conversations, decontaminate, licenses, maxent, mixing, negatives, neighbours, ppm, sharding, simhash, suffixes,
                        urls, wavelet)
from quarry.llm.common import table

#: fixed values: the tokenizer file's vocabulary size and the id that ends a document
TOKENIZER, VOCABULARY, END_ID = "word_bpe_49k.json", 49_408, 2

#: fixed values: the URL rules
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
             ("block", "net/fr/")]


def op1_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_shards(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), END_ID, VOCABULARY)


def op2_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op3_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("root")


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_url_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op8_pfair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """slot and place give the mixed order; a row comes once for each epoch of its source that reaches it."""
    return mixing.schedule(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")).drop("n_chars")


def op9_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ppm.identify(docs, ppm.learn(docs))


def op10_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.findings(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op11_gnat(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), label, F.col("vec_id") % 50 == 0)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 8)


QUERIES = {f.__name__: f for f in (op1_wavelet, op2_multiprobe, op3_maxent, op4_simhash, op5_suffixes, op6_licenses, op7_url_ratio, op8_pfair, op9_ppm, op10_automaton,
                                  op11_gnat, op12_prefix_trie, op13_kd_shards)}

#: words of the second tokenising rule in DuckDB (A-Z lower-cased; bytes above 0x7F are letters)
_WORDS_SQL = (r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

_OP10_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT cast(item_id AS varchar) AS item, {_WORDS_SQL.format("coalesce(text, '')")} AS w FROM benchmark),
bw AS (SELECT item, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s, w FROM b WHERE len(w) > 0),
grams AS (SELECT DISTINCT item, k, array_to_string(w[s : s + k - 1], ' ') AS gram FROM bw),
sizes AS (SELECT DISTINCT k FROM grams),
dw AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, sizes WHERE len(w) >= k),
places AS (SELECT doc_id, k, s, array_to_string(w[s : s + k - 1], ' ') AS gram FROM dw),
hits AS (SELECT p.doc_id, p.s, p.k, g.item FROM places p JOIN grams g ON p.k = g.k AND p.gram = g.gram),
words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
          FROM (SELECT doc_id, unnest(range(s, s + k)) AS pos FROM (SELECT DISTINCT doc_id, s, k FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, cast(len(d.w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

ORACLE_SQL: dict[str, str] = {"op6_licenses": licenses.oracle(_WORDS_SQL), "op10_automaton": _OP10_SQL, "op11_gnat": negatives.ORACLE,
                              "op12_prefix_trie": conversations.ORACLE}
