"""A training-data pipeline over ``documents``: language ID, SimHash near-dedup,
benchmark decontamination, mixing to target weights, token output.

Each stage is (spark, docs, sf_dir) -> DataFrame and works on all rows that its
predecessor kept; between stages ``run`` writes Parquet to the shared folder and
reads it back.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarry.llm import decontaminate, mixing, ppm, queries, simhash, wavelet
from quarry.llm.common import stored, stored_order, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a letter and is written in one of the learned languages."""
    return ppm.keep_identified(docs, ppm.learn(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row (the smallest doc_id) of each near-duplicate component."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark window: the coverage limit is zero, so a matched row goes as a whole."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), max_coverage=0.0)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in mixed order; small sources come again in further epochs, no row is dropped.  Written as Parquet, the rows keep
    their turns: files are numbered in the order of the partitions, and rows stand in a file as they came."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The wavelet shards' documents as read back; tokens are written in the order of the stored rows, so ``start`` follows the
    turns of the mixing stage."""
    return wavelet.token_shards(docs, public_tokenizers.path(queries.TOKENIZER), queries.END_ID, queries.VOCABULARY,
                                order=stored_order(docs))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mix", mix),
          ("tokens", tokens)]

#: SimHash components and tokenisation cannot be written in SQL; tests compare run() with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
