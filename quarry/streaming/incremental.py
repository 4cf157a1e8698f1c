"""Incrementally maintained statistics over a directory of input files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.functions.numeric import lossless, ratio, total
from quarry.functions.text import PIG_DELIMITERS, explode_tokens
from quarry.operators.joins import ORDER, anti_join_words, unique_dimension
from quarry.session import checkpoint_dir, materialize
from quarry.sources.ratings_text import JAVA, parse_ratings


def rating_lines_stream(spark: SparkSession, directory: str, dialect: str = JAVA,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Parsed ratings from every text file that appears in ``directory``."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_ratings(reader.format("text").load(directory), dialect)


def review_lines_stream(spark: SparkSession, directory: str, sep: str = ";",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Review rows (id, comment, dim3, dim4, sentiment) from every ';' file
    that appears in ``directory`` (same reading rules as the batch reader)."""
    from quarry.sources.delimited import REVIEW_COLUMNS
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    schema = ", ".join(f"{c} string" for c in REVIEW_COLUMNS)
    return (reader.schema(schema).option("sep", sep).option("quote", "\u0000").option("escape", "\u0000")
            .option("mode", "PERMISSIVE").option("header", "false").csv(directory))


def running_item_stats(ratings: DataFrame, items: DataFrame, item_key: str = "movie_id",
                       title: str = "title", rating: str = "rating", scale: int = 2) -> DataFrame:
    """Streaming N1: per title avg_rating and n_ratings, maintained as new
    ratings arrive (stream-static inner join, single aggregation)."""
    if ORDER in items.columns:  # the last row of an id wins; fixed once, before the stream starts
        items = materialize(unique_dimension(items, item_key, [title]))
    joined = ratings.where(F.col(rating).isNotNull()).join(items.select(item_key, title), item_key)
    exact, rest = lossless(rating, joined.schema[rating].dataType, scale)
    agg = joined.groupBy(title).agg(F.sum(exact).alias("_sum"), F.sum(rest).alias("_rest"), F.count(rating).alias("n_ratings"))
    return agg.select(title, ratio(total("_sum", "_rest"), "n_ratings").alias("avg_rating"), "n_ratings")


def running_word_counts(reviews: DataFrame, stop: DataFrame, id_col: str = "id", text_col: str = "comment",
                        stop_col: str = "stopword", threshold: int | None = None,
                        delimiters: str = PIG_DELIMITERS) -> DataFrame:
    """Streaming N6+N7: non-stop word counts (rows with a null id are not
    counted), optionally only those above ``threshold``."""
    words = anti_join_words(explode_tokens(reviews, [id_col], text_col, delimiters), stop, "word", stop_col)
    counts = words.groupBy("word").agg(F.count(id_col).alias("word_count"))
    return counts.where(F.col("word_count") > threshold) if threshold is not None else counts


def start_snapshots(result: DataFrame, out_dir: str, name: str, available_now: bool = True,
                    processing_time: str | None = None) -> StreamingQuery:
    """Run an aggregating stream in complete mode; after each micro-batch the
    full current result replaces the parquet snapshot in ``out_dir``.  The
    checkpoint goes under the session's (shared) checkpoint folder."""
    spark = result.sparkSession
    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"

    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out_dir)

    writer = (result.writeStream.outputMode("complete").foreachBatch(write)
              .option("checkpointLocation", ckpt).queryName(name))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time or "30 seconds")
    return writer.start()
