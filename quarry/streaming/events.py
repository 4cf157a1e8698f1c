"""Event-time statistics over a growing folder of event files, with late data.

Windows and sessions close when the watermark (the latest event time seen, less
the allowed lateness) has passed them, and come out once.  Events later than that
are dropped.  Output is keyed by the micro-batch that closed it: a batch that is
run again after a failure replaces its own folder, so nothing comes twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quarry.session import checkpoint_dir


def event_stream(spark: SparkSession, directory: str, schema: StructType | str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Every Parquet file that appears in ``directory``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(directory)


def _exact(value: str, scale: int):
    return F.col(value).cast(f"decimal(18,{scale})")


def window_stats(events: DataFrame, time: str, by: Sequence[str], value: str, width: str, late: str, slide: str | None = None,
                 scale: int = 2) -> DataFrame:
    """``by``, starts, ends, n, total, low and high of the values in each window of ``width`` (every ``slide``).
    Works on a stream and on a table alike; on a table nothing is late."""
    if events.isStreaming:
        events = events.withWatermark(time, late)
    spans = F.window(time, width, slide) if slide else F.window(time, width)
    out = events.groupBy(spans.alias("span"), *by).agg(F.count(value).alias("n"), F.sum(_exact(value, scale)).alias("total"),
                                                       F.min(value).alias("low"), F.max(value).alias("high"))
    return out.select(*by, F.col("span.start").alias("starts"), F.col("span.end").alias("ends"), "n", "total", "low", "high")


def sessions(events: DataFrame, time: str, by: Sequence[str], gap: str, late: str) -> DataFrame:
    """``by``, starts, ends and n of each session: events of the same ``by`` less than ``gap`` apart.  The state of an open
    session is kept until the watermark has passed its end; sessions that a late event joins become one."""
    if events.isStreaming:
        events = events.withWatermark(time, late)
    out = events.groupBy(F.session_window(time, gap).alias("span"), *by).agg(F.count(F.lit(1)).alias("n"))
    return out.select(*by, F.col("span.start").alias("starts"), F.col("span.end").alias("ends"), "n")


def start_by_batch(result: DataFrame, out_dir: str, name: str, available_now: bool = True, processing_time: str = "30 seconds",
                   after_write: Callable[[int], None] | None = None) -> StreamingQuery:
    """Append what each micro-batch closes to ``out_dir``, in a folder of its own that a repeated batch replaces.
    ``after_write`` is called before the batch is committed (for tests and notifications).  The checkpoint lies under the
    session's shared checkpoint folder; a query of the same name goes on where it stopped."""
    spark = result.sparkSession
    place = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch={number}")
        if after_write is not None:
            after_write(number)

    writer = result.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", place).queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def closed(spark: SparkSession, out_dir: str) -> DataFrame:
    """All that has been closed so far."""
    return spark.read.parquet(out_dir).drop("batch")
