"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import checkpoint_dir

#: words of the two tokenising rules, as patterns for SQL and tests
SPACE_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: the second rule before lower-casing
RAW_ALNUM_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: byte table of the second rule: A-Z lower-cased, other ASCII but letters and digits to space
ALNUM_BYTES = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 32
               for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors this package (``addPyFile``, once per application), so
    that functions are imported by the Python workers and may keep per-worker
    caches; nothing has to be installed on the cluster."""
    sc = spark.sparkContext
    if getattr(sc, "_quarry_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="quarry-code-"), "quarry_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(root, "quarry")):
            for n in names:
                if n.endswith((".py", ".txt")):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._quarry_shipped = True


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name below ``spark.checkpoint.dir`` (shared by driver and
    executors), as a URI.  Raises if the session names no such folder."""
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = "file://" + base.removeprefix("file:").removeprefix("//")
    elif "://" not in base:  # as in a session whose context has not resolved it
        base = "file://" + os.path.abspath(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: the lineage is cut, the
    work is done once, and the rows outlive any executor."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_order(df: DataFrame) -> list[Column]:
    """The order in which the rows of a Parquet folder written by Spark were written: the number of the file, then the
    place in it.  For rows that come from elsewhere, that of the partitions."""
    try:
        place = [F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1), F.col("_metadata.row_index")]
        df.select(*place)
    except AnalysisException:
        return [F.monotonically_increasing_id()]
    # a name without a number, as other writers give them, orders by itself
    return [F.coalesce(place[0].try_cast("long"), F.lit(-1).cast("long")),
            F.col("_metadata.file_path"), place[1]]


def fresh(columns: Iterable[str], name: str) -> str:
    """A column name that does not clash with ``columns`` (case-insensitive)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def crc_mod(column: Column, m: int) -> Column:
    """crc32 of the id written as text, modulo ``m``; null ids give null."""
    return F.crc32(column.cast("string").cast("binary")) % m


def space_words(text: str | bytes | None) -> list[bytes]:
    """Words between ASCII white space as UTF-8, A-Z lower-cased.  (``bytes.lower``
    and ``bytes.split`` know ASCII only, which is the rule.)"""
    return _bytes(text).lower().split()


def alnum_words(text: str | bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters as UTF-8, A-Z lower-cased."""
    return _bytes(text).translate(ALNUM_BYTES).split()


def _bytes(text: str | bytes | None) -> bytes:
    return text.encode() if isinstance(text, str) else text or b""


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """The texts of a batch as UTF-8 bytes."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def small_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches, each with at most ``limit`` bytes in ``column`` (or
    one row), so that memory does not follow the number of rows in a batch."""
    for b in batches:
        sizes = b.column(column)
        lengths = np.asarray(pc.fill_null(pc.binary_length(sizes), 0)).astype(np.int64)
        ends = np.cumsum(lengths)
        start = 0
        while start < b.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield b.slice(start, stop - start)
            start = stop
