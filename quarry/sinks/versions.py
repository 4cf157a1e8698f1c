"""Overwriting an output without a moment in which it is gone.

An output folder holds versions and a manifest.  A new version is written beside
the old ones; then the manifest is replaced by one rename, which is the moment of
publication.  Readers follow the manifest, so they see the old version or the new
one, whole; a job that fails on the way leaves the old one as it was.  One writer
at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

MANIFEST = "_versions"


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of the path, so that any store that Spark writes to will do."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(conf), hadoop


def versions(spark: SparkSession, path: str) -> list[str]:
    """The published version folders, the current one first; none if nothing was published."""
    fs, hadoop = _files(spark, path)
    manifest = hadoop.Path(path, MANIFEST)
    if not fs.exists(manifest):
        return []
    stream = fs.open(manifest)
    try:
        text = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
    return text.split()


def current(spark: SparkSession, path: str) -> str:
    """The folder to read."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no published version in {path}")
    return f"{path}/{found[0]}"


def publish(spark: SparkSession, path: str, write: Callable[[str], None], keep: int = 1) -> str:
    """Let ``write`` fill a new folder, then make it the current version.  ``keep``
    earlier versions stay for those who still read them; older ones are removed."""
    path = path.rstrip("/")
    fs, hadoop = _files(spark, path)
    name = f"v-{uuid.uuid4().hex}"
    write(f"{path}/{name}")
    if not fs.exists(hadoop.Path(path, name)):
        raise FileNotFoundError(f"nothing was written to {path}/{name}")
    old = versions(spark, path)
    kept, gone = [name, *old[:keep]], old[keep:]
    private = hadoop.Path(path, f"{MANIFEST}.{uuid.uuid4().hex}")
    stream = fs.create(private)
    try:
        stream.write(bytearray("\n".join(kept).encode()))
    finally:
        stream.close()
    options = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(private.toUri() if private.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration()) \
        .rename(fs.makeQualified(private), fs.makeQualified(hadoop.Path(path, MANIFEST)), options)
    for v in gone:
        fs.delete(hadoop.Path(path, v), True)
    return f"{path}/{name}"
