"""Session helpers.

Library code never changes session settings behind the caller's back; these
helpers are for scripts, tests and the benchmark.  ``checkpoint_dir`` reads the
cluster's ``spark.checkpoint.dir``, so lineage cuts land in shared storage; it
never makes a folder of its own.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings that matter at any scale.  AQE re-plans joins from runtime sizes
# (broadcast only when the *measured* side is small), coalesces small shuffle
# partitions and splits skewed ones.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "quarry", extra: dict[str, str] | None = None) -> SparkSession:
    """Session with ``BASE_CONF``.  By default the master and the shuffle sizing
    are those the launcher configured (``spark-submit --master ...``);
    ``local[*]`` is used only when no launcher set a master."""
    builder = SparkSession.builder.appName(app)
    if master is None and "PYSPARK_GATEWAY_PORT" not in os.environ:
        # not started by a launcher (spark-submit, pyspark shell) that already
        # created the JVM with its master: run locally
        master = "local[*]"
    if master is not None:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder named in ``spark.checkpoint.dir`` (or set on the
    context), which driver and executors share.  Raises if there is none: a
    folder invented here would be another one on every machine."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the server's setting applies
        sc = None
    current = (sc.getCheckpointDir() if sc is not None else None) or configured
    if not current:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc is None:
        return current
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir()  # resolved against the cluster's file system


def materialize(df):
    """Reliable checkpoint of ``df`` in the shared checkpoint folder (eager):
    later branches that read the result see exactly the same rows and
    partitions, lineage is cut, and the data survives executor loss (unlike a
    cache or a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
