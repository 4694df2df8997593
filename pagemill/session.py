"""Spark session and run-wide settings.

Cluster jobs get their session from the launcher; ``get_spark`` only fills in
settings that are unset, so a cluster's own values (shuffle partitions,
checkpoint dir, memory, ...) always win.  No operator depends on these.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# AQE re-plans joins at runtime (broadcast when a side turns out small, split
# skewed partitions); all of this is on in a default session as well.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "pagemill", shuffle_partitions: int | None = None,
              driver_memory: str = "16g") -> SparkSession:
    """A session; arguments and defaults apply only to what the launcher left unset."""
    given = SparkConf()
    want = DEFAULT_CONF | {"spark.app.name": app, "spark.driver.memory": driver_memory}
    if master:
        want["spark.master"] = master
    if shuffle_partitions:
        want["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder
    for k, v in want.items():
        if not given.contains(k):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for tables between jobs: ``spark.checkpoint.dir``, or the one set on the context.

    Where neither is set, a session in one local process gets a scratch folder
    of its own; on a cluster that is an error, since executors would each
    write to their own disk.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="pagemill-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read again: readers prune columns, a lost executor reads anew."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex[:16]}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
