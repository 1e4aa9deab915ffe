"""Session settings and the shared scratch folder.

Intermediate results that are read more than once are written as Parquet
tables below ``spark.checkpoint.dir``.  Compared with an in-memory cache they
survive the loss of executors, and compared with ``checkpoint()`` they keep
column pruning and tell Catalyst their true size, so it broadcasts a written
side only while it is below ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

PARTITION_BYTES = 256 * 1024 * 1024


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of the files below the paths, as their own file system tells it; a missing path counts nothing."""
    total = 0
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        total += files.getContentSummary(place).getLength() if files.exists(place) else 0
    return total


def tune(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the run-time SQL settings the operators count on.

    With the size of the input given, shuffles start from as many partitions
    as keep one at ``PARTITION_BYTES``; adaptive execution merges small ones.
    """
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    if input_bytes is not None:
        current = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set("spark.sql.shuffle.partitions", str(max(current, -(-input_bytes // PARTITION_BYTES))))
    return spark


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, removed when the session ends.

    Without that setting it lies in the warehouse, which executors share too.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    root = f"{(shared or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/scratch-{context.applicationId}"
    if root not in _roots:
        place = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        files.mkdirs(place)
        files.deleteOnExit(place)
        _roots.add(root)
    return root


_roots: set[str] = set()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write ``df`` once to the scratch folder and go on from the written table."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
