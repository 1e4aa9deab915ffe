"""What the operators share: text batches, distributed heavy hitters, connected components.

A *word* is a run of bytes other than blank and ``\\t``-``\\r``; ``bytes.split()``
cuts exactly there.  Workers get whole texts as Arrow batches of bounded rows.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ecometrics.session import input_bytes, settle, tune

WORD = "[^\\x20\\x09-\\x0D]+"
BATCH_ROWS, BATCH_BYTES = 512, 32 * 1024 * 1024


PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings the operators count on; batches stay small although texts may be long.

    Workers get the place of this package on their path, wherever the driver was started from.
    """
    tune(spark)
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if PACKAGE_ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [PACKAGE_ROOT, known]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


_worker: dict = {}


def worker_state(owner: str) -> dict:
    """What an operator keeps in a worker from task to task; another operator that starts there lets go of it."""
    if _worker.get("owner") != owner:
        _worker.clear()
        _worker.update(owner=owner, state={})
    return _worker["state"]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """The table of documents; shuffles are as wide as its size asks for, texts being stored compressed."""
    path = f"{folder}/documents.parquet"
    tune(prepared(spark), 4 * input_bytes(spark, path))
    return spark.read.parquet(path)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8; null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def training_row(id_col: str, divisor: int, remainder: int):
    """crc32 of the id as text is not in the held-out class; a null id hashes the empty text."""
    return held_out(id_col, divisor, remainder) == F.lit(False)


def held_out(id_col: str, divisor: int, remainder: int):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % divisor == remainder


class Summary:
    """A mergeable frequent-items summary (Misra and Gries).

    It keeps at most ``capacity`` items after ``shrink``; each count is short of the
    true one by at most total / capacity, so no item above that share is ever missed.
    """

    def __init__(self, capacity: int):
        self.capacity, self.counts = capacity, Counter()

    def update(self, items) -> None:
        self.counts.update(items)
        if len(self.counts) > 16 * self.capacity:
            self.shrink()

    def shrink(self) -> None:
        if len(self.counts) > self.capacity:
            cut = sorted(self.counts.values(), reverse=True)[self.capacity]
            self.counts = Counter({k: v - cut for k, v in self.counts.items() if v > cut})

    def row(self) -> tuple[list, list]:
        self.shrink()
        kept = sorted(self.counts.items())
        return [k for k, _ in kept], [v for _, v in kept]


def frequent_items(texts_df: DataFrame, split: Callable[[str], list[str]], capacity: int) -> list[str]:
    """The items of all texts that carry the most occurrences, most frequent first.

    Every text is read.  A task sends one summary of at most ``capacity`` items, whatever its
    share of the data; summaries are merged in two steps, and one of that size reaches the driver.
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("summaries")
        summary = Summary(capacity)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    summary.update(split(text))
        items, counts = summary.row()
        yield pa.RecordBatch.from_pydict(
            {"items": pa.array([items], pa.list_(pa.string())), "counts": pa.array([counts], pa.list_(pa.int64()))}
        )

    def merge(_, table: pa.Table) -> pa.Table:
        summary = Summary(capacity)
        for items, counts in zip(table.column("items").to_pylist(), table.column("counts").to_pylist()):
            summary.update(dict(zip(items, counts)))
        items, counts = summary.row()
        return pa.table({"items": pa.array([items], pa.list_(pa.string())), "counts": pa.array([counts], pa.list_(pa.int64()))})

    schema = "items array<string>, counts array<bigint>"
    parts = texts_df.mapInArrow(summarise, schema)
    groups = max(1, round(texts_df.rdd.getNumPartitions() ** 0.5))
    for key in (F.spark_partition_id() % groups, F.lit(0)):
        parts = parts.withColumn("part", key).groupBy("part").applyInArrow(
            lambda k, t: merge(k, t.select(["items", "counts"])), schema
        )
    merged = parts.first()
    if merged is None:
        return []
    return [k for k, _ in sorted(zip(merged["items"], merged["counts"]), key=lambda x: (-x[1], x[0]))]


def components(edges: DataFrame, limit: int = 100) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node it is connected with.

    Each round takes the least root among neighbours and then follows the root's own root, so
    the distance covered doubles; every round is written, which cuts the lineage for good.
    """
    both = settle(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    roots = settle(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("root")), "roots")
    for _ in range(limit):
        near = (
            both.join(roots.withColumnRenamed("node", "a"), "a")
            .groupBy(F.col("b").alias("node")).agg(F.min("root").alias("near"))
        )
        lower = settle(
            roots.join(near, "node").select("node", F.least("root", "near").alias("root"), F.col("root").alias("old")), "lower"
        )
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = settle(
            lower.join(jump, "root", "left").select("node", F.least("root", F.coalesce("next", "root")).alias("root"), "old"),
            "roots",
        )
        if jumped.where(F.col("root") != F.col("old")).isEmpty():
            return jumped.select("node", "root")
        roots = jumped.select("node", "root")
    raise RuntimeError(f"components not settled after {limit} rounds")
