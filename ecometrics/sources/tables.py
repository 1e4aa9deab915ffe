"""Table sinks and read-back."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecometrics.operators.joins import not_yet_in
from ecometrics.operators.ranking import first_per_class
from ecometrics.sources import versions


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Gather the rows of a folder, so that not every task writes a file into every folder.

    Rebalancing lets adaptive execution split a hot folder over several tasks.
    """
    return df.hint("rebalance", *[F.col(name) for name in partition_by]) if partition_by else df


def publishing(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> Iterator[str]:
    """The steps of ``publish``: a caller that stops after any of them leaves a readable table."""
    files, state = versions.Files(df.sparkSession, path), versions.current(df.sparkSession, path)
    folder = versions.new_folder(state)
    try:
        balanced(df, partition_by).write.partitionBy(*partition_by).parquet(f"{files.root}/{folder}")
    except Exception:
        files.delete(folder)
        raise
    yield "written"
    yield from versions.committing(files, versions.State(state.number + 1, (folder,), stored_schema(df, partition_by)))


def stored_schema(df: DataFrame, partition_by: Sequence[str]) -> T.StructType:
    """As Spark reads it back: everything may be NULL, and the columns of the folders come last."""
    fields = [T.StructField(f.name, f.dataType) for f in df.schema.fields]
    return T.StructType([*(f for f in fields if f.name not in partition_by), *(f for f in fields if f.name in partition_by)])


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Replace the table at ``path``; publishing twice leaves one copy, a crash the old table or the new one.

    Read it with ``read_table``.  ``df`` may read the table that it replaces.
    """
    for _ in publishing(df, path, partition_by):
        pass
    return path


def publish_counted(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """``publish``, and how many rows were written, observed by the write itself."""
    observed = Observation()
    publish(df.observe(observed, F.count(F.lit(1)).alias("n")), path, partition_by)
    return observed.get["n"]


def accumulate(
    fresh: DataFrame, path: str, key: str, schema: T.StructType, buckets: int = 64, most_folders: int = 64
) -> DataFrame:
    """Add rows with new keys to the table at ``path``; the same batch twice changes nothing.

    Of fresh rows that share a key, the first in the order of the other columns is added; rows without a key are
    not, as they could never be found again.  The table lies in buckets by the hash of the key: a batch reads the
    keys of the buckets that it falls in and writes its new rows alone, into a folder of its own beside the others.  A
    table that was published whole is put into buckets once; after ``most_folders`` batches the folders are
    made one.
    """
    spark, files = fresh.sparkSession, versions.Files(fresh.sparkSession, path)
    state = versions.current(spark, path)
    if not state.buckets:
        before = spark.read.schema(schema).parquet(path) if not state.number else read_table(spark, path)
        state = _rebucketed(before.select(*schema.names), path, key, buckets)
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(state.buckets)).cast("int")
    keyed = fresh.filter(F.col(key).isNotNull()).select(*schema.names).withColumn(versions.BUCKET, bucket)
    touched = [row[0] for row in keyed.select(versions.BUCKET).distinct().collect()]  # at most ``buckets``
    before = versions.read(spark, path, state).filter(F.col(versions.BUCKET).isin(touched)).select(key)
    order = [F.col(c).asc_nulls_last() for c in schema.names if c != key]
    added = first_per_class(not_yet_in(keyed, before, key), [key], order or [F.col(key)])
    folder = versions.new_folder(state)
    try:
        balanced(added, [versions.BUCKET]).write.partitionBy(versions.BUCKET).parquet(f"{files.root}/{folder}")
    except Exception:
        files.delete(folder)
        raise
    if not any(name.startswith(f"{versions.BUCKET}=") for name in files.names(folder)):  # no new rows
        files.delete(folder)
        return read_table(spark, path)
    state = state._replace(number=state.number + 1, folders=(*state.folders, folder))
    for _ in versions.committing(files, state):
        pass
    if len(state.folders) > most_folders:
        _rebucketed(read_table(spark, path), path, key, state.buckets)
    return read_table(spark, path)


def _rebucketed(df: DataFrame, path: str, key: str, buckets: int) -> versions.State:
    """The whole table in one folder, in buckets by ``key``; rows without a key lie in a bucket like any other."""
    files, state = versions.Files(df.sparkSession, path), versions.current(df.sparkSession, path)
    folder, bucket = versions.new_folder(state), F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
    placed = df.withColumn(versions.BUCKET, bucket)
    try:
        balanced(placed, [versions.BUCKET]).write.partitionBy(versions.BUCKET).parquet(f"{files.root}/{folder}")
    except Exception:
        files.delete(folder)
        raise
    state = versions.State(state.number + 1, (folder,), stored_schema(df, ()), buckets)
    for _ in versions.committing(files, state):
        pass
    return state


def write_json(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    balanced(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).json(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a published table; other Parquet folders as they are."""
    state = versions.current(spark, path)
    if not state.number:
        return spark.read.parquet(path)
    return versions.read(spark, path, state).select(*state.schema.names)


def count_loaded(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Rows per table, all in one job."""
    counted = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    return {row["name"]: row["n"] for row in reduce(DataFrame.unionByName, counted).collect()}


def literal_table(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """A few inline rows.  They travel as Arrow, which tells Catalyst their size."""
    values = [dict(zip(columns, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(values))
