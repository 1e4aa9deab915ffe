"""Nested JSON documents keyed by symbol.

A document is one JSON text in column ``document``: the whole file when it was
read with ``read_documents``, or a row of any table.  Land large collections
as many documents; a single file is parsed by a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecometrics.sources.schemas import ERROR_KEYS

PAYLOADS = T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, for documents that spread over lines."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "document")


def explode_documents(df: DataFrame, section: T.DataType, root: str = "stocks") -> DataFrame:
    """``{root: {symbol: section}}`` to one row (symbol, section fields) per symbol."""
    shape = T.StructType([T.StructField(root, T.MapType(T.StringType(), section))])
    parsed = df.select(F.from_json("document", shape).alias("doc"))
    return parsed.select(F.explode(f"doc.{root}").alias("symbol", "section")).select("symbol", "section.*")


def explode_calendar(df: DataFrame, item: T.StructType, root: str = "ipo_calendar", items: str = "ipoCalendar") -> DataFrame:
    """``{root: {items: [...]}}``, the section beside the symbols, to one row per item; documents without any give none."""
    shape = T.StructType([T.StructField(root, T.StructType([T.StructField(items, T.ArrayType(item))]))])
    parsed = df.select(F.from_json("document", shape).alias("doc"))
    return parsed.select(F.explode(f"doc.{root}.{items}").alias("item")).select("item.*")


def explode_items(df: DataFrame, items: str) -> DataFrame:
    """One row per element of an array column; rows without elements stay."""
    rest = [c for c in df.columns if c != items]
    return df.select(*rest, F.explode_outer(items).alias("__item")).select(*rest, "__item.*")


def split_payloads(df: DataFrame, error_keys: Sequence[str] = ERROR_KEYS) -> tuple[DataFrame, DataFrame]:
    """``{symbol: payload}`` documents to (good, rejected) rows of symbol and payload map; each of the two reads ``df``."""
    rows = flag_payloads(df, error_keys)
    return rows.filter(~F.col("rejected")).drop("rejected"), rows.filter("rejected").drop("rejected")


def flag_payloads(df: DataFrame, error_keys: Sequence[str] = ERROR_KEYS) -> DataFrame:
    """(symbol, payload, rejected) in a single pass."""
    rows = df.select(F.explode(F.from_json("document", PAYLOADS)).alias("symbol", "payload"))
    return rows.withColumn("rejected", is_error("payload", error_keys))


def is_error(payload: str, error_keys: Sequence[str] = ERROR_KEYS) -> Column:
    return F.coalesce(F.arrays_overlap(F.map_keys(payload), F.array(*map(F.lit, error_keys))), F.lit(True))


def of_shape(df: DataFrame, schema: T.StructType, column: str = "document") -> DataFrame:
    """Fields of the documents that parse into ``schema``; anything else is dropped."""
    marked = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(column, marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    # Out of a generator, so that the test and the fields share one parse.
    rows = df.withColumn("__parsed", F.explode(F.array(parsed)))
    sound = rows.filter(F.col("__parsed").isNotNull() & F.col("__parsed._corrupt").isNull())
    kept = [c for c in df.columns if c != column]
    return sound.select(*kept, *[F.col(f"__parsed.{field.name}") for field in schema.fields])


def field(column: str, path: str, kind: str = "string") -> Column:
    """One field of a JSON text, NULL when absent or not of that type."""
    return F.get_json_object(column, path).try_cast(kind)
