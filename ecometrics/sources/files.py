"""Delimited, line and JSON files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecometrics.functions.calendar import parsed_day
from ecometrics.functions.text import clean_text, trimmed
from ecometrics.sources.schemas import Source

REJECTED = "_rejected_line"
PYTHON_LITERALS = {"None": "null", "True": "true", "False": "false"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header line; without a schema the types are inferred (one more pass over the file)."""
    reader = spark.read.option("header", True).option("escape", '"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_source(
    spark: SparkSession, path: str, source: Source, key: str | None = None, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected lines) of a source file, all columns as text."""
    return split_malformed(read_lines(spark, path, source, header), key)


def read_lines(spark: SparkSession, path: str, source: Source, header: bool = True) -> DataFrame:
    """All lines of a source file as text columns, with the whole line where it has another shape."""
    schema = T.StructType([*source.schema.fields, T.StructField(REJECTED, T.StringType())])
    # Without column pruning every line is held against the whole schema, whatever is selected later.
    return (
        spark.read.option("header", header)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED)
        .option("columnPruning", False)
        .schema(schema)
        .csv(path)
    )


def is_malformed(key: str | None = None) -> Column:
    """Wrong shape, or no key.  On ``read_lines``, which one pass over the file can count, split or write by it."""
    broken = F.col(REJECTED).isNotNull()
    return broken if key is None else broken | F.col(key).isNull()


def split_malformed(lines: DataFrame, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Part well-formed rows from quarantined ones; each of the two reads the file."""
    return lines.filter(~is_malformed(key)).drop(REJECTED), lines.filter(is_malformed(key))


def read_json_glob(
    spark: SparkSession, glob: str, schema: T.StructType, key: str | None = None, snapshot: str | None = None
) -> DataFrame:
    """One JSON object per line over many dated files (``<name>_<date>.json``).

    ``snapshot="latest"`` keeps, per key, the object of the file with the
    greatest date; an aggregation, so a key with many files is folded before
    the shuffle.
    """
    rows = spark.read.schema(schema).json(glob)
    if snapshot is None:
        return rows
    if snapshot != "latest" or key is None:
        raise ValueError("a snapshot is 'latest' and needs a key")
    whole = F.struct(*[F.col(c) for c in rows.columns])
    dated = rows.select(F.col(key).alias("__key"), whole.alias("__row"), file_date().alias("__date"))
    newest = dated.groupBy("__key").agg(F.max(F.struct("__date", "__row")).alias("__best"))
    return newest.select("__best.__row.*")


def file_date() -> Column:
    """The date in the name of the file (or folder of part files) a row comes from."""
    return parsed_day(F.regexp_extract(F.input_file_name(), r"_(\d{4}-\d{2}-\d{2})\.json", 1))


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """One symbol per line; blank lines are dropped."""
    lines = spark.read.text(path).select(trimmed("value").alias("symbol"))
    return lines.filter(F.length("symbol") > 0)


def read_quoted_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Lines holding records in Python notation (single quotes, None), as rows of ``schema``."""
    lines = spark.read.text(path)
    text = F.col("value")
    for word, literal in PYTHON_LITERALS.items():
        text = F.regexp_replace(text, rf"([:\[,]\s*){word}(?=\s*[,}}\]])", rf"$1{literal}")
    options = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
    parsed = F.from_json(text, schema, options)
    return lines.filter(clean_text("value").isNotNull()).select(parsed.alias("record")).select("record.*")
