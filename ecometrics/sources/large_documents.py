"""One nested JSON document of any size, ``{root: {symbol: {...}, ...}, ...}``, read by many tasks.

Spark's text source cuts a file at any character, so ``}`` as the line separator gives pieces that are read by byte
ranges in parallel, indented or not.  What a piece means depends on what lies before it: whether it begins inside a
string, and how deep.  Both are prefix sums, of quotes and of brackets outside strings, which are taken in two
levels: within a byte range where the pieces lie, and over the ranges, of which there are few.  A piece that ends at
depth 2 completes an entry; the pieces of an entry meet, and each entry is parsed on its own.  No task ever holds more
than a range or an entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecometrics.session import settle

PLACE = ["__file", "__block", "__at"]  # in document order
# Keys at the top that hold plain values are passed over, then the root's own key opens an object.
KEY = r'"((?:[^"\\]|\\.)*+)"\s*:\s*'
OPENING = r'^\s*\{?\s*,?\s*(?:"(?:[^"\\]|\\.)*+"\s*:\s*(?:"(?:[^"\\]|\\.)*+"|[^\s"{\[\],]++)\s*,\s*)*+' + KEY + r"\{"


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, text): what lies between closing braces, without them, placed by byte range and row."""
    rows = spark.read.option("lineSep", "}").text(path)
    meta = F.col("_metadata")
    return rows.select(
        meta["file_path"].alias("__file"), meta["file_block_start"].alias("__block"), F.monotonically_increasing_id().alias("__at"), F.col("value").alias("__text"),
    )


def with_total_before(df: DataFrame, amounts: dict[str, Column], label: str) -> DataFrame:
    """``df``, written, with the sum of each amount over all earlier pieces of the file."""
    df = settle(df.withColumns({f"__of_{name}": amount for name, amount in amounts.items()}), label)
    inside = Window.partitionBy("__file", "__block").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = df.groupBy("__file", "__block").agg(*[F.sum(f"__of_{name}").alias(f"__sum_{name}") for name in amounts])
    starts = ranges.select(
        F.col("__file").alias("__in"), F.col("__block").alias("__from"),
        *[F.coalesce(F.sum(f"__sum_{name}").over(across), F.lit(0)).alias(f"__start_{name}") for name in amounts],
    )
    starts = settle(starts, "ranges")
    placed = df.withColumns({name: F.coalesce(F.sum(f"__of_{name}").over(inside), F.lit(0)) for name in amounts})
    met = placed.join(starts, (F.col("__file") == F.col("__in")) & (F.col("__block") == F.col("__from")))
    return met.select(*df.columns, *[(F.col(name) + F.col(f"__start_{name}")).alias(name) for name in amounts])


def count_of(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def entries(spark: SparkSession, path: str) -> DataFrame:
    """(file, root, entry): the text of every entry below every root, ``"symbol": {...}`` with what lies before it."""
    plain = F.regexp_replace("__text", r"\\.", "")  # an escaped character is neither a quote nor a brace
    quoted = with_total_before(pieces(spark, path).withColumn("__plain", plain), {"__quotes": count_of(F.col("__plain"), '"')}, "pieces")
    opened = F.concat(F.when(F.col("__quotes") % 2 == 1, '"').otherwise(""), F.col("__plain"))
    bare = F.regexp_replace(opened, '"[^"]*+("|$)', "")
    # The closing brace after the piece counts unless it belongs to a string.
    closes = (F.col("__quotes") + F.col("__of___quotes")) % 2 == 0
    depth = count_of(F.col("__bare"), "{[") - count_of(F.col("__bare"), "]") - F.col("__closes").cast("int")
    steps = quoted.withColumns({"__bare": bare, "__closes": closes}).select(*PLACE, "__text", "__closes", depth.alias("__step"))
    deep = with_total_before(steps, {"__depth": F.col("__step")}, "depths")
    after = F.col("__depth") + F.col("__step")
    ends = {"__entry": (F.col("__closes") & (after <= 2)).cast("int"), "__root": (F.col("__closes") & (after <= 1)).cast("int")}
    placed = with_total_before(deep.withColumn("__after", after), ends, "entries")
    # The brace that closes an entry is the entry's own, the one that closes its root is not.
    text = F.concat("__text", F.when(F.col("__closes") & (F.col("__after") < 2), "").otherwise("}"))
    parts = F.array_sort(F.collect_list(F.struct("__block", "__at", text.alias("text"))))
    grouped = placed.filter(F.col("__depth") + F.col("__step") >= 1).groupBy("__file", "__root", "__entry").agg(
        F.array_join(F.transform(parts, lambda x: x["text"]), "").alias("__text"), F.min_by("__depth", F.struct("__block", "__at")).alias("__depth")
    )
    grouped = settle(grouped, "entries")
    first = grouped.filter(F.col("__depth") < 2)
    names = settle(first.select(F.col("__file").alias("__in"), F.col("__root").alias("__of"), F.regexp_extract("__text", OPENING, 1).alias("root")), "roots")
    named = grouped.join(names, (F.col("__file") == F.col("__in")) & (F.col("__root") == F.col("__of")))
    inner = F.when(F.col("__depth") < 2, F.regexp_replace("__text", OPENING, "")).otherwise(F.col("__text"))
    return named.select(F.col("__file").alias("file"), "root", F.regexp_replace(inner, r"^\s*,", "").alias("entry"))


def explode_large_document(spark: SparkSession, path: str, section: T.DataType, root: str = "stocks") -> DataFrame:
    """``{root: {symbol: section}}`` files to one row (symbol, section fields) per symbol, as ``explode_documents`` gives them.

    Beside the root may stand other objects of objects, and before them plain values.  A symbol whose value has
    another shape keeps its row with NULL fields; a file without the root gives no rows.
    """
    found = entries(spark, path).filter(F.col("root") == root)
    values = F.from_json(F.concat(F.lit("{"), "entry", F.lit("}")), T.MapType(T.StringType(), T.StringType()))
    rows = found.select(F.explode(values).alias("symbol", "__value"))
    return rows.select("symbol", F.from_json("__value", section).alias("section")).select("symbol", "section.*")
