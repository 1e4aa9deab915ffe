"""Declared checks; each yields how many rows break it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecometrics.operators.ranking import first_per_class


def _count_of(broken: Column) -> Column:
    return F.coalesce(F.sum(F.when(broken, 1)), F.lit(0)).cast("bigint")


def row_checks(
    df: DataFrame, not_null: Sequence[str] = (), accepted: Mapping[str, Iterable[Any]] | None = None
) -> DataFrame:
    """All not_null and accepted_values checks of a table in a single pass."""
    checks = [("not_null", name, F.col(name).isNull()) for name in not_null]
    checks += [("accepted_values", name, ~F.col(name).isin(list(v))) for name, v in (accepted or {}).items()]
    counted = df.agg(*[_count_of(broken).alias(f"c{i}") for i, (_, _, broken) in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(F.lit(kind).alias("check"), F.lit(name).alias("column"), F.col(f"c{i}").alias("failures"))
            for i, (kind, name, _) in enumerate(checks)
        ]
    )
    return counted.select(F.explode(rows).alias("row")).select("row.*")


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return row_checks(df, not_null=columns)


def accepted_values(df: DataFrame, column: str, values: Iterable[Any]) -> DataFrame:
    return row_checks(df, accepted={column: values})


def duplicates(df: DataFrame, *key: str) -> DataFrame:
    """Known keys that occur more than once, with how often."""
    known = reduce(Column.__and__, [F.col(name).isNotNull() for name in key])
    return df.filter(known).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def unique(df: DataFrame, column: str) -> DataFrame:
    counted = duplicates(df, column).agg(F.count(F.lit(1)).alias("failures"))
    return counted.select(F.lit("unique").alias("check"), F.lit(column).alias("column"), "failures")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Known child keys without a parent, with how many rows; both sides are folded before they are joined."""
    keys = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return keys.join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def relationship(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    lost = orphans(child, key, parent, parent_key)
    counted = lost.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("failures"))
    return counted.select(F.lit("relationships").alias("check"), F.lit(key).alias("column"), "failures")


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first along ``order``; rows without a key are kept as they are."""
    known = reduce(Column.__and__, [F.col(name).isNotNull() for name in key])
    alone = F.when(~known, F.monotonically_increasing_id())
    return first_per_class(df.withColumn("__alone", alone), [*key, "__alone"], order).drop("__alone")
