"""Screens, look-ups, facets and peers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecometrics.functions.text import clean_text
from ecometrics.operators.joins import enrich
from ecometrics.operators.ranking import first_per_class
from ecometrics.session import settle


def screen(
    df: DataFrame,
    members: Mapping[str, Iterable[Any]] | None = None,
    at_least: Mapping[str, Any] | None = None,
    at_most: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Rows that meet every facet: membership lists and bounds."""
    tests = [F.col(name).isin(list(values)) for name, values in (members or {}).items()]
    tests += [F.col(name) >= bound for name, bound in (at_least or {}).items()]
    tests += [F.col(name) <= bound for name, bound in (at_most or {}).items()]
    return df.filter(reduce(Column.__and__, tests, F.lit(True)))


def look_up(df: DataFrame, key: str, wanted: Any, attribute: str) -> DataFrame:
    return df.filter(F.col(key) == wanted).select(attribute)


def facet_values(df: DataFrame, *columns: str) -> DataFrame:
    """(facet, value) for the distinct values of some text columns, in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in columns]))
    return df.select(pairs.alias("pair")).select("pair.facet", "pair.value").distinct()


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which all the columns are known."""
    return df.dropna(subset=list(columns))


def not_blank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(clean_text(column).isNotNull())


def peers(df: DataFrame, key: str, group: str, order: str, count: int = 3) -> DataFrame:
    """The first other members of each row's group: (key, peer, position).

    Whoever a row's peers are, they stand among the first ``count + 1`` members
    of the group.  Those few are kept per group and joined back, so no pairs
    within a group are formed.
    """
    ordered = [F.col(order).asc(), F.col(key).asc()]
    members = first_per_class(df.select(group, order, key), [group], ordered, count + 1)
    heads = members.groupBy(group).agg(F.sort_array(F.collect_list(F.struct(order, key))).alias("__heads"))
    met = enrich(df.select(key, group), settle(heads, "group-heads"), [group], ["__heads"], how="inner")
    others = F.slice(F.filter("__heads", lambda head: head[key] != F.col(key)), 1, count)
    placed = met.select(key, F.posexplode(others).alias("position", "head"))
    return placed.select(key, F.col(f"head.{key}").alias("peer"), (F.col("position") + 1).cast("bigint").alias("position"))
