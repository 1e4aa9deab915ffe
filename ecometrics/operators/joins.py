"""Keyed enrichment.

None of these joins carries a broadcast hint.  A side that was written with
``settle`` has a known size, so Catalyst broadcasts it below the configured
threshold and shuffles it beyond.  Hot keys of shuffled joins are split by
adaptive execution (see ``session.RUNTIME_SETTINGS``), on both sides of an
inner join but only on the detail side of a left join; ``enrich_repeated`` is
for sides that may hold very many rows of one key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_PREFIX = "__key_"


def enrich(
    detail: DataFrame,
    side: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    columns: Mapping[str, str] | Sequence[str],
    normalise=None,
    how: str = "left",
) -> DataFrame:
    """Left-join columns of ``side`` onto ``detail``; detail rows are never lost.

    ``on`` maps detail keys to side keys, ``columns`` maps side columns to the
    names they take.  With ``normalise`` both keys pass through that column
    function first.  NULL keys match nothing.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {name: name for name in on}
    taken = dict(columns) if isinstance(columns, Mapping) else {name: name for name in columns}
    prepare = normalise or (lambda column: column)
    keyed = side.select(
        *[prepare(F.col(right)).alias(KEY_PREFIX + str(i)) for i, right in enumerate(pairs.values())],
        *[F.col(source).alias(target) for source, target in taken.items()],
    )
    matches = [prepare(detail[left]) == keyed[KEY_PREFIX + str(i)] for i, left in enumerate(pairs)]
    joined = detail.join(keyed, reduce(Column.__and__, matches), how)
    return joined.drop(*[KEY_PREFIX + str(i) for i in range(len(pairs))])


def enrich_repeated(
    detail: DataFrame,
    side: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    columns: Mapping[str, str] | Sequence[str],
    normalise=None,
) -> DataFrame:
    """``enrich`` for a side whose key is not unique: a detail row meets all rows of its key.

    The matches come from an inner join, whose hot keys adaptive execution can
    split on either side; the detail rows without a match are added from an
    anti join against the distinct keys.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {name: name for name in on}
    taken = dict(columns) if isinstance(columns, Mapping) else {name: name for name in columns}
    prepare = normalise or (lambda column: column)
    names = [KEY_PREFIX + str(i) for i in range(len(pairs))]
    met = enrich(detail, side, pairs, taken, normalise, how="inner")
    known = side.select(*[prepare(F.col(right)).alias(name) for right, name in zip(pairs.values(), names, strict=True)])
    distinct = known.dropna().distinct()
    matches = [prepare(detail[left]) == distinct[name] for left, name in zip(pairs, names, strict=True)]
    alone = detail.join(distinct, reduce(Column.__and__, matches), "left_anti")
    return met.unionByName(alone, allowMissingColumns=True).select(met.columns)


def not_yet_in(candidates: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Candidates whose key does not occur in ``done``; its copies are folded before the shuffle."""
    return candidates.join(done.select(key).distinct(), key, "left_anti")


def filled(df: DataFrame, target: str, *sources: str) -> DataFrame:
    """Put the first non-NULL of ``sources`` into ``target``."""
    return df.withColumn(target, F.coalesce(*[F.col(name) for name in sources]))


def highest(df: DataFrame, column: str, where: Column | None = None) -> Column:
    """The greatest value of a column as a one-row scalar subquery; a condition leaves the scan as it is, to be shared."""
    return df.agg(F.max(F.col(column) if where is None else F.when(where, F.col(column)))).scalar()


def merge_sections(keys: DataFrame, key: str, sections: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per key with one column per section, NULL where a section is missing.

    The sections are stacked and folded in a single aggregation, so that the
    key is shuffled once and not once per section.
    """
    stacked = reduce(
        DataFrame.unionByName,
        [
            frame.select(F.col(key), F.lit(name).alias("__section"), F.col(value).alias("__value"))
            for name, (frame, value) in sections.items()
        ],
    )
    folded = stacked.groupBy(key).agg(
        *[F.max(F.when(F.col("__section") == name, F.col("__value"))).alias(name) for name in sections]
    )
    return enrich(keys.select(key).distinct(), folded, [key], list(sections))
