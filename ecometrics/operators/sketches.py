"""Quantiles from stored sketches: one small KLL sketch per class and period, merged for whatever is asked.

A sketch of parameter ``k`` answers a quantile whose rank is off by at most ``rank_error(k)`` of the count (with a
confidence of 99 percent), however many values went in; up to ``k`` values it is exact.  Sketches are built by an
aggregate that combines on the map side, and merging keeps the bound: periods, classes and regions add up in any order, so
a question over years reads a row per class and period instead of the values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecometrics.sources.tables import publish

K = 1024
PERIOD, SKETCH, COUNT = "period", "sketch", "n"


def rank_error(k: int) -> float:
    """Bound of the normalised rank error of one quantile: 1.33 percent for 200, 0.27 percent for 1024."""
    return 2.296 / k**0.9723


def known(value: str) -> Column:
    """NULL and NaN have no place among quantiles."""
    number = F.col(value).cast("double")
    return F.when(~F.isnan(number), number)


def period_sketches(
    df: DataFrame, by: Sequence[str], value: str, moment: str, period: str = "day", k: int = K
) -> DataFrame:
    """(by..., period, sketch, n) of the known values; ``period`` is the first day of a day, week, month, quarter or year.

    A period without known values and rows without a moment have no row.
    """
    first = F.to_date(F.date_trunc(period, moment))
    rows = df.select(*by, first.alias(PERIOD), known(value).alias("__value"))
    rows = rows.filter(F.col("__value").isNotNull() & F.col(PERIOD).isNotNull())
    return rows.groupBy(*by, PERIOD).agg(F.kll_sketch_agg_double("__value", F.lit(k)).alias(SKETCH), F.count(F.lit(1)).alias(COUNT))


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of one ``k`` folded to coarser classes; of nothing at all there is no row."""
    folded = sketches.groupBy(*by).agg(F.kll_merge_agg_double(SKETCH).alias(SKETCH), F.sum(COUNT).alias(COUNT))
    return folded.filter(F.col(COUNT) > 0)


def quantiles(sketches: DataFrame, by: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """(by..., share, value, n): the smallest value whose rank is at least ``share`` of the count, per class."""
    asked = F.array(*[F.lit(float(x)) for x in shares])
    pairs = F.arrays_zip(asked.alias("share"), F.kll_sketch_get_quantile_double(SKETCH, asked).alias("value"))
    return merged(sketches, by).select(*by, F.inline(pairs).alias("share", "value"), COUNT)


def medians(df: DataFrame, by: Sequence[str], value: str, k: int = K, name: str = "median") -> DataFrame:
    """One pass, no rounds: the median of each class within ``rank_error(k)``; classes without known values have no row."""
    sketch = F.kll_sketch_agg_double("__value", F.lit(k))
    rows = df.select(*by, known(value).alias("__value")).filter(F.col("__value").isNotNull())
    return rows.groupBy(*by).agg(F.kll_sketch_get_quantile_double(sketch, F.lit(0.5)).alias(name))


def store(df: DataFrame, path: str, by: Sequence[str], value: str, moment: str, period: str = "day", k: int = K) -> str:
    """Write the sketches below ``path``, a folder per period, so that a question about some reads their folders alone."""
    return publish(period_sketches(df, by, value, moment, period, k), path, [PERIOD])
