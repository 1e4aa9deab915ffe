"""Guarded arithmetic and the composite measures built from it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ecometrics.functions.text import as_column

Operand = Column | str


def zero_as_null(value: Operand) -> Column:
    return F.nullif(as_column(value), F.lit(0))


def divided(numerator: Operand, denominator: Operand) -> Column:
    """Quotient, NULL for a zero or missing operand."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def positive_ratio(numerator: Operand, denominator: Operand) -> Column:
    """Quotient of two positive amounts, else NULL."""
    top, bottom = as_column(numerator), as_column(denominator)
    return F.when((top > 0) & (bottom > 0), divided(top, bottom))


def capped(value: Operand, limit: float) -> Column:
    """The smaller of value and limit; NULL stays NULL (``least`` alone would skip it)."""
    column = as_column(value)
    return F.when(column.isNotNull(), F.least(column, F.lit(float(limit))))


def floored(value: Operand, limit: float) -> Column:
    column = as_column(value)
    return F.when(column.isNotNull(), F.greatest(column, F.lit(float(limit))))


def scaled(value: Operand, factor: float) -> Column:
    return as_column(value) * F.lit(float(factor))


def scaled_if_positive(value: Operand, factor: float) -> Column:
    column = as_column(value)
    return F.when(column > 0, scaled(column, factor))


def penalised_score(score: Operand, burden: Operand, per_unit: float = 10.0, worst: float = 0.5) -> Column:
    """Score lowered by up to ``worst`` of itself; without a burden the score stands."""
    points, load = as_column(score).cast("double"), as_column(burden)
    return F.when(load.isNotNull(), points * (F.lit(1.0) - capped(load / F.lit(per_unit), worst))).otherwise(points)


def share_of_benchmark(value: Operand, is_benchmark: Column, benchmark: Column) -> Column:
    """1 for the benchmark entity itself, else value ÷ benchmark value."""
    return F.when(is_benchmark, F.lit(1.0)).otherwise(divided(value, benchmark))


def inverse_share_score(value: Operand, highest: Column, ignored_highest: float = 0.0001) -> Column:
    """100 for no burden, 0 for the heaviest one; NULL when the highest value is the ignored one."""
    column = as_column(value)
    share = capped(divided(column, F.nullif(highest, F.lit(ignored_highest))), 1.0)
    return F.when(column == 0, F.lit(100.0)).otherwise(F.lit(100.0) * (F.lit(1.0) - share))


def share_of_highest(value: Operand, highest: Column) -> Column:
    """0-100 scaling to the highest value."""
    column = as_column(value)
    return F.when(column == 0, F.lit(0.0)).otherwise(F.lit(100.0) * divided(column, highest))


def intensity_per_million(burden: Operand, revenue_billions: Operand) -> Column:
    """Tonnes per million of revenue, from megatonnes and billions."""
    load, revenue = as_column(burden), as_column(revenue_billions)
    return F.when(revenue > 0, divided(load * F.lit(1e6), revenue * F.lit(1e3)))


def relative_to_mean(value: Operand, mean: Operand) -> Column:
    return divided(value, mean)


def z_score(value: Operand, mean: Operand, deviation: Operand) -> Column:
    return divided(as_column(value) - as_column(mean), deviation)


def min_max_score(value: Operand, lowest: Operand, highest: Operand) -> Column:
    low = as_column(lowest)
    return divided(F.lit(100.0) * (as_column(value) - low), as_column(highest) - low)


def rank_percentile(rank: Operand, peers: Operand) -> Column:
    """Above 100 is possible: rows without a value are ranked but are no peers."""
    return divided(as_column(rank).cast("double"), as_column(peers).cast("double")) * F.lit(100.0)


def percent_change(value: Operand, before: Operand) -> Column:
    return (divided(value, before) - F.lit(1.0)) * F.lit(100.0)


def age_in_years(as_of: Column, founded: Operand) -> Column:
    return F.year(as_of).cast("bigint") - as_column(founded)
