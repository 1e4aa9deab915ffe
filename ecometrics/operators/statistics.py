"""Statistics of a class, and every row measured against its class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecometrics.functions import measures
from ecometrics.functions.bands import efficiency_band
from ecometrics.operators import exact, sketches
from ecometrics.operators.joins import enrich
from ecometrics.operators.ranking import descending, middle_values, rank_within
from ecometrics.session import settle

STATISTICS = ("avg_efficiency", "max_efficiency", "min_efficiency", "stddev_efficiency", "count_assets")


def group_stats(df: DataFrame, by: str, value: str) -> DataFrame:
    """Mean, extremes, sample deviation and count of the known values of a class, in one scan.

    The mean is the quotient of the sum nearest to the true one and the count, whatever the order of the rows; the
    deviation comes from central moments around it.  Classes without known values have no row.
    """
    known = df.filter(F.col(value).isNotNull()).select(by, F.col(value).alias("__value"))
    extremes = {"max_efficiency": (F.max("__value"), F.max), "min_efficiency": (F.min("__value"), F.min)}
    found = exact.totals(known, [by], ["__value"], moments=["__value"], keep=extremes)
    return found.select(
        by,
        F.col("mean___value").alias("avg_efficiency"),
        "max_efficiency",
        "min_efficiency",
        F.col("deviation___value").alias("stddev_efficiency"),
        F.col("n___value").alias("count_assets"),
    )


def with_median(stats: DataFrame, df: DataFrame, by: str, value: str, k: int | None = None) -> DataFrame:
    """Adds the median of each class, the lower one of two: exact, or with ``k`` from a sketch of that size in one pass."""
    if k is None:
        middle = middle_values(df, [by], value).select(F.col(by).alias("__by"), F.col("low").alias("median_efficiency"))
    else:
        middle = sketches.medians(df, [by], value, k, "median_efficiency").withColumnRenamed(by, "__by")
    return stats.join(middle, F.col(by).eqNullSafe(F.col("__by"))).drop("__by")


def with_group_stats(df: DataFrame, by: str, value: str) -> DataFrame:
    """Attach the statistics of the class to every row (an aggregate and a join, no window)."""
    return enrich(df, settle(group_stats(df, by, value), "group-stats"), [by], list(STATISTICS))


# Every column that is not ranked by: names repeat, and rows that still tie are equal.
TIES = (
    "asset_name",
    "asset_symbol",
    "market_cap",
    "co2_emissions_mt",
    "current_price",
    "energy_consumption",
    "environmental_score",
    "environmental_category",
    "asset_subtype",
    "estimated_esg",
    "region",
    "year_founded",
    "main_focus",
)


def efficiency_metrics(overview: DataFrame, ties: Sequence[str] = TIES) -> DataFrame:
    """Every asset with known emissions, measured against its class.

    The statistics cover all assets of the class, the ranks only the listed
    ones.  ``overview`` is read twice and should be a written table.
    """
    listed = overview.filter(F.col("co2_emissions_mt").isNotNull())
    ranked = rank_within(listed, ["asset_type"], descending("green_efficiency", *ties), "efficiency_rank")
    stats = settle(group_stats(overview, "asset_type", "green_efficiency"), "group-stats")
    joined = enrich(ranked, stats, ["asset_type"], list(STATISTICS))
    efficiency, mean = F.col("green_efficiency"), F.col("avg_efficiency")
    return joined.select(
        "asset_type",
        "asset_name",
        "asset_symbol",
        "current_price",
        "market_cap",
        "co2_emissions_mt",
        "energy_consumption",
        "green_efficiency",
        "environmental_score",
        "environmental_category",
        measures.relative_to_mean(efficiency, mean).alias("relative_efficiency"),
        measures.z_score(efficiency, mean, "stddev_efficiency").alias("efficiency_z_score"),
        measures.min_max_score(efficiency, "min_efficiency", "max_efficiency").alias("efficiency_percentile"),
        "efficiency_rank",
        measures.rank_percentile("efficiency_rank", "count_assets").alias("efficiency_rank_percentile"),
        efficiency_band("co2_emissions_mt", efficiency, mean).alias("green_investment_category"),
        measures.divided("co2_emissions_mt", F.col("market_cap") / F.lit(1e6)).alias("carbon_intensity_per_million"),
        measures.divided("market_cap", F.col("co2_emissions_mt") * F.lit(1e6)).alias("eco_roi_usd_per_ton_co2"),
        "asset_subtype",
        "estimated_esg",
        "region",
        "year_founded",
        "main_focus",
    )
