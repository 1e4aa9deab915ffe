"""Dimensions, facts and the reports over both asset classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecometrics.functions import bands as b
from ecometrics.functions import measures as m
from ecometrics.functions.numbers import rounded_long
from ecometrics.operators import statistics
from ecometrics.operators.joins import enrich, highest
from ecometrics.operators.rollup import multi_grain

# Names in the reports.
CRYPTO, STOCK, EVERYTHING = "Cryptocurrency", "Stock", "Tous actifs"
BENCHMARK_COIN = "btc"
OVERVIEW_COLUMNS = (
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
    "asset_subtype",
    "estimated_esg",
    "region",
    "year_founded",
    "main_focus",
)


def dim_cryptocurrencies(crypto: DataFrame) -> DataFrame:
    return crypto.select(
        "coin_name",
        "symbol",
        "price_usd",
        "green_price",
        "percent_change",
        "market_cap",
        "environmental_impact_category",
    )


def crypto_scores(crypto: DataFrame) -> dict[str, Column]:
    """What the fact adds to a coin; two of them hold scalar maxima over ``crypto``."""
    of_benchmark = highest(crypto, "co2_emissions_mt", F.col("symbol") == BENCHMARK_COIN)
    of_all = highest(crypto, "co2_emissions_mt")
    energy = F.col("electricity_consumption_gw")
    return {
        "relative_emissions_to_bitcoin": m.share_of_benchmark(
            "co2_emissions_mt", F.col("symbol") == BENCHMARK_COIN, of_benchmark
        ),
        "market_cap_per_kwh": F.when(energy > 0, m.divided("market_cap", m.scaled(energy, 1e6))),
        "ecological_score": m.inverse_share_score("co2_emissions_mt", of_all),
        "ecological_category": b.ecology_band("co2_emissions_mt"),
    }


def fact_crypto_environmental(crypto: DataFrame) -> DataFrame:
    """``crypto`` is read three times (two scalar maxima) and should be a written table."""
    return crypto.withColumns(crypto_scores(crypto)).select(
        "coin_name",
        "symbol",
        "electricity_consumption_gw",
        "co2_emissions_mt",
        "co2_emissions_tonnes",
        "market_cap_per_co2",
        "relative_emissions_to_bitcoin",
        "market_cap_per_kwh",
        "ecological_score",
        "ecological_category",
        "environmental_impact_category",
    )


def dim_companies(stock: DataFrame, as_of: Column) -> DataFrame:
    return stock.select(
        "id",
        "company_name",
        "ticker",
        "category",
        "stock_exchange",
        "market_cap",
        "esg_score",
        "revenue_billions",
        "main_focus",
        "region",
        "year_founded",
        "current_price",
        m.age_in_years(as_of, "year_founded").alias("company_age"),
        b.size_band("market_cap").alias("company_size"),
        b.esg_band("esg_score").alias("esg_category"),
        b.region_band("region").alias("region_group"),
    )


def stock_scores(stock: DataFrame) -> dict[str, Column]:
    """What the fact adds to a company; one of them holds a scalar maximum over ``stock``."""
    score = F.col("combined_environmental_score")
    return {
        "normalized_environmental_score": m.scaled(score, 2),
        "carbon_intensity_tonnes_per_million": m.intensity_per_million("co2_emissions_mt", "revenue_billions"),
        "carbon_efficiency_percentile": m.share_of_highest("revenue_per_co2", highest(stock, "revenue_per_co2")),
        "environmental_performance_category": b.performance_band(score),
        "carbon_emission_category": b.emission_band("co2_emissions_mt"),
    }


def fact_stock_environmental(stock: DataFrame) -> DataFrame:
    """``stock`` is read twice (one scalar maximum) and should be a written table."""
    return stock.withColumns(stock_scores(stock)).select(
        "id",
        "company_name",
        "ticker",
        "electricity_consumption_gwh",
        "co2_emissions_mt",
        "electrical_power_gwh",
        "revenue_per_co2",
        "market_cap_per_co2",
        "revenue_per_gwh",
        "combined_environmental_score",
        "normalized_environmental_score",
        "carbon_intensity_tonnes_per_million",
        "carbon_efficiency_percentile",
        "environmental_performance_category",
        "carbon_emission_category",
    )


def coin_pairs(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Dimension and fact by name, which need not be unique: n rows of a name on each side yield n × n."""
    measured = (
        "co2_emissions_mt",
        "electricity_consumption_gw",
        "market_cap_per_co2",
        "ecological_score",
        "ecological_category",
    )
    return enrich(dim, fact, ["coin_name"], measured, how="inner")


def company_pairs(dim: DataFrame, fact: DataFrame) -> DataFrame:
    measured = (
        "co2_emissions_mt",
        "electricity_consumption_gwh",
        "market_cap_per_co2",
        "normalized_environmental_score",
        "environmental_performance_category",
    )
    return enrich(dim, fact, ["id"], measured, how="inner")


def green_investment_overview(coins: DataFrame, companies: DataFrame) -> DataFrame:
    """Both classes in one table, from rows that hold the dimension and the fact of an asset."""
    coin_assets = coins.select(
        F.lit(CRYPTO).alias("asset_type"),
        F.col("coin_name").alias("asset_name"),
        F.col("symbol").alias("asset_symbol"),
        F.col("price_usd").alias("current_price"),
        "market_cap",
        "co2_emissions_mt",
        F.col("electricity_consumption_gw").alias("energy_consumption"),
        F.col("market_cap_per_co2").alias("green_efficiency"),
        F.col("ecological_score").alias("environmental_score"),
        F.col("ecological_category").alias("environmental_category"),
        b.coin_class("symbol").alias("asset_subtype"),
        rounded_long("ecological_score").alias("estimated_esg"),
        F.lit(None).cast("string").alias("region"),
        F.lit(None).cast("bigint").alias("year_founded"),
        F.lit("Digital Asset").alias("main_focus"),
    )
    company_assets = companies.select(
        F.lit(STOCK).alias("asset_type"),
        F.col("company_name").alias("asset_name"),
        F.col("ticker").alias("asset_symbol"),
        "current_price",
        "market_cap",
        "co2_emissions_mt",
        (F.col("electricity_consumption_gwh") / F.lit(1000.0)).alias("energy_consumption"),
        F.col("market_cap_per_co2").alias("green_efficiency"),
        F.col("normalized_environmental_score").alias("environmental_score"),
        F.col("environmental_performance_category").alias("environmental_category"),
        F.col("category").alias("asset_subtype"),
        F.col("esg_score").alias("estimated_esg"),
        "region",
        "year_founded",
        "main_focus",
    )
    return coin_assets.unionByName(company_assets)


def carbon_efficiency_metrics(overview: DataFrame, analysed_at: Column) -> DataFrame:
    return statistics.efficiency_metrics(overview).withColumn("analysis_timestamp", analysed_at)


def environmental_impact_comparison(overview: DataFrame) -> DataFrame:
    return multi_grain(
        overview,
        grains=["asset_type", "asset_subtype"],
        label="asset_type",
        total_label=EVERYTHING,
        count="total_assets",
        means={
            "avg_co2_emissions": "co2_emissions_mt",
            "avg_efficiency": "green_efficiency",
            "avg_environmental_score": "environmental_score",
        },
        sums={"total_co2_emissions": "co2_emissions_mt", "total_market_cap": "market_cap"},
        ratios={
            "carbon_intensity_per_million_usd": ("co2_emissions_mt", "market_cap", 1e6),
            "energy_intensity_per_million_usd": ("energy_consumption", "market_cap", 1e6),
        },
    )
