"""Staged tables joined to one wide row per asset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecometrics.functions import measures as m
from ecometrics.functions.bands import impact_band
from ecometrics.functions.text import join_key
from ecometrics.operators.joins import enrich_repeated


def int_crypto_metrics(quotes: DataFrame, footprint: DataFrame, prices: DataFrame) -> DataFrame:
    """A quote meets every footprint row of its symbol: duplicated footprints multiply it."""
    with_footprint = enrich_repeated(
        quotes,
        footprint,
        ["symbol"],
        {
            "coin_name": "footprint_name",
            "symbol": "footprint_symbol",
            "market_cap": "market_cap",
            "electricity_consumption_gw": "electricity_consumption_gw",
            "co2_emissions_mt": "co2_emissions_mt",
        },
        normalise=join_key,
    )
    priced = enrich_repeated(with_footprint, prices, {"coin_name": "coin"}, ["price_usd"], normalise=join_key)
    return priced.select(
        F.coalesce("coin_name", "footprint_name").alias("coin_name"),
        F.coalesce("symbol", "footprint_symbol").alias("symbol"),
        "price_usd",
        F.col("price").alias("green_price"),
        "percent_change",
        "market_cap",
        "electricity_consumption_gw",
        "co2_emissions_mt",
        m.positive_ratio("market_cap", "co2_emissions_mt").alias("market_cap_per_co2"),
        m.scaled_if_positive("co2_emissions_mt", 1e6).alias("co2_emissions_tonnes"),
        impact_band("co2_emissions_mt").alias("environmental_impact_category"),
    )


def int_stock_metrics(companies: DataFrame, footprint: DataFrame, financials: DataFrame) -> DataFrame:
    measured = enrich_repeated(
        companies,
        footprint,
        ["id"],
        ["electricity_consumption_gwh", "co2_emissions_mt", "electrical_power_gwh"],
    )
    feed = {"market_cap": "feed_cap", "current_price": "current_price"}
    valued = enrich_repeated(measured, financials, ["ticker"], feed)
    cap = F.coalesce("market_cap", "feed_cap")
    return valued.select(
        "id",
        "company_name",
        "ticker",
        "category",
        "stock_exchange",
        cap.alias("market_cap"),
        "esg_score",
        "revenue_billions",
        "main_focus",
        "region",
        "year_founded",
        "electricity_consumption_gwh",
        "co2_emissions_mt",
        "electrical_power_gwh",
        "current_price",
        m.positive_ratio("revenue_billions", "co2_emissions_mt").alias("revenue_per_co2"),
        m.positive_ratio(cap, "co2_emissions_mt").alias("market_cap_per_co2"),
        m.positive_ratio("revenue_billions", "electricity_consumption_gwh").alias("revenue_per_gwh"),
        m.penalised_score("esg_score", "co2_emissions_mt").alias("combined_environmental_score"),
    )
