"""Raw text tables to typed tables.  Inputs carry the logical columns of ``sources.schemas``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecometrics.functions import numbers as n
from ecometrics.functions import text as t

UNLISTED = {"Not Listed": "UNLISTED"}


def stg_coincap_prices(raw: DataFrame, loaded_at: Column, strict: bool = False) -> DataFrame:
    return raw.select(
        t.clean_lower("coin").alias("coin"),
        n.stripped_number("price_usd", strict).alias("price_usd"),
        loaded_at.alias("loaded_at"),
    )


def stg_finnhub_financials(raw: DataFrame, loaded_at: Column, strict: bool = False) -> DataFrame:
    return raw.select(
        t.clean_upper("ticker").alias("ticker"),
        n.stripped_number("current_price", strict).alias("current_price"),
        n.stripped_number("market_cap", strict).alias("market_cap"),
        loaded_at.alias("loaded_at"),
    )


def stg_green_crypto(raw: DataFrame, loaded_at: Column, strict: bool = False) -> DataFrame:
    return raw.select(
        t.clean_text("coin").alias("coin_name"),
        t.clean_lower("symbol").alias("symbol"),
        n.plain_number("price").alias("price"),
        n.plain_number("change").alias("price_change"),
        n.percent_number("percent_change").alias("percent_change"),
        *[n.plain_number(c).alias(c) for c in ("high_24h", "low_24h", "open_24h", "previous_close_24h")],
        n.whole_number("timestamp").alias("timestamp"),
        loaded_at.alias("loaded_at"),
    )


def stg_green_crypto_carbon(raw: DataFrame, loaded_at: Column, strict: bool = False) -> DataFrame:
    """Names and symbols stay as they come; the join brings them together."""
    return raw.select(
        F.col("coin").alias("coin_name"),
        F.col("symbol"),
        F.col("consensus").alias("asset_type"),
        n.unsigned_amount("market_cap").alias("market_cap"),
        n.plain_number("electrical_power").alias("electrical_power_gw"),
        n.plain_number("electricity_consumption").alias("electricity_consumption_gw"),
        n.plain_number("co2_emissions").alias("co2_emissions_mt"),
        loaded_at.alias("loaded_at"),
    )


def stg_green_stock(raw: DataFrame, loaded_at: Column, strict: bool = False) -> DataFrame:
    return raw.select(
        n.whole_number("id").alias("id"),
        t.clean_text("company").alias("company_name"),
        t.clean_upper("ticker").alias("ticker"),
        t.clean_text("category").alias("category"),
        t.clean_text("stock_exchange").alias("stock_exchange"),
        n.currency_amount("market_cap", n.MAGNITUDES, strict).alias("market_cap"),
        n.whole_number("esg_score").alias("esg_score"),
        n.currency_amount("revenue", n.BILLIONS, strict).alias("revenue_billions"),
        t.clean_text("main_focus").alias("main_focus"),
        t.clean_text("region").alias("region"),
        n.whole_number("year_founded").alias("year_founded"),
        loaded_at.alias("loaded_at"),
    )


def stg_green_stock_carbon(raw: DataFrame, loaded_at: Column, strict: bool = False) -> DataFrame:
    return raw.select(
        n.whole_number("id").alias("id"),
        t.clean_text("company").alias("company_name"),
        t.clean_upper("ticker", UNLISTED).alias("ticker"),
        n.stripped_number("electricity_consumption", strict).alias("electricity_consumption_gwh"),
        n.stripped_number("co2_emissions", strict).alias("co2_emissions_mt"),
        n.stripped_number("electrical_power", strict).alias("electrical_power_gwh"),
        loaded_at.alias("loaded_at"),
    )
