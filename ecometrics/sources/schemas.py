"""What the sources look like.

All measures are read as text and cleaned afterwards.  A source maps each
logical column to the headers it is known under; the first one is the header
of the files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Source:
    name: str
    columns: dict[str, tuple[str, ...]]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(column, T.StringType()) for column in self.columns])

    def unify(self, df: DataFrame) -> DataFrame:
        """Bring a table written with any of the known headers to the logical columns."""
        known = {name: logical for logical, headers in self.columns.items() for name in (logical, *headers)}
        return df.withColumnsRenamed({c: known[c] for c in df.columns if c in known}).select(*self.columns)


# Logical columns and the headers they come under.
CRYPTO_QUOTES = Source(
    "raw_green_crypto",
    {
        "coin": ("Coin",),
        "symbol": ("Symbol",),
        "price": ("Price",),
        "change": ("Change",),
        "percent_change": ("Percent_Change",),
        "high_24h": ("High_24h",),
        "low_24h": ("Low_24h",),
        "open_24h": ("Open_24h",),
        "previous_close_24h": ("Previous_Close_24h",),
        "timestamp": ("Timestamp",),
    },
)
CRYPTO_FOOTPRINT = Source(
    "raw_green_crypto_carbon",
    {
        "coin": ("Coin",),
        "symbol": ("Symbol",),
        "consensus": ("Type",),
        "market_cap": ("Marketcap",),
        "electrical_power": ("Electrical_Power_GW", "Electrical_Power"),
        "electricity_consumption": (
            "Electricity_Consumption_ GW_annualised",
            "Electricity_Consumption_annualised",
            "Electricity_Consumption_GW",
        ),
        "co2_emissions": ("CO2_Emissions_Mt_annualised", "CO2_Emissions_annualised", "CO2_Emissions_Mt"),
    },
)
COMPANIES = Source(
    "raw_green_stock",
    {
        "id": ("ID",),
        "company": ("Company",),
        "ticker": ("Ticker",),
        "category": ("Category",),
        "stock_exchange": ("Stock_Exchange",),
        "market_cap": ("Marketcap_B_dollar", "Marketcap_BUSD", "Marketcap"),
        "esg_score": ("ESG_Score",),
        "revenue": ("Revenue_B_dollar", "Revenue_BUSD", "Revenue"),
        "main_focus": ("Main_Focus",),
        "region": ("Region",),
        "year_founded": ("Year_Founded",),
    },
)
COMPANY_FOOTPRINT = Source(
    "raw_green_stock_carbon",
    {
        "id": ("ID",),
        "company": ("Company",),
        "ticker": ("Ticker",),
        "electricity_consumption": ("Electricity_Consumption_GWh",),
        "co2_emissions": ("CO2_Emissions _Mt", "CO2_Emissions_million_tons", "CO2_Emissions_Mt"),
        "electrical_power": ("Electrical_Power_GWh", "Electrical_Power"),
    },
)
COIN_PRICES = Source("raw_coincap_prices", {"coin": ("coin",), "price_usd": ("price_usd",)})
COMPANY_FINANCIALS = Source(
    "raw_finnhub_financials",
    {"ticker": ("ticker",), "current_price": ("current_price",), "market_cap": ("marketCapitalization",)},
)
SOURCES = {
    source.name: source
    for source in (
        CRYPTO_QUOTES,
        CRYPTO_FOOTPRINT,
        COMPANIES,
        COMPANY_FOOTPRINT,
        COIN_PRICES,
        COMPANY_FINANCIALS,
    )
}

NETWORK_SECTION = T.StructType([T.StructField("detail", T.StringType())])
NETWORK_RECORD = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("power", NETWORK_SECTION),
        T.StructField("electricity", NETWORK_SECTION),
        T.StructField("emissions", NETWORK_SECTION),
    ]
)
ERROR_KEYS = ("Information", "Error Message", "Note")
