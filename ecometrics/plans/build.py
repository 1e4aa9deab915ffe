"""The models by name, their layers and their declared checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecometrics.functions.text import join_key
from ecometrics.operators import quality
from ecometrics.plans import intermediate, marts, staging
from ecometrics.session import settle
from ecometrics.sources.tables import publish, read_table

LAYERS = {
    "staging": (
        "stg_coincap_prices",
        "stg_finnhub_financials",
        "stg_green_crypto",
        "stg_green_crypto_carbon",
        "stg_green_stock",
        "stg_green_stock_carbon",
    ),
    "intermediate": ("int_crypto_metrics", "int_stock_metrics"),
    "marts_crypto": ("dim_cryptocurrencies", "fact_crypto_environmental"),
    "marts_stock": ("dim_companies", "fact_stock_environmental"),
    "marts_overview": (
        "green_investment_overview",
        "carbon_efficiency_metrics",
        "environmental_impact_comparison",
    ),
}
LAYER_OF = {name: layer for layer, names in LAYERS.items() for name in names}
# Read more than once further on: written to the scratch folder and read back.
SHARED = ("int_crypto_metrics", "int_stock_metrics", "green_investment_overview")

# The declared checks.
NOT_NULL = {
    "int_crypto_metrics": ("coin_name", "symbol"),
    "int_stock_metrics": ("id", "company_name", "ticker"),
    "dim_cryptocurrencies": ("coin_name", "symbol"),
    "fact_crypto_environmental": ("coin_name",),
    "dim_companies": ("id", "company_name", "ticker"),
    "fact_stock_environmental": ("id",),
    "green_investment_overview": ("asset_name", "asset_symbol"),
    "environmental_impact_comparison": ("asset_type",),
}
UNIQUE = {"int_stock_metrics": ("id",), "dim_companies": ("id",)}
ACCEPTED = {
    "int_crypto_metrics": {
        "environmental_impact_category": (
            "Très faible impact",
            "Faible impact",
            "Impact modéré",
            "Impact élevé",
            "Impact très élevé",
        )
    },
    "green_investment_overview": {"asset_type": (marts.CRYPTO, marts.STOCK)},
}
RELATIONSHIPS = (
    ("fact_crypto_environmental", "coin_name", "dim_cryptocurrencies", "coin_name"),
    ("fact_stock_environmental", "id", "dim_companies", "id"),
)


class Models:
    """Models over the six raw tables, built when asked for; what is read more than once is written then.

    ``loaded_at`` and ``as_of`` default to the current time and day.  With
    ``dedupe`` only the first footprint row of a symbol is kept.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        loaded_at: Column | None = None,
        as_of: Column | None = None,
        strict: bool = False,
        dedupe: bool = False,
    ):
        self.raw = raw
        self.loaded_at = F.current_timestamp() if loaded_at is None else loaded_at
        self.as_of = F.current_date() if as_of is None else as_of
        self.strict = strict
        self.dedupe = dedupe
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            df = self._plan(name)
            self._built[name] = settle(df, name) if name in SHARED else df
        return self._built[name]

    def _plan(self, name: str) -> DataFrame:
        if LAYER_OF[name] == "staging":
            clean: Callable = getattr(staging, name)
            staged = clean(self.raw["raw_" + name.removeprefix("stg_")], self.loaded_at, self.strict)
            if self.dedupe and name == "stg_green_crypto_carbon":
                # Under the key that the join uses, so that spellings of one symbol are one.
                keyed = staged.withColumn("__symbol", join_key("symbol"))
                order = [F.col(c).asc_nulls_last() for c in (*(c for c in staged.columns if c != "symbol"), "symbol")]
                return quality.keep_first(keyed, ["__symbol"], order).drop("__symbol")
            return staged
        if name == "int_crypto_metrics":
            return intermediate.int_crypto_metrics(
                self["stg_green_crypto"], self["stg_green_crypto_carbon"], self["stg_coincap_prices"]
            )
        if name == "int_stock_metrics":
            return intermediate.int_stock_metrics(
                self["stg_green_stock"], self["stg_green_stock_carbon"], self["stg_finnhub_financials"]
            )
        if name == "dim_companies":
            return marts.dim_companies(self["int_stock_metrics"], self.as_of)
        if name == "green_investment_overview":
            coins = marts.coin_pairs(self["dim_cryptocurrencies"], self["fact_crypto_environmental"])
            companies = marts.company_pairs(self["dim_companies"], self["fact_stock_environmental"])
            return marts.green_investment_overview(coins, companies)
        if name == "carbon_efficiency_metrics":
            return marts.carbon_efficiency_metrics(self["green_investment_overview"], self.loaded_at)
        if name == "environmental_impact_comparison":
            return marts.environmental_impact_comparison(self["green_investment_overview"])
        derive: Callable = getattr(marts, name)
        return derive(self["int_crypto_metrics" if "crypto" in name else "int_stock_metrics"])

    def check(self) -> DataFrame:
        """(model, check, column, failures) for every declared check."""
        results = []
        for name in LAYER_OF:
            if name in NOT_NULL or name in ACCEPTED:
                found = quality.row_checks(self[name], NOT_NULL.get(name, ()), ACCEPTED.get(name))
                results.append(found.withColumn("model", F.lit(name)))
            for column in UNIQUE.get(name, ()):
                results.append(quality.unique(self[name], column).withColumn("model", F.lit(name)))
        for child, key, parent, parent_key in RELATIONSHIPS:
            found = quality.relationship(self[child], key, self[parent], parent_key)
            results.append(found.withColumn("model", F.lit(child)))
        return reduce(DataFrame.unionByName, results).select("model", "check", "column", "failures")

    def publish(self, root: str) -> dict[str, str]:
        """Write every model below the folder of its layer; later models start from the written ones."""
        paths = {}
        for name, layer in LAYER_OF.items():
            df = self._built.get(name) or self._plan(name)
            paths[name] = publish(df, f"{root}/{layer}/{name}")
            self._built[name] = read_table(df.sparkSession, paths[name])
        return paths
