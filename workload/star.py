"""Assets out of the star schema, and the raw text tables the models start from.

Customers stand in for coins and suppliers for companies.  Revenue is the
discounted price of what was sold, the footprint the quantity.  The messy text
is spelled in SQL expressions that Spark and other engines read alike, so that
both start from the same input.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecometrics.session import settle
from workload.registry import Star

# Whole cents per line: their sum is exact in any order and fits a long up to 10^12 lines of one key.
REVENUE_CENTS = "CAST(floor(l_extendedprice * (1 - l_discount) * 100 + 0.5) AS BIGINT)"
QUANTITY = "CAST(l_quantity AS BIGINT)"

BASE_SQL = f"""
customer_base AS (
  SELECT c_custkey AS k, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment,
         CAST(round(c_acctbal * 100) AS BIGINT) AS cents, qty, revenue
  FROM customer LEFT JOIN (
    SELECT o_custkey, CAST(sum({QUANTITY}) AS BIGINT) AS qty, CAST(sum({REVENUE_CENTS}) AS DOUBLE) / 100 AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey) ON o_custkey = c_custkey
),
supplier_base AS (
  SELECT s_suppkey AS k, s_name AS name, s_nationkey AS nation,
         CAST(round(s_acctbal * 100) AS BIGINT) AS cents, qty, revenue
  FROM supplier LEFT JOIN (
    SELECT l_suppkey, CAST(sum({QUANTITY}) AS BIGINT) AS qty, CAST(sum({REVENUE_CENTS}) AS DOUBLE) / 100 AS revenue
    FROM lineitem GROUP BY l_suppkey) ON l_suppkey = s_suppkey
)"""


def customer_base(star: Star) -> DataFrame:
    """Lines are folded per order before they meet the orders, and again per customer."""
    per_order = star.lineitem.groupBy("l_orderkey").agg(
        F.sum(F.expr(QUANTITY)).alias("qty"), F.sum(F.expr(REVENUE_CENTS)).alias("revenue_cents")
    )
    owned = per_order.join(star.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    per_customer = owned.groupBy("o_custkey").agg(F.sum("qty").alias("qty"), F.sum("revenue_cents").alias("revenue_cents"))
    return star.customer.join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("k"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents"),
        "qty",
        (F.col("revenue_cents") / 100.0).alias("revenue"),
    )


def supplier_base(star: Star) -> DataFrame:
    per_supplier = star.lineitem.groupBy("l_suppkey").agg(
        F.sum(F.expr(QUANTITY)).alias("qty"), F.sum(F.expr(REVENUE_CENTS)).alias("revenue_cents")
    )
    return star.supplier.join(per_supplier, F.col("s_suppkey") == F.col("l_suppkey"), "left").select(
        F.col("s_suppkey").alias("k"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.round(F.col("s_acctbal") * 100).cast("bigint").alias("cents"),
        "qty",
        (F.col("revenue_cents") / 100.0).alias("revenue"),
    )


def string(number: str) -> str:
    return f"CAST({number} AS STRING)"


def money(cents: str) -> str:
    """Cents as text with two decimals."""
    whole = string(f"CAST(floor(abs({cents}) / CAST(100 AS DOUBLE)) AS BIGINT)")
    return f"(CASE WHEN {cents} < 0 THEN '-' ELSE '' END || {whole} || '.' || lpad({string(f'abs({cents}) % 100')}, 2, '0'))"


DOLLARS = "CAST(floor(revenue) AS BIGINT)"
COIN = "CASE k WHEN 1 THEN 'btc' WHEN 2 THEN 'eth' WHEN 3 THEN 'ltc' WHEN 4 THEN 'xrp' WHEN 5 THEN 'bch' ELSE 'cus' || CAST(k AS STRING) END"
TICKER = "'sup' || CAST(k AS STRING)"
# The second copy of a footprint differs from the first.
Q = "(qty + 7 * copy)"



def raw_columns(thousands: Callable[[str], str]) -> dict[str, tuple[str, str | None, dict[str, str]]]:
    """table -> (base, rows written twice, column expressions).

    ``thousands`` spells an integer with separators; engines differ there.
    Some keys are spelled so that they match nothing.
    """
    return {
        "raw_green_crypto": (
            "customer_base",
            None,
            {
                "coin": "CASE WHEN k % 7 = 0 THEN '  ' || name || chr(9) ELSE name END",
                "symbol": f"CASE WHEN k % 5 = 0 THEN chr(9) || upper({COIN}) || ' ' ELSE {COIN} END",
                "price": f"CASE WHEN k % 11 = 0 THEN ' ' WHEN k % 13 = 0 THEN '0' WHEN k % 17 = 0 THEN 'n/a' WHEN k % 19 = 0 THEN '1_000' ELSE {money('cents')} END",
                "change": money("(cents % 997 - 500)"),
                "percent_change": "CAST(k % 41 - 20 AS STRING) || CASE WHEN k % 2 = 0 THEN '%' ELSE '' END",
                "high_24h": money("(cents + 250)"),
                "low_24h": f"CASE WHEN k % 21 = 0 THEN '5d' ELSE {money('(cents - 250)')} END",
                "open_24h": f"CASE WHEN k % 10 = 0 THEN '' ELSE {money('(cents + 100)')} END",
                "previous_close_24h": f"CASE WHEN k % 8 = 0 THEN CAST(k AS STRING) || '.5e-05' ELSE {money('(cents + 100)')} END",
                "timestamp": "CASE WHEN k % 17 = 0 THEN '12.5' WHEN k % 23 = 0 THEN 'abc' ELSE CAST(1740366720 + k AS STRING) END",
            },
        ),
        "raw_green_crypto_carbon": (
            "customer_base",
            "k % 50 = 3",
            {
                "coin": "name",
                "symbol": f"CASE WHEN k % 9 = 8 THEN 'gone' || CAST(k AS STRING) WHEN copy = 1 OR k % 4 = 0 THEN ' ' || upper({COIN}) ELSE {COIN} END",
                "consensus": "CASE WHEN segment = 'BUILDING' THEN 'PoW' ELSE 'PoS' END",
                "market_cap": f"CASE WHEN revenue IS NULL THEN '' WHEN k % 12 = 0 THEN '-' || {string(DOLLARS)} WHEN k % 15 = 0 THEN '0' ELSE '$' || {thousands(f'({DOLLARS} + 1000 * copy)')} END",
                "electrical_power": "CASE WHEN copy = 1 OR k % 10 = 4 THEN 'N/A' WHEN k % 10 = 5 THEN '' ELSE CAST(qty AS STRING) || '.25' END",
                "electricity_consumption": f"CASE WHEN qty IS NULL THEN 'N/A' WHEN k % 6 = 0 THEN CAST(qty AS STRING) || '.0e-06' WHEN k % 6 = 1 THEN '0.0' ELSE {money('qty')} END",
                "co2_emissions": f"CASE WHEN qty IS NULL OR k % 14 = 0 THEN '' WHEN k % 8 = 0 THEN '0.0' WHEN k % 8 = 2 THEN CAST({Q} AS STRING) || '.5e-10' WHEN k % 8 = 3 THEN CAST({Q} AS STRING) || '.5E-08' WHEN k % 8 = 4 THEN CAST({Q} AS STRING) || '.5e-07' WHEN k % 8 = 5 THEN CAST({Q} AS STRING) || '.5e-06' WHEN k % 8 = 6 THEN '0.0000' || CAST({Q} AS STRING) ELSE {money(Q)} END",
            },
        ),
        "raw_coincap_prices": (
            "customer_base",
            None,
            {
                "coin": "CASE WHEN k % 3 = 0 THEN 'no ' || name WHEN k % 4 = 0 THEN upper(name) ELSE lower(name) || ' ' END",
                "price_usd": f"CASE k % 10 WHEN 0 THEN 'USD ' || {money('cents')} WHEN 1 THEN CAST(k AS STRING) || '.5E-7' WHEN 2 THEN '$' || {money('cents')} WHEN 3 THEN 'free' WHEN 4 THEN '0' ELSE {money('cents')} END",
            },
        ),
        "raw_green_stock": (
            "supplier_base",
            None,
            {
                "id": "CASE WHEN k % 29 = 28 THEN '12.5' ELSE ' ' || CAST(k AS STRING) END",
                "company": "'  ' || name || chr(9)",
                "ticker": f"CASE WHEN k % 20 = 0 THEN 'Not Listed*' ELSE {TICKER} END",
                "category": "'Sector ' || CAST(k % 7 AS STRING)",
                "stock_exchange": "CASE WHEN k % 5 = 0 THEN ' ' ELSE 'Exchange ' || CAST(k % 3 AS STRING) END",
                "market_cap": f"CASE k % 8 WHEN 0 THEN '' WHEN 1 THEN '$' || {thousands(f'{DOLLARS} % 30000')} || '.5' WHEN 2 THEN {string(f'{DOLLARS} % 30')} || 'K' WHEN 3 THEN '0.' || CAST(k % 9 AS STRING) || 'm' WHEN 4 THEN '1.5B' WHEN 5 THEN '$1.5B' WHEN 6 THEN '0' ELSE {string(f'{DOLLARS} % 30000')} END",
                "esg_score": "CASE WHEN k % 13 = 0 THEN '' ELSE CAST(20 + k % 25 AS STRING) END",
                "revenue": f"CASE k % 9 WHEN 0 THEN '2b' WHEN 1 THEN '$' || {thousands(f'{DOLLARS} % 100000')} WHEN 2 THEN 'unknown' ELSE {money(f'({DOLLARS} % 100000)')} END",
                "main_focus": "'Focus ' || CAST(k % 9 AS STRING)",
                "region": "CASE k % 9 WHEN 0 THEN 'North America' WHEN 1 THEN 'Europe' WHEN 2 THEN 'Asia' WHEN 3 THEN 'South America' WHEN 4 THEN 'West Africa' WHEN 5 THEN 'Asia Pacific' WHEN 6 THEN 'Australia' WHEN 7 THEN 'Middle East' ELSE '' END",
                "year_founded": "CASE WHEN k % 31 = 5 THEN 'c. 1900' ELSE CAST(1900 + k % 120 AS STRING) END",
            },
        ),
        "raw_green_stock_carbon": (
            "supplier_base",
            None,
            {
                "id": "CAST(CASE WHEN k % 25 = 24 THEN -k ELSE k END AS STRING)",
                "company": "name",
                "ticker": f"CASE WHEN k % 20 = 0 THEN ' Not Listed' ELSE {TICKER} END",
                "electricity_consumption": f"CASE WHEN k % 6 = 0 THEN CAST(qty AS STRING) || ' GWh' ELSE {money('qty')} END",
                "co2_emissions": f"CASE k % 10 WHEN 0 THEN '0' WHEN 1 THEN '' WHEN 2 THEN CAST(qty AS STRING) || '.5e-05' WHEN 3 THEN '~ ' || {money('(qty % 4000)')} ELSE {money('(qty % 1200)')} END",
                "electrical_power": "CASE WHEN k % 7 = 0 THEN 'N/A' ELSE CAST(qty AS STRING) || '.0' END",
            },
        ),
        "raw_finnhub_financials": (
            "supplier_base",
            None,
            {
                "ticker": f"CASE WHEN k % 2 = 0 THEN ' ' || {TICKER} ELSE 'none' || CAST(k AS STRING) END",
                "current_price": f"CASE WHEN k % 12 = 0 THEN '0' ELSE {money('cents')} END",
                "market_cap": f"'$' || {thousands(DOLLARS)}",
            },
        ),
    }


class RawTables(Mapping):
    """The six raw tables, each planned when asked for.  Two or three share a base, which is written once then."""

    def __init__(self, star: Star):
        self._star, self._columns = star, raw_columns(lambda n: f"format_number({n}, 0)")
        self._bases: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        base, twice, columns = self._columns[name]
        if base not in self._bases:
            self._bases[base] = settle({"customer_base": customer_base, "supplier_base": supplier_base}[base](self._star), base)
        copies = f"CASE WHEN {twice} THEN array(0, 1) ELSE array(0) END" if twice else "array(0)"
        rows = self._bases[base].withColumn("copy", F.explode(F.expr(copies)))
        return rows.selectExpr(*[f"{e} AS {column}" for column, e in columns.items()])

    def __iter__(self):
        return iter(self._columns)

    def __len__(self) -> int:
        return len(self._columns)


def raw_sql() -> str:
    parts = []
    for name, (base, twice, columns) in raw_columns(lambda n: f"format('{{:,}}', {n})").items():
        selected = ", ".join(f"{e} AS {column}" for column, e in columns.items())
        copies = f"copy = 0 OR {twice}" if twice else "copy = 0"
        parts.append(f"{name} AS (SELECT {selected} FROM {base} JOIN (VALUES (0), (1)) v(copy) ON {copies})")
    return ",\n".join(parts)
