"""The fifteen models over raw text tables derived from customers and suppliers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecometrics.operators.statistics import TIES
from ecometrics.plans import marts
from ecometrics.plans.build import LAYERS, Models
from ecometrics.session import scratch_path
from ecometrics.sources.tables import read_table
from workload.registry import Star, agreed, agreed_sql, query
from workload.star import BASE_SQL, RawTables, raw_sql

LOADED_AT = "2025-03-01 06:00:00"
AS_OF = "2025-03-01"
BLANKS = "E' \\t\\n\\r'"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def models(star: Star, **options) -> Models:
    loaded_at = F.lit(LOADED_AT).cast("timestamp_ntz")
    return Models(RawTables(star), loaded_at=loaded_at, as_of=F.lit(AS_OF).cast("date"), **options)


def sql_text(c: str) -> str:
    return f"nullif(trim({c}, {BLANKS}), '')"


def sql_number(c: str) -> str:
    return f"CASE WHEN regexp_matches(trim({c}, {BLANKS}), '{NUMBER}') THEN TRY_CAST(trim({c}, {BLANKS}) AS DOUBLE) END"


def sql_integer(c: str) -> str:
    return f"CASE WHEN regexp_matches(trim({c}, {BLANKS}), '^[+-]?[0-9]+$') THEN TRY_CAST(trim({c}, {BLANKS}) AS BIGINT) END"


def sql_stripped(c: str) -> str:
    lowered = rf"regexp_replace({c}, '([0-9.])E([+-]?[0-9])', '\1e\2', 'g')"
    return sql_number(rf"regexp_replace({lowered}, '[^0-9.\-e]', '', 'g')")


def sql_suffixed(c: str, **factors: int) -> str:
    branches = " ".join(
        f"WHEN lower({c}) LIKE '%{s}' THEN ({sql_number(f'left({c}, length({c}) - 1)')}) * {float(f)}" for s, f in factors.items()
    )
    return f"CASE WHEN regexp_matches({c}, '[$,]') THEN {sql_stripped(c)} {branches} ELSE {sql_number(c)} END"


def sql_positive(a: str, b: str) -> str:
    return f"CASE WHEN {a} > 0 AND {b} > 0 THEN {a} / {b} END"


STAGING_SQL = f"""
stg_coincap_prices AS (
  SELECT lower({sql_text('coin')}) AS coin, {sql_stripped('price_usd')} AS price_usd, TIMESTAMP '{LOADED_AT}' AS loaded_at
  FROM raw_coincap_prices),
stg_finnhub_financials AS (
  SELECT upper({sql_text('ticker')}) AS ticker, {sql_stripped('current_price')} AS current_price,
         {sql_stripped('market_cap')} AS market_cap, TIMESTAMP '{LOADED_AT}' AS loaded_at
  FROM raw_finnhub_financials),
stg_green_crypto AS (
  SELECT {sql_text('coin')} AS coin_name, lower({sql_text('symbol')}) AS symbol, {sql_number('price')} AS price,
         {sql_number('change')} AS price_change, {sql_number("replace(percent_change, '%', '')")} AS percent_change,
         {sql_number('high_24h')} AS high_24h, {sql_number('low_24h')} AS low_24h, {sql_number('open_24h')} AS open_24h,
         {sql_number('previous_close_24h')} AS previous_close_24h, {sql_integer('"timestamp"')} AS "timestamp",
         TIMESTAMP '{LOADED_AT}' AS loaded_at
  FROM raw_green_crypto),
stg_green_crypto_carbon AS (
  SELECT coin AS coin_name, symbol, consensus AS asset_type,
         {sql_number("regexp_replace(market_cap, '[^0-9.]', '', 'g')")} AS market_cap,
         {sql_number('electrical_power')} AS electrical_power_gw,
         {sql_number('electricity_consumption')} AS electricity_consumption_gw,
         {sql_number('co2_emissions')} AS co2_emissions_mt, TIMESTAMP '{LOADED_AT}' AS loaded_at
  FROM raw_green_crypto_carbon),
stg_green_stock AS (
  SELECT {sql_integer('id')} AS id, {sql_text('company')} AS company_name, upper({sql_text('ticker')}) AS ticker,
         {sql_text('category')} AS category, {sql_text('stock_exchange')} AS stock_exchange,
         {sql_suffixed('market_cap', k=10**3, m=10**6, b=10**9)} AS market_cap, {sql_integer('esg_score')} AS esg_score,
         {sql_suffixed('revenue', b=10**9)} AS revenue_billions, {sql_text('main_focus')} AS main_focus,
         {sql_text('region')} AS region, {sql_integer('year_founded')} AS year_founded, TIMESTAMP '{LOADED_AT}' AS loaded_at
  FROM raw_green_stock),
stg_green_stock_carbon AS (
  SELECT {sql_integer('id')} AS id, {sql_text('company')} AS company_name,
         CASE WHEN {sql_text('ticker')} = 'Not Listed' THEN 'UNLISTED' ELSE upper({sql_text('ticker')}) END AS ticker,
         {sql_stripped('electricity_consumption')} AS electricity_consumption_gwh,
         {sql_stripped('co2_emissions')} AS co2_emissions_mt, {sql_stripped('electrical_power')} AS electrical_power_gwh,
         TIMESTAMP '{LOADED_AT}' AS loaded_at
  FROM raw_green_stock_carbon)"""


def threshold_sql(c: str, operator: str, *bands: tuple[float, str], rest: str, missing: str | None = None) -> str:
    head = f"WHEN {c} IS NULL THEN '{missing}' " if missing else ""
    return "CASE " + head + " ".join(f"WHEN {c} {operator} {x} THEN '{n}'" for x, n in bands) + f" ELSE '{rest}' END"


# Fixed values down to EMISSION_SQL: labels and limits of the bands.  The rules are stated here once more, in
# another form, as a counterpart that does not share the library's code.
IMPACT_SQL = threshold_sql(
    "co2_emissions_mt", "<", (1e-4, "Très faible impact"), (1e-3, "Faible impact"), (1e-2, "Impact modéré"),
    (0.1, "Impact élevé"), rest="Impact très élevé",
)
ECOLOGY_SQL = threshold_sql(
    "co2_emissions_mt", "<", (1e-6, "Impact négligeable"), (1e-5, "Très faible impact"), (1e-4, "Faible impact"),
    (1e-3, "Impact modéré"), rest="Impact élevé", missing="Données insuffisantes",
)
SIZE_SQL = "CASE WHEN market_cap > 0 THEN " + threshold_sql(
    "market_cap", ">=", (10000, "Large Cap (>10B)"), (2000, "Mid Cap (2-10B)"), rest="Small Cap (<2B)"
) + " ELSE 'Non classifiée' END"
ESG_SQL = threshold_sql(
    "esg_score", ">=", (40, "ESG Excellent"), (35, "ESG Très bon"), (30, "ESG Bon"), (25, "ESG Moyen"),
    rest="ESG À améliorer", missing="Non évalué",
)
REGION_SQL = """CASE region WHEN 'North America' THEN 'Amérique du Nord' WHEN 'Asia' THEN 'Asie'
  WHEN 'Australia' THEN 'Asie-Pacifique' WHEN 'Oceania' THEN 'Asie-Pacifique' ELSE
  CASE WHEN contains(region, 'America') THEN 'Amérique Latine' WHEN contains(region, 'Africa') THEN 'Afrique'
       WHEN contains(region, 'Pacific') THEN 'Asie-Pacifique' ELSE region END END"""
PERFORMANCE_SQL = threshold_sql(
    "combined_environmental_score", ">=", (40, "Leader environnemental"), (30, "Très bonne performance"),
    (20, "Bonne performance"), (10, "Performance moyenne"), rest="Performance à améliorer", missing="Non évalué",
)
EMISSION_SQL = threshold_sql(
    "co2_emissions_mt", "<", (0.1, "Très faibles émissions"), (1, "Faibles émissions"), (10, "Émissions modérées"),
    rest="Émissions élevées", missing="Non évalué",
)

ASSET_SQL = f"""
int_crypto_metrics AS (
  SELECT coalesce(q.coin_name, f.coin_name) AS coin_name, coalesce(q.symbol, f.symbol) AS symbol, price_usd,
         price AS green_price, percent_change, market_cap, electricity_consumption_gw, co2_emissions_mt,
         {sql_positive('market_cap', 'co2_emissions_mt')} AS market_cap_per_co2,
         CASE WHEN co2_emissions_mt > 0 THEN co2_emissions_mt * 1000000.0::DOUBLE END AS co2_emissions_tonnes,
         {IMPACT_SQL} AS environmental_impact_category
  FROM stg_green_crypto q
  LEFT JOIN stg_green_crypto_carbon f ON lower(trim(q.symbol, {BLANKS})) = lower(trim(f.symbol, {BLANKS}))
  LEFT JOIN stg_coincap_prices p ON lower(trim(q.coin_name, {BLANKS})) = p.coin),
int_stock_metrics AS (
  SELECT *, {sql_positive('revenue_billions', 'co2_emissions_mt')} AS revenue_per_co2,
         {sql_positive('market_cap', 'co2_emissions_mt')} AS market_cap_per_co2,
         {sql_positive('revenue_billions', 'electricity_consumption_gwh')} AS revenue_per_gwh,
         CASE WHEN co2_emissions_mt IS NULL THEN esg_score::DOUBLE
              ELSE esg_score::DOUBLE * (1.0::DOUBLE - CASE WHEN co2_emissions_mt / 10 < 0.5 THEN co2_emissions_mt / 10 ELSE 0.5 END)
         END AS combined_environmental_score
  FROM (SELECT s.id, s.company_name, s.ticker, category, stock_exchange, coalesce(s.market_cap, x.market_cap) AS market_cap,
               esg_score, revenue_billions, main_focus, region, year_founded, electricity_consumption_gwh,
               co2_emissions_mt, electrical_power_gwh, current_price
        FROM stg_green_stock s LEFT JOIN stg_green_stock_carbon c ON c.id = s.id
        LEFT JOIN stg_finnhub_financials x ON x.ticker = s.ticker)),
dim_cryptocurrencies AS (
  SELECT coin_name, symbol, price_usd, green_price, percent_change, market_cap, environmental_impact_category
  FROM int_crypto_metrics),
fact_crypto_environmental AS (
  SELECT coin_name, symbol, electricity_consumption_gw, co2_emissions_mt, co2_emissions_tonnes, market_cap_per_co2,
         CASE WHEN symbol = 'btc' THEN 1.0 ELSE co2_emissions_mt / nullif(of_btc, 0) END::DOUBLE AS relative_emissions_to_bitcoin,
         CASE WHEN electricity_consumption_gw > 0 THEN market_cap / (electricity_consumption_gw * 1000000.0::DOUBLE) END AS market_cap_per_kwh,
         CASE WHEN co2_emissions_mt = 0 THEN 100.0
              ELSE 100.0::DOUBLE * (1.0::DOUBLE - co2_emissions_mt / nullif(of_all, 0.0001)) END::DOUBLE AS ecological_score,
         CASE WHEN co2_emissions_mt = 0 THEN 'Impact zéro' ELSE {ECOLOGY_SQL} END AS ecological_category,
         environmental_impact_category
  FROM int_crypto_metrics, (SELECT max(co2_emissions_mt) AS of_all,
       max(co2_emissions_mt) FILTER (WHERE symbol = 'btc') AS of_btc FROM int_crypto_metrics)),
dim_companies AS (
  SELECT id, company_name, ticker, category, stock_exchange, market_cap, esg_score, revenue_billions, main_focus, region,
         year_founded, current_price, 2025 - year_founded AS company_age, {SIZE_SQL} AS company_size,
         {ESG_SQL} AS esg_category, {REGION_SQL} AS region_group
  FROM int_stock_metrics),
fact_stock_environmental AS (
  SELECT id, company_name, ticker, electricity_consumption_gwh, co2_emissions_mt, electrical_power_gwh, revenue_per_co2,
         market_cap_per_co2, revenue_per_gwh, combined_environmental_score,
         combined_environmental_score * 2 AS normalized_environmental_score,
         CASE WHEN revenue_billions > 0 THEN co2_emissions_mt * 1000000.0::DOUBLE / (revenue_billions * 1000.0::DOUBLE) END AS carbon_intensity_tonnes_per_million,
         100.0::DOUBLE * (revenue_per_co2 / nullif(max(revenue_per_co2) OVER (), 0)) AS carbon_efficiency_percentile,
         {PERFORMANCE_SQL} AS environmental_performance_category,
         CASE WHEN co2_emissions_mt = 0 THEN 'Zéro émission' ELSE {EMISSION_SQL} END AS carbon_emission_category
  FROM int_stock_metrics),
green_investment_overview AS (
  SELECT 'Cryptocurrency' AS asset_type, d.coin_name AS asset_name, d.symbol AS asset_symbol, price_usd AS current_price,
         market_cap, co2_emissions_mt, electricity_consumption_gw AS energy_consumption,
         market_cap_per_co2 AS green_efficiency, ecological_score AS environmental_score,
         ecological_category AS environmental_category,
         CASE WHEN d.symbol IN ('btc', 'eth', 'ltc', 'xrp', 'bch') THEN 'Crypto Majeure' ELSE 'Crypto Alternative' END AS asset_subtype,
         CAST(round(ecological_score) AS BIGINT) AS estimated_esg, CAST(NULL AS VARCHAR) AS region,
         CAST(NULL AS BIGINT) AS year_founded, 'Digital Asset' AS main_focus
  FROM dim_cryptocurrencies d JOIN fact_crypto_environmental f ON d.coin_name = f.coin_name
  UNION ALL
  SELECT 'Stock', d.company_name, d.ticker, current_price, market_cap, co2_emissions_mt,
         electricity_consumption_gwh / 1000.0::DOUBLE, market_cap_per_co2, normalized_environmental_score,
         environmental_performance_category, category, esg_score, region, year_founded, main_focus
  FROM dim_companies d JOIN fact_stock_environmental f ON d.id = f.id)"""


def stats_sql(overview: str) -> str:
    """Mean, extremes, deviation and count of each class."""
    return f"""SELECT asset_type, avg(green_efficiency) AS mean, max(green_efficiency) AS high, min(green_efficiency) AS low,
      stddev_samp(green_efficiency) AS deviation, count(*) AS peers
    FROM {overview} WHERE green_efficiency IS NOT NULL GROUP BY asset_type"""


def metrics_sql(overview: str) -> str:
    """Every asset against its class, from a table shaped like the overview."""
    return f"""
carbon_efficiency_metrics AS (
  SELECT o.asset_type, asset_name, asset_symbol, current_price, market_cap, co2_emissions_mt, energy_consumption,
         green_efficiency, environmental_score, environmental_category,
         green_efficiency / nullif(mean, 0) AS relative_efficiency,
         (green_efficiency - mean) / nullif(deviation, 0) AS efficiency_z_score,
         100.0::DOUBLE * (green_efficiency - low) / nullif(high - low, 0) AS efficiency_percentile,
         row_number() OVER ranked AS efficiency_rank,
         (row_number() OVER ranked)::DOUBLE / nullif(peers, 0) * 100 AS efficiency_rank_percentile,
         CASE WHEN co2_emissions_mt = 0 THEN 'Impact zéro' WHEN green_efficiency > 2 * mean THEN 'Très efficace'
              WHEN green_efficiency > mean THEN 'Efficace' WHEN green_efficiency > 0 THEN 'Moyenne'
              ELSE 'Inefficace' END AS green_investment_category,
         co2_emissions_mt / nullif(market_cap / 1000000.0::DOUBLE, 0) AS carbon_intensity_per_million,
         market_cap / nullif(co2_emissions_mt * 1000000.0::DOUBLE, 0) AS eco_roi_usd_per_ton_co2,
         asset_subtype, estimated_esg, region, year_founded, main_focus
  FROM {overview} o LEFT JOIN (
    {stats_sql(overview)}) t ON t.asset_type = o.asset_type
  WHERE co2_emissions_mt IS NOT NULL
  WINDOW ranked AS (PARTITION BY o.asset_type ORDER BY green_efficiency DESC NULLS LAST, {', '.join(f'{c} NULLS FIRST' for c in TIES)}))"""


def comparison_sql(overview: str) -> str:
    totals = """count(*) AS total_assets, avg(co2_emissions_mt) AS avg_co2_emissions,
         sum(co2_emissions_mt) AS total_co2_emissions, avg(green_efficiency) AS avg_efficiency,
         avg(environmental_score) AS avg_environmental_score, sum(market_cap) AS total_market_cap,
         coalesce(sum(co2_emissions_mt), 0) / nullif(coalesce(sum(market_cap), 0), 0) * 1e6::DOUBLE AS carbon_intensity_per_million_usd,
         coalesce(sum(energy_consumption), 0) / nullif(coalesce(sum(market_cap), 0), 0) * 1e6::DOUBLE AS energy_intensity_per_million_usd"""
    return f"""
environmental_impact_comparison AS (
  SELECT asset_type, {totals} FROM {overview} GROUP BY asset_type
  UNION ALL SELECT asset_subtype, {totals} FROM {overview} GROUP BY asset_subtype
  UNION ALL SELECT 'Tous actifs', {totals} FROM {overview})"""


METRIC_DIGITS, METRIC_PLACES = ("relative_efficiency",), ("efficiency_z_score",)
COMPARISON_DIGITS = (
    "avg_co2_emissions",
    "total_co2_emissions",
    "avg_efficiency",
    "avg_environmental_score",
    "total_market_cap",
    "carbon_intensity_per_million_usd",
    "energy_intensity_per_million_usd",
)

PRELUDE = ",".join(
    [
        "WITH " + BASE_SQL,
        raw_sql(),
        STAGING_SQL,
        ASSET_SQL,
        metrics_sql("green_investment_overview"),
        comparison_sql("green_investment_overview"),
    ]
)


def from_models(selected: str, table: str) -> str:
    return f"{PRELUDE}\nSELECT {selected} FROM {table}"


def _register(name: str, extra: str = "", digits: tuple[str, ...] = (), places: tuple[str, ...] = ()) -> None:
    @query(from_models((agreed_sql(*digits, places=places) if digits else "*") + extra, name), name=name)
    def build(star: Star) -> DataFrame:
        return agreed(models(star)[name], *digits, places=places)


for plain in (
    "stg_coincap_prices",
    "stg_finnhub_financials",
    "stg_green_crypto",
    "stg_green_crypto_carbon",
    "stg_green_stock",
    "stg_green_stock_carbon",
    "int_crypto_metrics",
    "int_stock_metrics",
    "dim_cryptocurrencies",
    "fact_crypto_environmental",
    "dim_companies",
    "fact_stock_environmental",
    "green_investment_overview",
):
    _register(plain)
_register("carbon_efficiency_metrics", f", TIMESTAMP '{LOADED_AT}' AS analysis_timestamp", METRIC_DIGITS, METRIC_PLACES)
_register("environmental_impact_comparison", digits=COMPARISON_DIGITS)


def failures_sql(model: str, check: str, column: str, count: str) -> str:
    return f"SELECT '{model}' AS model, '{check}' AS \"check\", '{column}' AS \"column\", CAST(({count}) AS BIGINT) AS failures"


def nulls_sql(model: str, column: str) -> str:
    return failures_sql(model, "not_null", column, f"SELECT count(*) FROM {model} WHERE {column} IS NULL")


def repeats_sql(model: str, column: str) -> str:
    groups = f"SELECT {column} FROM {model} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
    return failures_sql(model, "unique", column, f"SELECT count(*) FROM ({groups})")


def strangers_sql(model: str, column: str, values: str) -> str:
    return failures_sql(model, "accepted_values", column, f"SELECT count(*) FROM {model} WHERE {column} NOT IN ({values})")


def orphans_sql(child: str, column: str, parent: str, parent_column: str) -> str:
    missing = f"NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_column} = c.{column})"
    return failures_sql(child, "relationships", column, f"SELECT count(*) FROM {child} c WHERE c.{column} IS NOT NULL AND {missing}")


# The columns declared not null.
NOT_NULL = (
    ("int_crypto_metrics", "coin_name"),
    ("int_crypto_metrics", "symbol"),
    ("int_stock_metrics", "id"),
    ("int_stock_metrics", "company_name"),
    ("int_stock_metrics", "ticker"),
    ("dim_cryptocurrencies", "coin_name"),
    ("dim_cryptocurrencies", "symbol"),
    ("fact_crypto_environmental", "coin_name"),
    ("dim_companies", "id"),
    ("dim_companies", "company_name"),
    ("dim_companies", "ticker"),
    ("fact_stock_environmental", "id"),
    ("green_investment_overview", "asset_name"),
    ("green_investment_overview", "asset_symbol"),
    ("environmental_impact_comparison", "asset_type"),
)
# The accepted labels.
IMPACTS = "'Très faible impact', 'Faible impact', 'Impact modéré', 'Impact élevé', 'Impact très élevé'"
CHECKS_SQL = "\nUNION ALL ".join(
    [
        *[
            nulls_sql(model, column)
            for model, column in NOT_NULL
        ],
        repeats_sql("int_stock_metrics", "id"),
        repeats_sql("dim_companies", "id"),
        strangers_sql("int_crypto_metrics", "environmental_impact_category", IMPACTS),
        strangers_sql("green_investment_overview", "asset_type", "'Cryptocurrency', 'Stock'"),
        orphans_sql("fact_crypto_environmental", "coin_name", "dim_cryptocurrencies", "coin_name"),
        orphans_sql("fact_stock_environmental", "id", "dim_companies", "id"),
    ]
)


@query(f"{PRELUDE}\n{CHECKS_SQL}")
def declared_checks(star):
    return models(star).check()


@query(
    from_models("*", "int_crypto_metrics").replace(
        "FROM raw_green_crypto_carbon)",
        f"FROM raw_green_crypto_carbon QUALIFY symbol IS NULL OR row_number() OVER (PARTITION BY lower(trim(symbol, {BLANKS})) "
        "ORDER BY coin_name, asset_type, market_cap, electrical_power_gw, electricity_consumption_gw, co2_emissions_mt, symbol) = 1)",
    )
)
def int_crypto_metrics_deduplicated(star):
    return models(star, dedupe=True)["int_crypto_metrics"]


@query(
    f"""{PRELUDE} SELECT coin_name, d.symbol, f.ecological_score FROM dim_cryptocurrencies d
    JOIN fact_crypto_environmental f USING (coin_name)"""
)
def dimension_meets_fact_by_name(star):
    built = models(star)
    pairs = marts.coin_pairs(built["dim_cryptocurrencies"], built["fact_crypto_environmental"])
    return pairs.select("coin_name", "symbol", "ecological_score")


@query(
    f"""{PRELUDE} SELECT id, d.esg_category, f.normalized_environmental_score FROM dim_companies d
    JOIN fact_stock_environmental f USING (id)"""
)
def dimension_meets_fact_by_id(star):
    built = models(star)
    pairs = marts.company_pairs(built["dim_companies"], built["fact_stock_environmental"])
    return pairs.select("id", "esg_category", "normalized_environmental_score")


COUNTED = [(layer, name) for layer, names in LAYERS.items() for name in names]


@query(
    f"{PRELUDE}\n"
    + " UNION ALL ".join(f"SELECT '{layer}' AS layer, '{name}' AS model, count(*) AS n FROM {name}" for layer, name in COUNTED)
)
def published_layers(star):
    """Every model written below its layer and counted from there."""
    paths = models(star).publish(scratch_path(star.spark, "layers"))
    counted = [
        read_table(star.spark, paths[name])
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(layer).alias("layer"), F.lit(name).alias("model"), "n")
        for layer, name in COUNTED
    ]
    return reduce(DataFrame.unionByName, counted)
