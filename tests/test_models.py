"""The layered models on a few documented rows; expected values are derived by hand."""

import pytest
from pyspark.sql import functions as F

from ecometrics.plans.build import LAYER_OF, Models
from ecometrics.sources.schemas import SOURCES
from ecometrics.sources.tables import read_table

# All rows are invented; the label "Not Listed" and the coin "btc" are fixed values.
QUOTES = [
    ("Anvil", "btc", "8000", "-400", "-5", "8500", "7900", "8400", "8400", "1700000000"),
    ("Birch", "brc", "20", "-2", "-10%", "25", "19", "22", "22", "1700000000"),
    ("Twin Anvil", "tanv", "8000", "", "", "", "", "", "", ""),
    ("Mite", "mit", "0.00004", "0.000000", "-9", "0.00005", "0.00003", "0.00004", "0.00004", "1700000000"),
    ("Cedar", " CDR ", "30", "0", "1", "30", "30", "30", "30", "x"),
]
FOOTPRINT = [
    ("Anvil", "btc", "PoW", "$4,000,000,000", "1000.5", "2000.0", "8.0"),
    ("Birch", "brc", "PoS", "$500,000", "0.5", "0.5", "0.0002"),
    ("Twin Anvil", "tanv", "Token", "$25,000,000", "", "", ""),
    ("Twin Anvil", " TANV", "Token", "$25,000,000", "N/A", "N/A", ""),
    ("Cedar", "cdr", "PoW", "", "0.0", "6.25", "0.0"),
]
COMPANIES = [
    ("1", "Gale Works", "GALE", "Wind", "First Exchange", "600.5", "36", "80.0", "Turbines", "North America", "2005"),
    ("19", "Old Tar", "TAR", "Fuel", "Second Exchange", "100.0", "42", "200.0", "Transition", "Europe", "1900"),
    ("26", "Canal Trust", "CNL", "Infrastructure", "First Exchange", "", "23", "7.5", "Water", "North America", "2010"),
    ("70", "Sun Attic", "Not Listed*", "Solar", "Third Exchange", "0.5", "29", "0.2", "Panels", "Asia", "2015"),
]
COMPANY_FOOTPRINT = [
    ("1", "Gale Works", "GALE", "4000", "2.0", "4000.0"),
    ("19", "Old Tar", "TAR", "20000", "50", "9000.0"),
    ("26", "Canal Trust", "CNL", "100", "0.3", "1.0"),
    ("70", "Sun Attic", "Not Listed", "20", "0.05", "8000.0"),
]


def raw(spark, **rows):
    given = {
        "raw_green_crypto": QUOTES,
        "raw_green_crypto_carbon": FOOTPRINT,
        "raw_green_stock": COMPANIES,
        "raw_green_stock_carbon": COMPANY_FOOTPRINT,
        "raw_coincap_prices": [],
        "raw_finnhub_financials": [],
        **rows,
    }
    return {name: spark.createDataFrame(given[name], source.schema) for name, source in SOURCES.items()}


@pytest.fixture(scope="module")
def built(spark):
    return Models(raw(spark), as_of=F.lit("2025-03-01").cast("date"))


def keyed(df, key):
    return {r[key]: r for r in df.collect()}


def close(value):
    return pytest.approx(value, rel=1e-9)


def test_coins(built):
    coins = keyed(built["fact_crypto_environmental"], "symbol")
    anvil, birch, twin, cedar = (coins[s] for s in ("btc", "brc", "tanv", "cdr"))
    assert anvil.market_cap_per_co2 == close(5e8)
    assert anvil.market_cap_per_kwh == close(2.0)
    assert (anvil.relative_emissions_to_bitcoin, anvil.ecological_score) == (1.0, 0.0)
    assert (anvil.ecological_category, anvil.environmental_impact_category) == ("Impact élevé", "Impact très élevé")
    assert birch.market_cap_per_co2 == close(2.5e9)
    assert birch.relative_emissions_to_bitcoin == close(2.5e-05)
    assert birch.ecological_score == close(99.9975)
    assert (twin.ecological_category, twin.environmental_impact_category) == ("Données insuffisantes", "Impact très élevé")
    assert twin.ecological_score is None
    assert (cedar.ecological_score, cedar.ecological_category, cedar.market_cap_per_co2) == (100.0, "Impact zéro", None)
    assert coins["mit"].co2_emissions_mt is None


def test_companies(built):
    facts, dims = keyed(built["fact_stock_environmental"], "id"), keyed(built["dim_companies"], "id")
    gale, tar = facts[1], facts[19]
    assert gale.revenue_per_co2 == close(40.0)
    assert gale.market_cap_per_co2 == close(300.25)
    assert gale.revenue_per_gwh == close(0.02)
    assert gale.combined_environmental_score == close(28.8)
    assert gale.normalized_environmental_score == close(57.6)
    assert gale.carbon_intensity_tonnes_per_million == close(25.0)
    assert gale.carbon_efficiency_percentile == 100.0
    assert gale.environmental_performance_category == "Bonne performance"
    assert gale.carbon_emission_category == "Émissions modérées"
    assert tar.revenue_per_co2 == close(4.0)
    assert tar.market_cap_per_co2 == close(2.0)
    assert tar.combined_environmental_score == 21.0
    assert dims[1].company_size == "Small Cap (<2B)" and dims[1].esg_category == "ESG Très bon"
    assert dims[1].region_group == "Amérique du Nord" and dims[1].company_age == 20
    assert dims[26].company_size == "Non classifiée"
    assert dims[70].ticker == "NOT LISTED*"
    assert keyed(built["stg_green_stock_carbon"], "id")[70].ticker == "UNLISTED"


def test_duplicates_multiply_unless_dropped(spark, built):
    assert built["int_crypto_metrics"].count() == 6
    overview = built["green_investment_overview"]
    assert overview.filter("asset_type = 'Cryptocurrency'").count() == 4 + 4
    assert overview.filter("asset_type = 'Stock'").count() == 4
    single = Models(raw(spark), dedupe=True)
    assert single["int_crypto_metrics"].count() == 5
    assert single["green_investment_overview"].count() == 9


def test_feeds_fill_gaps(spark):
    models = Models(
        raw(
            spark,
            raw_coincap_prices=[("anvil ", "USD 8100.5"), ("cedar", "")],
            raw_finnhub_financials=[("cnl", "35", "$12,345.5")],
        )
    )
    assert keyed(models["int_crypto_metrics"], "symbol")["btc"].price_usd == 8100.5
    canal = keyed(models["int_stock_metrics"], "id")[26]
    assert (canal.market_cap, canal.current_price) == (12345.5, 35.0)


def test_lenient_and_strict_exponents(spark):
    feed = [("anvil", "1.5E-7")]
    for strict, expected in ((False, 1.5e-7), (True, None)):
        models = Models(raw(spark, raw_coincap_prices=feed), strict=strict)
        assert models["stg_coincap_prices"].first().price_usd == expected


def test_declared_checks(spark, built):
    found = {(r.model, r.check, r.column): r.failures for r in built.check().collect()}
    assert len(found) == 21 and set(found.values()) == {0}
    spoiled = raw(spark, raw_green_stock=[*COMPANIES, COMPANIES[0], (None, *COMPANIES[1][1:])])
    found = {(r.model, r.check, r.column): r.failures for r in Models(spoiled).check().collect()}
    assert found["int_stock_metrics", "unique", "id"] == 1
    assert found["int_stock_metrics", "not_null", "id"] == 1


def test_publish_writes_every_model_below_its_layer(spark, tmp_path):
    models = Models(raw(spark), as_of=F.lit("2025-03-01").cast("date"))
    paths = models.publish(str(tmp_path))
    assert set(paths) == set(LAYER_OF) and paths["dim_companies"].endswith("/marts_stock/dim_companies")
    counts = {name: read_table(spark, path).count() for name, path in paths.items()}
    assert counts["int_crypto_metrics"] == 6 and counts["green_investment_overview"] == 12
    # Three coins without emissions: four joined rows of the duplicated one, and Mite.
    assert counts["carbon_efficiency_metrics"] == 12 - 5
    assert counts["environmental_impact_comparison"] == 2 + 2 + 4 + 1


def test_output_columns(built):
    assert built["green_investment_overview"].dtypes[11:14] == [
        ("estimated_esg", "bigint"),
        ("region", "string"),
        ("year_founded", "bigint"),
    ]
    assert len(built["carbon_efficiency_metrics"].columns) == 24
    assert len(built["int_stock_metrics"].columns) == 19
