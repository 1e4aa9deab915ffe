import math

import pytest
from pyspark.sql import functions as F

from ecometrics.functions import bands, calendar, measures, numbers, text


def test_blank_text_is_null_everywhere(values):
    blanks = [None, "", "  ", "\t "]
    for cleaner in (
        text.clean_text,
        text.clean_lower,
        text.clean_upper,
        numbers.plain_number,
        numbers.stripped_number,
        numbers.unsigned_amount,
        numbers.currency_amount,
        numbers.percent_number,
        numbers.whole_number,
        numbers.first_number,
    ):
        assert values(cleaner, blanks) == [None] * 4, cleaner.__name__


def test_text_normalisers(values):
    assert values(text.clean_lower, ["\tBTC ", " Eth　"]) == ["btc", "eth"]
    assert values(text.clean_upper, [" tsla"]) == ["TSLA"]
    listed = ["Not Listed", " Not Listed ", "not listed", "Not Listed*"]
    replaced = values(lambda c: text.clean_upper(c, {"Not Listed": "UNLISTED"}), listed)
    assert replaced == ["UNLISTED", "UNLISTED", "NOT LISTED", "NOT LISTED*"]


@pytest.mark.parametrize(
    "cleaner, given, expected",
    [
        (numbers.plain_number, "0", 0.0),
        (numbers.plain_number, "3.6e-05", 3.6e-05),
        (numbers.plain_number, "5d", None),
        (numbers.plain_number, "NaN", None),
        (numbers.plain_number, "inf", None),
        (numbers.plain_number, "1_000", None),
        (numbers.plain_number, ".5", 0.5),
        (numbers.plain_number, "5.", 5.0),
        (numbers.plain_number, "N/A", None),
        (numbers.stripped_number, "0", 0.0),
        (numbers.stripped_number, "$1,955,659,623,788", 1955659623788.0),
        (numbers.stripped_number, "3.6e-05", 3.6e-05),
        (numbers.stripped_number, "1.5E-7", 1.5e-7),
        (numbers.stripped_number, "USD 12.5", 12.5),
        (numbers.stripped_number, "5 EUR", 5.0),
        (numbers.stripped_number, "N/A", None),
        (lambda c: numbers.stripped_number(c, strict=True), "1.5E-7", None),
        (numbers.unsigned_amount, "0", 0.0),
        (numbers.unsigned_amount, "$1,955,659,623,788", 1955659623788.0),
        (numbers.unsigned_amount, "-5", 5.0),
        (numbers.unsigned_amount, "3.6e-05", 3.605),
        (numbers.currency_amount, "1.5k", 1500.0),
        (numbers.currency_amount, "2M", 2e6),
        (numbers.currency_amount, "3b", 3e9),
        (numbers.currency_amount, "$1.5B", 1.5),
        (numbers.currency_amount, "k", None),
        (lambda c: numbers.currency_amount(c, numbers.BILLIONS), "81.5B", 8.15e10),
        (lambda c: numbers.currency_amount(c, numbers.BILLIONS), "81.5k", None),
        (numbers.percent_number, "-7%", -7.0),
        (numbers.percent_number, "-7", -7.0),
        (numbers.whole_number, "12", 12),
        (numbers.whole_number, "12.5", None),
        (numbers.whole_number, "abc", None),
        (numbers.whole_number, "99999999999999999999", None),
        (numbers.first_number, "< 0.01 kW", 0.01),
        (numbers.first_number, "none", None),
    ],
)
def test_number_vectors(values, cleaner, given, expected):
    assert values(cleaner, [given]) == [expected]


def test_scientific_notation(values):
    assert values(numbers.is_scientific, ["3.6e-05", "3e-05", "3.6E-05", "36"]) == [True, False, False, False]


def test_halves_round_away_from_zero(spark):
    row = spark.range(1).select(
        *[numbers.rounded_long(F.lit(x)).alias(n) for n, x in (("a", 2.5), ("b", -2.5), ("c", 0.5), ("d", 2.4))]
    )
    assert tuple(row.first()) == (3, -3, 1, 2)


def test_labels(spark):
    df = spark.createDataFrame([("TSLA", "Tesla")], "ticker string, company string")
    labelled = df.select(text.label("ticker", "company").alias("label"))
    parts = labelled.select("label", text.label_part("label", 1), text.label_part("label", 2), text.label_part("label", 3))
    assert tuple(parts.first()) == ("TSLA - Tesla", "TSLA", "Tesla", None)


def test_days(values):
    days = values(calendar.parsed_day, ["2025-02-13", "no day", None])
    assert str(days[0]) == "2025-02-13" and days[1:] == [None, None]


@pytest.fixture(scope="module")
def amounts(spark):
    rows = [(1, 10.0, 2.0), (2, 10.0, 0.0), (3, None, 2.0), (4, -10.0, 2.0), (5, 10.0, None), (6, 0.0, 0.0)]
    return spark.createDataFrame(rows, "i int, a double, b double")


def results(df, column):
    return [row.y for row in df.select("i", column.alias("y")).orderBy("i").collect()]


def test_guards(amounts):
    assert results(amounts, measures.positive_ratio("a", "b")) == [5.0, None, None, None, None, None]
    assert results(amounts, measures.divided("a", "b")) == [5.0, None, None, -5.0, None, None]
    assert results(amounts, measures.zero_as_null("b")) == [2.0, None, 2.0, 2.0, None, None]
    assert results(amounts, measures.capped("a", 3)) == [3.0, 3.0, None, -10.0, 3.0, 0.0]
    assert results(amounts, measures.floored("a", 3)) == [10.0, 10.0, None, 3.0, 10.0, 3.0]
    assert results(amounts, measures.scaled_if_positive("a", 2)) == [20.0, 20.0, None, None, 20.0, None]


def test_penalised_score(spark):
    rows = [(1, 37, 1.2), (2, 42, 68.0), (3, 30, None), (4, None, 1.0), (5, None, None)]
    df = spark.createDataFrame(rows, "i int, esg bigint, co2 double")
    found = results(df, measures.penalised_score("esg", "co2"))
    assert found[:3] == [pytest.approx(32.56), 21.0, 30.0] and found[3:] == [None, None]


def test_inverse_share_score_is_null_for_the_ignored_highest(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.00005), (3, None), (4, 0.0001)], "i int, co2 double")
    assert results(df, measures.inverse_share_score("co2", F.lit(0.0001))) == [100.0, None, None, None]
    assert results(df, measures.inverse_share_score("co2", F.lit(0.0002)))[1] == pytest.approx(75.0)


def test_class_relative_measures(spark):
    df = spark.createDataFrame([(1, 6.0, 4.0, 2.0, 2.0, 8.0), (2, 6.0, 0.0, 0.0, 6.0, 6.0)],
                               "i int, x double, mean double, sd double, low double, high double")
    assert results(df, measures.relative_to_mean("x", "mean")) == [1.5, None]
    assert results(df, measures.z_score("x", "mean", "sd")) == [1.0, None]
    assert results(df, measures.min_max_score("x", "low", "high"))[1] is None
    assert math.isclose(results(df, measures.min_max_score("x", "low", "high"))[0], 100 * 4 / 6)


def test_bands(spark):
    def of(column_function, *inputs):
        df = spark.createDataFrame(list(enumerate(inputs)), "i int, x double")
        return results(df, column_function("x"))

    assert of(bands.impact_band, 0.0, 0.0001, 0.005, 0.05, 70.0, None) == [
        "Très faible impact", "Faible impact", "Impact modéré", "Impact élevé", "Impact très élevé", "Impact très élevé",
    ]
    assert of(bands.ecology_band, None, 0.0, 9e-10, 2e-6, 2e-5, 2e-4, 2e-3) == [
        "Données insuffisantes", "Impact zéro", "Impact négligeable", "Très faible impact", "Faible impact",
        "Impact modéré", "Impact élevé",
    ]
    assert of(bands.size_band, None, -1.0, 0.0, 1.0, 2000.0, 10000.0) == [
        "Non classifiée", "Non classifiée", "Non classifiée", "Small Cap (<2B)", "Mid Cap (2-10B)", "Large Cap (>10B)",
    ]
    assert of(bands.esg_band, None, 22.0, 25.0, 30.0, 35.0, 40.0) == [
        "Non évalué", "ESG À améliorer", "ESG Moyen", "ESG Bon", "ESG Très bon", "ESG Excellent",
    ]
    assert of(bands.emission_band, None, 0.0, 0.05, 0.5, 5.0, 50.0) == [
        "Non évalué", "Zéro émission", "Très faibles émissions", "Faibles émissions", "Émissions modérées",
        "Émissions élevées",
    ]
    assert of(bands.performance_band, None, 5.0, 10.0, 20.0, 30.0, 40.0) == [
        "Non évalué", "Performance à améliorer", "Performance moyenne", "Bonne performance", "Très bonne performance",
        "Leader environnemental",
    ]
    assert of(bands.score_tier, 85.0, 70.0, 60.0, 59.0) == ["tier 1", "tier 2", "tier 3", "tier 4"]


def test_region_and_coin_bands(values):
    regions = ["North America", "South America", "Europe", "West Africa", "Asia", "Asia Pacific", "Oceania", "Mars", None]
    assert values(bands.region_band, regions) == [
        "Amérique du Nord", "Amérique Latine", "Europe", "Afrique", "Asie", "Asie-Pacifique", "Asie-Pacifique", "Mars", None,
    ]
    assert values(bands.coin_class, ["btc", "ada", None]) == ["Crypto Majeure", "Crypto Alternative", "Crypto Alternative"]


def test_efficiency_band(spark):
    rows = [(1, None, 9.0, 1.0), (2, 0.0, 9.0, 1.0), (3, 1.0, 2.1, 1.0), (4, 1.0, 1.5, 1.0), (5, 1.0, 0.5, 1.0),
            (6, 1.0, None, 1.0), (7, 1.0, 0.0, 1.0), (8, 1.0, 5.0, None)]
    df = spark.createDataFrame(rows, "i int, co2 double, eff double, mean double")
    assert results(df, bands.efficiency_band("co2", "eff", "mean")) == [
        "Données insuffisantes", "Impact zéro", "Très efficace", "Efficace", "Moyenne", "Inefficace", "Inefficace", "Moyenne",
    ]
