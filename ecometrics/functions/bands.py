"""Threshold bands: an ordered list of rules, the first that holds names the band."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ecometrics.functions.text import as_column

Rule = tuple[str, Any, str]

TESTS = {
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "=": operator.eq,
    "like": lambda column, pattern: column.like(pattern),
    "in": lambda column, members: column.isin(list(members)),
}


def band(
    value: Column | str,
    rules: Sequence[Rule],
    otherwise: Column | str | None = None,
    missing: str | None = None,
) -> Column:
    """Label of the first rule ``(test, limit, label)`` that holds.

    ``missing`` labels NULL.  Without it NULL fails every rule and takes the
    ``otherwise`` label, like any value that no rule covers.  A limit may be a
    column, for bands relative to a group.
    """
    column = as_column(value)
    rest = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    for test, limit, name in reversed(rules):
        rest = F.when(TESTS[test](column, limit), F.lit(name)).otherwise(rest)
    if missing is not None:
        rest = F.when(column.isNull(), F.lit(missing)).otherwise(rest)
    return rest


# Limits and labels of the bands.
INSUFFICIENT = "Données insuffisantes"
NOT_RATED = "Non évalué"
NOT_CLASSIFIED = "Non classifiée"

IMPACT_RULES = [
    ("<", 0.0001, "Très faible impact"),
    ("<", 0.001, "Faible impact"),
    ("<", 0.01, "Impact modéré"),
    ("<", 0.1, "Impact élevé"),
]
IMPACT_OTHERWISE = "Impact très élevé"

ECOLOGY_RULES = [
    ("=", 0, "Impact zéro"),
    ("<", 0.000001, "Impact négligeable"),
    ("<", 0.00001, "Très faible impact"),
    ("<", 0.0001, "Faible impact"),
    ("<", 0.001, "Impact modéré"),
]
ECOLOGY_OTHERWISE = "Impact élevé"

SIZE_RULES = [
    (">=", 10000, "Large Cap (>10B)"),
    (">=", 2000, "Mid Cap (2-10B)"),
    (">", 0, "Small Cap (<2B)"),
]

ESG_RULES = [
    (">=", 40, "ESG Excellent"),
    (">=", 35, "ESG Très bon"),
    (">=", 30, "ESG Bon"),
    (">=", 25, "ESG Moyen"),
]
ESG_OTHERWISE = "ESG À améliorer"

REGION_RULES = [
    ("=", "North America", "Amérique du Nord"),
    ("=", "Europe", "Europe"),
    ("=", "Asia", "Asie"),
    ("like", "%America%", "Amérique Latine"),
    ("like", "%Africa%", "Afrique"),
    ("like", "%Pacific%", "Asie-Pacifique"),
    ("in", ("Australia", "Oceania"), "Asie-Pacifique"),
]

PERFORMANCE_RULES = [
    (">=", 40, "Leader environnemental"),
    (">=", 30, "Très bonne performance"),
    (">=", 20, "Bonne performance"),
    (">=", 10, "Performance moyenne"),
]
PERFORMANCE_OTHERWISE = "Performance à améliorer"

EMISSION_RULES = [
    ("=", 0, "Zéro émission"),
    ("<", 0.1, "Très faibles émissions"),
    ("<", 1, "Faibles émissions"),
    ("<", 10, "Émissions modérées"),
]
EMISSION_OTHERWISE = "Émissions élevées"

MAJOR_COINS = ("btc", "eth", "ltc", "xrp", "bch")
SCORE_TIERS = [(">=", 80, "tier 1"), (">=", 70, "tier 2"), (">=", 60, "tier 3")]


def impact_band(emissions: Column | str) -> Column:
    return band(emissions, IMPACT_RULES, IMPACT_OTHERWISE)


def ecology_band(emissions: Column | str) -> Column:
    return band(emissions, ECOLOGY_RULES, ECOLOGY_OTHERWISE, missing=INSUFFICIENT)


def size_band(market_cap: Column | str) -> Column:
    return band(market_cap, SIZE_RULES, NOT_CLASSIFIED)


def esg_band(score: Column | str) -> Column:
    return band(score, ESG_RULES, ESG_OTHERWISE, missing=NOT_RATED)


def region_band(region: Column | str) -> Column:
    return band(region, REGION_RULES, as_column(region))


def performance_band(score: Column | str) -> Column:
    return band(score, PERFORMANCE_RULES, PERFORMANCE_OTHERWISE, missing=NOT_RATED)


def emission_band(emissions: Column | str) -> Column:
    return band(emissions, EMISSION_RULES, EMISSION_OTHERWISE, missing=NOT_RATED)


def coin_class(symbol: Column | str) -> Column:
    return band(symbol, [("in", MAJOR_COINS, "Crypto Majeure")], "Crypto Alternative")


def score_tier(score: Column | str) -> Column:
    return band(score, SCORE_TIERS, "tier 4")


def efficiency_band(emissions: Column | str, efficiency: Column | str, mean: Column | str) -> Column:
    """Band relative to the mean of the group; positive emissions without an efficiency rank last."""
    load, average = as_column(emissions), as_column(mean)
    against_mean = band(
        efficiency,
        [(">", average * 2, "Très efficace"), (">", average, "Efficace"), (">", 0, "Moyenne")],
        "Inefficace",
    )
    return band(load, [("=", 0, "Impact zéro")], against_mean, missing=INSUFFICIENT)
