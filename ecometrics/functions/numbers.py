"""Numbers out of messy text.

Each cleaner takes raw *text*.  A number is never turned back into text,
because the way a double is printed differs between engines.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ecometrics.functions.text import as_column, clean_text, trimmed

DECIMAL_LITERAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_LITERAL = r"^[+-]?[0-9]+$"
SCIENTIFIC_LITERAL = r"^[0-9]+\.[0-9]+e[+-][0-9]+$"
NOT_NUMERIC = r"[^0-9.\-e]"
NOT_DIGIT_OR_POINT = r"[^0-9.]"
UPPER_EXPONENT = r"(?<=[0-9.])E(?=[+-]?[0-9])"

# Magnitude suffixes.
MAGNITUDES = {"k": 1e3, "m": 1e6, "b": 1e9}
BILLIONS = {"b": 1e9}


def plain_number(value: Column | str) -> Column:
    """A decimal literal, else NULL; refuses what only some engines accept (5d, NaN, 1_000)."""
    text = trimmed(value)
    return F.when(text.rlike(DECIMAL_LITERAL), text.try_cast("double"))


def stripped_number(value: Column | str, strict: bool = False) -> Column:
    """Drop everything that cannot belong to a number, then parse.

    Only a lower-case exponent mark survives the stripping.  Unless ``strict``,
    an upper-case one standing inside a number is lowered first.  What is left
    holds no letter a cast could take for a type suffix or a special value.
    """
    text = as_column(value)
    if not strict:
        lowered = F.regexp_replace(text, UPPER_EXPONENT, "e")
        text = F.when(F.contains(text, F.lit("E")), lowered).otherwise(text)
    return F.regexp_replace(text, NOT_NUMERIC, "").try_cast("double")


def unsigned_amount(value: Column | str) -> Column:
    """Keep digits and points only; sign and exponent are lost."""
    return F.regexp_replace(as_column(value), NOT_DIGIT_OR_POINT, "").try_cast("double")


def suffixed_number(value: Column | str, magnitudes: Mapping[str, float]) -> Column:
    """``1.5k`` and the like; text without a known suffix is parsed as it is."""
    text = F.lower(as_column(value))
    result = plain_number(text)
    for suffix, factor in magnitudes.items():
        head = F.left(text, F.length(text) - len(suffix))
        result = F.when(F.endswith(text, F.lit(suffix)), plain_number(head) * F.lit(factor)).otherwise(result)
    return result


def currency_amount(
    value: Column | str, magnitudes: Mapping[str, float] = MAGNITUDES, strict: bool = False
) -> Column:
    """Currency text first, magnitude suffix second: ``$1.5B`` is 1.5."""
    text = as_column(value)
    has_mark = F.contains(text, F.lit("$")) | F.contains(text, F.lit(","))
    return F.when(has_mark, stripped_number(text, strict)).otherwise(suffixed_number(text, magnitudes))


def percent_number(value: Column | str) -> Column:
    return plain_number(F.replace(as_column(value), F.lit("%"), F.lit("")))


def is_scientific(value: Column | str) -> Column:
    return as_column(value).rlike(SCIENTIFIC_LITERAL)


def whole_number(value: Column | str) -> Column:
    text = clean_text(value)
    return F.when(text.rlike(INTEGER_LITERAL), text.try_cast("bigint"))


def first_number(value: Column | str) -> Column:
    """The first run of digits and points in free text: ``< 0.01 kW`` is 0.01."""
    return plain_number(F.regexp_extract(as_column(value), r"([0-9.]+)", 1))


def rounded_long(value: Column | str) -> Column:
    """Double to integer, halves away from zero (a bare cast would truncate)."""
    return F.round(as_column(value)).try_cast("bigint")
