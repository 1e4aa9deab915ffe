"""Text normalisers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode White_Space property.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trimmed(value: Column | str) -> Column:
    """Strip every kind of Unicode white space (Spark's own trim only strips blanks)."""
    return F.btrim(as_column(value), F.lit(WHITESPACE))


def clean_text(value: Column | str) -> Column:
    return F.nullif(trimmed(value), F.lit(""))


def clean_lower(value: Column | str) -> Column:
    return F.lower(clean_text(value))


def clean_upper(value: Column | str, sentinels: Mapping[str, str] | None = None) -> Column:
    """Upper-case code; ``sentinels`` are compared before the case is changed."""
    text = clean_text(value)
    result = F.upper(text)
    for found, replacement in (sentinels or {}).items():
        result = F.when(text == found, F.lit(replacement)).otherwise(result)
    return result


def join_key(value: Column | str) -> Column:
    """Key under which two differently written texts meet in a join."""
    return F.lower(trimmed(value))


def label(*parts: Column | str, separator: str = " - ") -> Column:
    return F.concat_ws(separator, *[as_column(part) for part in parts])


def label_part(value: Column | str, position: int, separator: str = " - ") -> Column:
    """The ``position``-th part (from 1) of a composed label, NULL when absent."""
    return F.nullif(F.split_part(as_column(value), F.lit(separator), F.lit(position)), F.lit(""))
