"""Numeric text functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from weighline import settings as S


def safe_double(text: Column, decimal_comma: bool = False) -> Column:
    """Text to double; anything that is not a plain number becomes null.

    ``decimal_comma`` accepts European decimals such as ``0,500``.
    """
    value = text.cast("string")
    if decimal_comma:
        value = F.replace(value, F.lit(","), F.lit("."))
    return F.when(value.rlike(S.NUMBER_PATTERN), F.btrim(value).try_cast("double"))


def safe_bigint(text: Column) -> Column:
    """Text to bigint, truncating fractions; bad text becomes null."""
    return safe_double(text).try_cast("bigint")


def weight_text_grams(text: Column) -> Column:
    """Grams from free text such as ``1,5 kg`` or ``1 250 g``; null when no weight is found."""
    number = F.regexp_replace(F.regexp_extract(text, S.WEIGHT_TEXT_PATTERN, 1), r"\s", "")
    unit = F.lower(F.regexp_extract(text, S.WEIGHT_TEXT_PATTERN, 2))
    return safe_double(number, decimal_comma=True) * F.when(unit == "kg", 1000.0).otherwise(1.0)


def half_up(value: Column, digits: int) -> Column:
    """Round half up in plain floating point, so that every engine gets the same digits."""
    scale = float(10 ** digits)
    return F.floor(value * scale + 0.5) / scale
