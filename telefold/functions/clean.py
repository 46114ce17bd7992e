"""Cleaning of ids, numbers, units and names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

BAD_NUMBER = -999.0


def strip_one_zero(ein: Column) -> Column:
    """Drop exactly one leading ``0`` from an engine id."""
    return F.when(ein.startswith("0"), F.substr(ein, F.lit(2))).otherwise(ein)


def java_suffix(text: Column) -> Column:
    """True for a text ending in a Java type suffix (``1F``, ``20d``).

    The JVM reads it as part of a number; in telemetry such a text is a hex byte and no number.
    """
    return text.endswith("d") | text.endswith("D") | text.endswith("f") | text.endswith("F")


def number(text: Column) -> Column:
    """Text to double, NULL when it is not a number."""
    return F.when(~java_suffix(text), text.try_cast("double"))


def number_or(text: Column, default: float = BAD_NUMBER) -> Column:
    """Text to double with a default for anything unreadable."""
    return F.coalesce(number(text), F.lit(default))


def number_or_blank(text: Column) -> Column:
    """Text to double; blank and unreadable both give NULL."""
    return number(F.nullif(F.trim(text), F.lit("")))


def fixed_decimal(value: Column, precision: int = 20, scale: int = 7) -> Column:
    """Decimal of the warehouse's width, NULL when the value does not fit or is no number."""
    return value.try_cast(f"decimal({precision},{scale})")


def null_default(value: Column, default: object) -> Column:
    return F.coalesce(value, F.lit(default))


def scaled(value: Column, multiplier: Column, offset: Column) -> Column:
    """``value * multiplier + offset``, with 1 and 0 where the scaling is unknown."""
    return value * F.coalesce(multiplier, F.lit(1.0)) + F.coalesce(offset, F.lit(0.0))


def within(value: Column, low: Column, high: Column) -> Column:
    """True inside the closed range; a NULL bound does not limit, a NULL value is outside."""
    return (
        value.isNotNull()
        & F.coalesce(value >= low, F.lit(True))
        & F.coalesce(value <= high, F.lit(True))
    )


def ranged(value: Column, low: Column, high: Column, default: Column) -> Column:
    return F.when(within(value, low, high), value).otherwise(default)


def snake_name(text: Column) -> Column:
    """Lower case with blanks and hyphens as underscores."""
    return F.regexp_replace(F.lower(text), "[ -]", "_")


def clean_unit(unit: Column) -> Column:
    """NULL for the spellings of "no unit": NULL, blank and ``-``."""
    trimmed = F.trim(unit)
    return F.when(~trimmed.isin("", "-"), trimmed)


def series_base(series: Column) -> Column:
    """A vehicle series without its optional suffix."""
    return F.regexp_replace(series, "系列$", "")


def starts_with_any(text: Column, prefixes: Iterable[str]) -> Column:
    """OR of prefix tests; each one is pushed to the scan as a string-prefix filter."""
    test = F.lit(False)
    for prefix in prefixes:
        test = test | text.startswith(prefix)
    return test
