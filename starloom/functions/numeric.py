"""Strict text-to-number conversions. Bad text fails the job (ANSI casts)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from starloom.functions.text import blank_to_null

# Money has two decimals and overflows loudly past ten digits.
MONEY = T.DecimalType(10, 2)
# Stands for a decimal without declared scale, which Spark does not have: 20 digits before
# the point and 18 behind it. What does not fit fails.
MEASURE = T.DecimalType(38, 18)
# More digits behind the point, or an exponent that could hide them.
_TOO_FINE = r"(?i)\.\d{18}\d*[1-9]|\.\d+e|e-"


def money(text: Column) -> Column:
    return blank_to_null(text).cast(MONEY)


def measure(text: Column) -> Column:
    number = blank_to_null(text)
    refused = F.raise_error(F.concat(F.lit("more than 18 decimals: "), text)).cast(MEASURE)
    return F.when(number.isNull() | ~number.rlike(_TOO_FINE), number.cast(MEASURE)).otherwise(refused)


def money_sum(left: Column, right: Column) -> Column:
    """NULL when a side is NULL. The sum is one digit wider, so the bound is checked again."""
    return (left + right).cast(MONEY)


def whole_number(text: Column) -> Column:
    """Surrounding blanks are fine; a blank, ``1.0`` or ``1e3`` is not."""
    return text.cast(T.IntegerType())


def whole_number_or_null(text: Column) -> Column:
    """For looking at rows that may never be loaded; nothing fails."""
    return text.try_cast(T.IntegerType())
