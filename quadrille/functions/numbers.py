"""Lenient numbers, ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .text import NBSP

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def as_number(col: Column) -> Column:
    """Text to double; anything that is not a plain finite number becomes null."""
    return F.regexp_extract(F.trim(col.cast("string")), _NUMBER, 0).try_cast("double")


def lenient_number(col: Column) -> Column:
    """Like :func:`as_number`, after deleting spaces and reading a decimal comma."""
    return as_number(F.translate(col.cast("string"), f",{NBSP} ", "."))


def number_in(df: DataFrame, name: str) -> Column:
    """A column as double: numeric columns as they are, text leniently."""
    kind = df.schema[name].dataType
    return F.col(f"`{name}`").cast("double") if isinstance(kind, NumericType) else lenient_number(F.col(f"`{name}`"))


def half_even(col: Column, digits: int) -> Column:
    """Round half to even on the binary value; one multiplication, no decimal detour."""
    if digits == 0:
        return F.rint(col)
    scale = F.lit(10.0**digits)
    return F.rint(col * scale) / scale


def finite(col: Column) -> Column:
    """A typed double with NaN read as missing."""
    return F.when(~F.isnan(col), col)


def whole(col: Column) -> Column:
    """A double holding a whole number as int; null otherwise."""
    return F.when(col == F.floor(col), col).try_cast("int")


def unit_price(value: Column, surface: Column) -> Column:
    return F.try_divide(value, surface)


def years_of_rent(price: Column, monthly_rent: Column) -> Column:
    return F.try_divide(price, monthly_rent * F.lit(12))


def percent_change(before: Column, after: Column, digits: int | None = 4) -> Column:
    change = F.try_divide(after - before, before) * 100
    return change if digits is None else half_even(change, digits)


def clip(col: Column, low: float, high: float) -> Column:
    """Bound a value; a missing value stays missing."""
    return F.when(col.isNotNull(), F.least(F.greatest(col, F.lit(low)), F.lit(high)))


def mean_available(*cols: Column) -> Column:
    """Mean of the values that are present; null when none is."""
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cols), F.lit(0.0))
    present = sum((c.isNotNull().cast("int") for c in cols), F.lit(0))
    return F.try_divide(total, present)
