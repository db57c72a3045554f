"""Zone codes: two-digit coarse zones, seven-digit fine zones, years."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import lenient_number
from .text import NBSP

# The coarse zones; their postal codes are 75001 to 75020.
ZONE_COUNT = 20
ZONES = [f"{n:02d}" for n in range(1, ZONE_COUNT + 1)]

_NUMBER_20 = r"([1-9]|0[1-9]|1[0-9]|20)(?:\.0*)?$"
_ZONE = r"^0*" + _NUMBER_20
_POSTAL_ZONE = r"^(?:0*|750(?=\d\d(?:\.0*)?$))" + _NUMBER_20

MISSING_TEXT = "non_renseigne"


def pad_left(col: Column, width: int) -> Column:
    """Left-pad with zeros; a longer text is kept whole."""
    text = col.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def digits_padded(col: Column, width: int) -> Column:
    """First run of digits, zero-padded; null when there is none."""
    runs = F.regexp_extract_all(col.cast("string"), F.lit(r"\d+"), F.lit(0))
    return pad_left(F.try_element_at(runs, F.lit(1)), width)


def last_two(col: Column) -> Column:
    return F.right(col, F.lit(2))


def is_zone(col: Column) -> Column:
    return col.isin(ZONES)


def zone2(col: Column, postal: bool = True) -> Column:
    """Number 1..20 (or, with ``postal``, 75001..75020) as two digits; else null.

    Values already in form are taken as they are; the pattern only runs on the others.
    """
    text = col.cast("string")
    number = F.regexp_extract_all(F.translate(text, f",{NBSP} ", "."), F.lit(_POSTAL_ZONE if postal else _ZONE), F.lit(1))
    return F.when(text.isin(ZONES), text).otherwise(F.lpad(F.try_element_at(number, F.lit(1)), 2, "0"))


def zone2_published(col: Column) -> Column:
    """``1``, ``1.0`` and ``01`` as ``01``; any other text is left alone."""
    text = F.trim(col.cast("string"))
    number = F.regexp_extract(text, r"^(\d+)(\.0*)?$", 1).try_cast("bigint")
    return F.when(number.isNotNull(), pad_left(number, 2)).otherwise(text)


def zone_from_insee(col: Column) -> Column:
    """Characters 4-5 of a seven-digit code when they name a zone."""
    part = F.substring(col, 4, 2)
    return F.when(is_zone(part), part)


def harmonized_zone(insee: Column, zone: Column) -> Column:
    return F.coalesce(zone_from_insee(insee), zone)


def zone_of_commune(commune: Column) -> Column:
    """Zone of a five-character commune code starting with 751; blank otherwise."""
    inside = (F.length(commune) == 5) & commune.startswith("751")
    return F.when(inside, last_two(commune)).otherwise(F.lit(""))


def insee_code(zone: Column, quarter: Column) -> Column:
    return F.concat(F.lit("751"), pad_left(zone, 2), F.coalesce(pad_left(quarter, 2), F.lit("00")))


def postal_suffix(col: Column) -> Column:
    """Last two digits of a postal code text, ignoring a trailing ``.0``, as int."""
    text = F.regexp_replace(F.trim(col.cast("string")), r"\.0$", "")
    return F.nullif(F.regexp_extract(text, r"(\d{2})$", 1), F.lit("")).cast("int")


def postal_modulo(col: Column) -> Column:
    return F.pmod(lenient_number(col), F.lit(100)).cast("int")


def timestamp_of(col: Column, *formats: str) -> Column:
    """Lenient timestamp: ISO text first, then each given format."""
    tries = [F.try_to_timestamp(col)] + [F.try_to_timestamp(col, F.lit(f)) for f in formats]
    return F.coalesce(*tries)


def year_of(col: Column, *formats: str) -> Column:
    return F.year(timestamp_of(col, *formats))
