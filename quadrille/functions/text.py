"""Text keys and text fallbacks."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

NBSP = "\u00a0"


def _latin_folding() -> tuple[str, str]:
    """Accented Latin letters and their base letter, derived from Unicode."""
    source, target = [], []
    for code in range(0x00A0, 0x0250):
        char = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if base != char and len(base) == 1 and base.isascii() and base.isalnum():
            source.append(char)
            target.append(base)
    return "".join(source), "".join(target)


_ACCENTED, _PLAIN = _latin_folding()

# The accents the name key replaces, and what replaces them.
_NAME_ACCENTS = "ÉÈÊÀÂÔÛÜÎÏÇ"
_NAME_LETTERS = "EEEAAOUUIIC"


def fold_header(name: str) -> str:
    """Snake-case ASCII form of one column name (driver side, metadata only)."""
    decomposed = unicodedata.normalize("NFKD", str(name).strip().lower())
    plain = "".join(c for c in decomposed if not unicodedata.combining(c))
    return re.sub("[^a-z0-9]+", "_", plain).strip("_")


def fold_place_header(name: str) -> str:
    """Header of the geography files: accents off, separators as ``_``, the rest kept."""
    decomposed = unicodedata.normalize("NFD", str(name).strip().lower())
    plain = "".join(c for c in decomposed if unicodedata.category(c) != "Mn")
    return re.sub("[-_ ]", "_", plain)


def fold_accents(col: Column) -> Column:
    """Drop accents from Latin text, precomposed or written with combining marks.

    Plain ASCII, as many bytes as characters, has nothing to drop and is passed through.
    """
    folded = F.regexp_replace(F.translate(col, _ACCENTED, _PLAIN), r"\p{Mn}+", "")
    return F.when(F.octet_length(col) == F.length(col), col).otherwise(folded)


@F.pandas_udf(StringType())
def _decompose(texts: pd.Series) -> pd.Series:
    def plain(text: str | None) -> str | None:
        if text is None:
            return None
        if text.isascii():
            return text
        return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))

    return texts.map(plain)


def text_key(col: Column, null: str = "", any_script: bool = False) -> Column:
    """Lower-case ASCII key: accents off, every other run of characters becomes ``_``.

    ``any_script=True`` decomposes all of Unicode (ligatures, full-width letters) in an
    Arrow batch; the default covers Latin letters inside generated code.
    """
    low = F.lower(F.coalesce(col.cast("string"), F.lit(null)))
    plain = _decompose(low) if any_script else fold_accents(low)
    return F.btrim(F.regexp_replace(plain, "[^a-z0-9]+", "_"), F.lit("_"))


def geo_name(col: Column, null: str = "inconnu") -> Column:
    """Readable place name: lower case, accents off, ``-`` and ``_`` as spaces."""
    low = F.lower(F.trim(col.cast("string")))
    return F.coalesce(F.translate(fold_accents(low), "-_", "  "), F.lit(null))


def name_key(col: Column) -> Column:
    """Upper-case name with hyphens opened and a fixed set of accents replaced."""
    opened = F.translate(F.upper(col), "-", " ")
    return F.coalesce(F.trim(F.translate(opened, _NAME_ACCENTS, _NAME_LETTERS)), F.lit(""))


def non_blank(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def first_non_empty(*cols: Column, default: str | None = "") -> Column:
    """First value that is neither null nor the empty string."""
    picked = F.coalesce(*[non_blank(c.cast("string")) for c in cols])
    return picked if default is None else F.coalesce(picked, F.lit(default))


def any_match(cols: list[Column], pattern: str) -> Column:
    """Case-insensitive regular expression found in at least one of the columns."""
    hit = F.lit(False)
    for col in cols:
        hit = hit | F.coalesce(col.cast("string").rlike(f"(?i){pattern}"), F.lit(False))
    return hit


def contains_folded(col: Column, needle: str) -> Column:
    return F.coalesce(F.contains(F.lower(col.cast("string")), F.lit(needle.lower())), F.lit(False))
