"""Header resolution: only column names are touched on the driver."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold_header


def normalize_headers(df: DataFrame, folded: Callable[[str], str] = fold_header) -> DataFrame:
    """Rename every column to its folded form; a repeated name gets a numeric suffix."""
    seen: dict[str, int] = {}
    names = []
    for name in df.columns:
        base = folded(name)
        seen[base] = seen.get(base, 0) + 1
        names.append(base if seen[base] == 1 else f"{base}_{seen[base]}")
    return df.toDF(*names)


def pick_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """Column whose folded name equals a candidate, else the first that contains one."""
    folded = {fold_header(c): c for c in df.columns}
    keys = [fold_header(c) for c in candidates]
    exact = (folded[k] for k in keys if k in folded)
    inside = (name for k in keys for f, name in folded.items() if k in f)
    return next(exact, None) or next(inside, None)


def find_column(df: DataFrame, *keywords: str) -> str | None:
    """First column whose folded name holds every keyword."""
    wanted = [fold_header(k) for k in keywords]
    return next((c for c in df.columns if all(k in fold_header(c) for k in wanted)), None)


def first_containing(df: DataFrame, *fragments: str) -> str | None:
    """First column, in table order, whose name contains any of the fragments."""
    return next((c for c in df.columns if any(f in c for f in fragments)), None)


def first_existing(df: DataFrame, candidates: Sequence[str]) -> str | None:
    return next((c for c in candidates if c in df.columns), None)


def find_prefix(df: DataFrame, prefix: str) -> str | None:
    return next((c for c in df.columns if c.upper().startswith(prefix.upper())), None)


def column_or_null(df: DataFrame, name: str | None, dtype: str = "string") -> Column:
    return F.col(f"`{name}`") if name else F.lit(None).cast(dtype)


def rename_existing(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def rename_picked(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by tolerant lookup: ``{wanted source name: target name}``."""
    found: dict[str, str] = {}
    for wanted, target in names.items():
        source = pick_column(df, [wanted])
        if source is not None:
            found[source] = target
    return df.withColumnsRenamed(found)


def keep(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in names if c in df.columns])


def require(df: DataFrame, names: Sequence[str], where: str = "table") -> DataFrame:
    absent = sorted(set(names) - set(df.columns))
    if absent:
        raise ValueError(f"missing columns in {where}: {absent}")
    return df


def drop_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in names if c in df.columns])


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
