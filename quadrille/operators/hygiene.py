"""Row filters, unions, dedupes and missing-value fills."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import non_blank, text_key
from ..functions.zones import MISSING_TEXT, is_zone
from ..session import stage
from .columns import text_columns
from .distribution import quantiles


def present(df: DataFrame, *names: str) -> DataFrame:
    """Keep rows where every named column that exists is present."""
    return df.dropna(subset=[c for c in names if c in df.columns])


def in_zones(df: DataFrame, zone: str = "arrondissement") -> DataFrame:
    return df.where(is_zone(F.col(zone)))


def drop_states(df: DataFrame, state: Column, dropped: Sequence[str]) -> DataFrame:
    """Drop rows whose text key is one of ``dropped``; a missing state is kept."""
    return df.where(~text_key(state).isin(list(dropped)))


def fill_text(df: DataFrame, marker: str = MISSING_TEXT, skip: Sequence[str] = ()) -> DataFrame:
    """Fill missing text, and only text, with a marker."""
    names = [c for c in text_columns(df) if c not in skip]
    return df.fillna(marker, subset=names) if names else df


def fill_zero(df: DataFrame, *names: str) -> DataFrame:
    return df.fillna(0, subset=[c for c in names if c in df.columns])


def blank_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: non_blank(F.col(f"`{c}`")) for c in text_columns(df)})


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column one source lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per key: the smallest by ``order``.

    An aggregate rather than a window, so rows are reduced before the shuffle and a key
    with many copies costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    best = df.groupBy(*keys).agg(F.min_by(row, F.struct(*[F.col(c) for c in order])).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def trim_quantiles(df: DataFrame, value: str, source: str | None = None, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Keep rows between two exact quantiles, bounds included, of the table or per source.

    Bounds per source are a written table of a row each, joined by source: few sources are broadcast by their true size
    and the rows are filtered where they are, many are shuffled. Rows without a source go.
    """
    cut = quantiles(df, [source] if source else [], value, {"_low": low, "_high": high})
    if source:
        wide = df.join(stage(cut), source).select(*[F.col(f"`{c}`") for c in df.columns], "_low", "_high")
        return wide.where(F.col(value).between(F.col("_low"), F.col("_high"))).drop("_low", "_high")
    wide = df.withColumn("_cut", cut.select(F.struct("_low", "_high")).scalar())
    return wide.where(F.col(value).between(F.col("_cut._low"), F.col("_cut._high"))).drop("_cut")


def funnel(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """Rows left after each cumulative filter, counted in one pass."""
    passed, counts = F.lit(True), [F.count(F.lit(1)).alias("n_0")]
    for i, test in enumerate(steps.values(), start=1):
        passed = passed & F.coalesce(test, F.lit(False))
        counts.append(F.count_if(passed).alias(f"n_{i}"))
    names = ["all", *steps]
    line = F.array(
        *[
            F.struct(F.lit(i).alias("step"), F.lit(name).alias("name"), F.col(f"n_{i}").alias("rows"))
            for i, name in enumerate(names)
        ]
    )
    return (
        df.agg(*counts)
        .select("n_0", F.explode(line).alias("s"))
        .select("s.step", "s.name", "s.rows", F.try_divide(F.col("s.rows") * 100.0, F.col("n_0")).alias("pct"))
    )
