"""Scores: min-max, ranks, weighted and geometric composites, imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import clip, half_even
from ..session import stage
from .distribution import medians, percentile_ranks, quantiles

# Exponents of the two generations of the geometric index.
FIVE_AXES = {"s1": 0.30, "s2": 0.25, "s3": 0.15, "s4": 0.15, "s5": 0.15}
FOUR_AXES = {"s1": 0.35, "s2": 0.30, "s3": 0.20, "s4": 0.15}

# Bounds of the global index; True where a low value is good.
INDEX_BOUNDS = {
    "prix_m2": (7000.0, 16000.0, True),
    "loyers": (20.0, 40.0, True),
    "logements_sociaux": (0.0, 3000.0, False),
    "comparaison": (15.0, 30.0, False),
}


def extent(df: DataFrame, *names: str) -> Column:
    """Table-wide min and max of columns as a scalar subquery: no join, no window."""
    ends = [F.min(n).alias(f"{n}_min") for n in names] + [F.max(n).alias(f"{n}_max") for n in names]
    return df.agg(F.struct(*ends)).scalar()


def _scaled(value: Column, low: Column, high: Column, flat: float) -> Column:
    """Position between two ends; ``flat`` where the ends meet or are missing."""
    spread = F.try_divide(value - low, high - low)
    return F.when(low.isNull() | high.isNull() | (low == high), F.lit(flat)).otherwise(spread)


def minmax(df: DataFrame, scores: Mapping[str, str], by: Sequence[str] = (), flat: float = 0.5) -> DataFrame:
    """Add min-max scores ``{column: score name}``; a constant or empty column scores ``flat``."""
    names = list(scores)
    if by:
        ends = [F.min(n).alias(f"_{n}_min") for n in names] + [F.max(n).alias(f"_{n}_max") for n in names]
        wide = df.join(df.groupBy(*by).agg(*ends), list(by))
        made = {s: _scaled(F.col(n), F.col(f"_{n}_min"), F.col(f"_{n}_max"), flat) for n, s in scores.items()}
        return wide.withColumns(made).drop(*[f"_{n}_{e}" for n in names for e in ("min", "max")])
    wide = df.withColumn("_ends", extent(df, *names))
    made = {s: _scaled(F.col(n), F.col(f"_ends.{n}_min"), F.col(f"_ends.{n}_max"), flat) for n, s in scores.items()}
    return wide.withColumns(made).drop("_ends")


def indicator_means(df: DataFrame, keys: Sequence[str], indicator: str, value: str) -> DataFrame:
    return df.groupBy(*keys, indicator).agg(F.avg(value).alias("_mean"))


def indicator_risk(
    df: DataFrame, keys: Sequence[str], indicator: str, value: str, risk: str, safety: str
) -> DataFrame:
    """Mean over the indicators present of each indicator's min-max score, times 100.

    Long form throughout: the number of indicators is data, not columns.
    """
    kept = df
    for name in (*keys, indicator, value):
        kept = kept.where(F.col(name).isNotNull())
    scored = minmax(indicator_means(kept, keys, indicator, value), {"_mean": "_score"}, by=[indicator])
    out = scored.groupBy(*keys).agg((F.avg("_score") * 100).alias(risk))
    return out.withColumn(safety, 100 - F.col(risk))


def pivot_means(df: DataFrame, keys: Sequence[str], indicator: str, value: str, labels: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).pivot(indicator, list(labels)).agg(F.avg(value))


def weighted(parts: Mapping[str, float]) -> Column:
    """Linear composite; null as soon as one part is."""
    total = None
    for name, weight in parts.items():
        term = F.col(name) * F.lit(weight)
        total = term if total is None else total + term
    return total


def bounded(value: Column, low: float, high: float, inverse: bool) -> Column:
    share = (value - F.lit(low)) / F.lit(high - low) * 100
    return clip(100 - share if inverse else share, 0.0, 100.0)


def density_rank_score(df: DataFrame, amount: str, area: str, out: str, inverse: bool) -> DataFrame:
    """Amount per area as a 0.01..10 rank score."""
    ranked = percentile_ranks(df.withColumn("_d", F.try_divide(F.col(amount), F.col(area))), "_d", "_r")
    share = 1 - F.col("_r") if inverse else F.col("_r")
    return ranked.withColumn(out, clip(share * 10, 0.01, 10.0)).drop("_d", "_r")


def rank_score(df: DataFrame, value: str, out: str) -> DataFrame:
    ranked = percentile_ranks(df, value, "_r")
    return ranked.withColumn(out, clip(F.col("_r") * 10, 0.01, 10.0)).drop("_r")


def impute_group_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """Missing value: the group's median, else the median of the table so far filled."""
    middles = quantiles(df, [group], value, {"_m": 0.5})
    filled = df.join(middles, group, "left").withColumn(value, F.coalesce(F.col(value), F.col("_m"))).drop("_m")
    return impute_median(filled, [value])


def distance_to_median_score(df: DataFrame, value: str, out: str) -> DataFrame:
    """10 at the median, falling with the relative distance to it, clipped to 0.01..10."""
    df = stage(df)  # read for the median, for the farthest value and for the rows
    middle = quantiles(df, [], value, {"_m": 0.5}).scalar()
    away = df.withColumn("_m", middle).withColumn(
        "_away", F.try_divide(F.abs(F.col(value) - F.col("_m")), F.col("_m"))
    )
    farthest = away.agg(F.max("_away")).scalar()
    score = 10 * (1 - F.try_divide(F.col("_away"), F.col("_far")))
    return away.withColumn("_far", farthest).withColumn(out, clip(score, 0.01, 10.0)).drop("_m", "_away", "_far")


def impute_median(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Fill each column's gaps with its table-wide median."""
    middles = medians(df, [], {n: n for n in names}).select(F.struct(*names)).scalar()
    wide = df.withColumn("_mid", middles)
    return wide.withColumns({n: F.coalesce(F.col(n), F.col(f"_mid.{n}")) for n in names}).drop("_mid")


def geometric_index(axes: Mapping[str, float], digits: int = 3) -> Column:
    product = F.lit(1.0)
    for name, exponent in axes.items():
        product = product * F.pow(F.col(name), F.lit(exponent))
    return half_even(product, digits)
