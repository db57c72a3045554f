"""From coarse zones to fine zones: shares, projection, equal split, evolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import half_even, percent_change


def share_of_group(df: DataFrame, group: str, weight: str, share: str = "part") -> DataFrame:
    """Each row's part of its group's weight; a group without weight has no shares."""
    totals = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.sum(weight).alias("_group_weight"))
    return df.join(totals, group, "left").withColumn(
        share, F.try_divide(F.col(weight), F.col("_group_weight"))
    ).drop("_group_weight")


def estimate(total: Column, share: Column) -> Column:
    """A coarse count times a share, rounded half to even, as a whole number."""
    return half_even(total * share, 0).cast("bigint")


def project(
    coarse: DataFrame, fine: DataFrame, zone: str, share: str, counts: Mapping[str, str]
) -> DataFrame:
    """Replicate coarse rows over their fine zones and split the named counts by share.

    ``fine`` holds one row per fine zone. A coarse zone without fine zones keeps its row.
    """
    wide = coarse.join(fine, zone, "left")
    return wide.withColumns({new: estimate(F.col(old), F.col(share)) for old, new in counts.items()})


def equal_split(totals: DataFrame, fine: DataFrame, zone: str, total: str, out: str) -> DataFrame:
    """Give each fine zone an equal part of its coarse total; no total counts as zero."""
    members = fine.groupBy(zone).agg(F.count(F.lit(1)).alias("_members"))
    parts = totals.join(members, zone).select(zone, (F.col(total) / F.col("_members")).alias(out))
    return fine.join(parts, zone, "left").fillna(0.0, subset=[out])


def evolution(
    df: DataFrame, keys: Sequence[str], year: str, before: int, after: int, measures: Mapping[str, str]
) -> DataFrame:
    """Wide form of two years and the percent change of each measure.

    ``measures`` maps a measure to the name of its change column. Keys present in only
    one of the two years are left out. Two filters and an aggregate, no self-join.
    """
    picks = [
        F.max(F.when(F.col(year) == y, F.col(m))).alias(f"{m}_{y}") for m in measures for y in (before, after)
    ]
    seen = [F.max((F.col(year) == y).cast("int")).alias(f"_seen_{i}") for i, y in enumerate((before, after))]
    wide = df.where(F.col(year).isin(before, after)).groupBy(*keys).agg(*picks, *seen)
    both = wide.where("_seen_0 = 1 and _seen_1 = 1").drop("_seen_0", "_seen_1")
    return both.withColumns(
        {
            name: percent_change(F.col(f"{m}_{before}"), F.col(f"{m}_{after}")) for m, name in measures.items()
        }
    )
