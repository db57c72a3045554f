"""Exact quantiles, ranks and modes that never hold one whole large group in a task.

There is one plan for every size. A group starts as a single cell between its smallest and largest value. A cell that
is too full is cut into even bins between its own ends; the bins are counted, combined before the shuffle, and only
those that hold a wanted rank become the cells of the next round. Ends come from the data, so a narrow range of values
is split as well as a wide one. Once every cell is small, or holds one value only, its values are counted in order.
Results are exact; the cells only spread the work.

Missing values (null and NaN) count for nothing; a group that has nothing else stays, with null for its measures.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

#: Rows that one task puts in order, and bins that a fuller cell is cut into.
CELL_ROWS = 20_000
BINS = 1_024


def _wanted(total: Column, prob: float) -> tuple[Column, Column, Column]:
    """Zero-based ranks around a linear quantile and the weight of the upper one."""
    spot = (total - 1) * F.lit(float(prob))
    below = F.floor(spot)
    return below, F.ceil(spot), spot - below


def _holds(probs: Sequence[float]) -> Column:
    """Whether a stretch of ``_n`` rows after ``_before`` holds a wanted rank."""
    test = F.lit(False)
    for prob in probs:
        low, high, _ = _wanted(F.col("_total"), prob)
        test = test | ((F.col("_before") <= high) & (F.col("_before") + F.col("_n") > low))
    return test


_FACTS = {"count": F.count, "mean": F.avg, "min": F.min, "max": F.max}


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    facts: Mapping[str, str] | None = None,
    cell_rows: int = CELL_ROWS,
    bins: int = BINS,
) -> DataFrame:
    """Linear-interpolated quantiles per group, one column per entry of ``probs``.

    Groups with a missing key are left out. ``facts`` adds columns for ``count``, ``mean``, ``min`` and ``max`` of the
    present values, ``{fact: column}``. Runs jobs: the values are written once and read by each round.
    """
    keys, facts = list(keys), dict(facts or {})
    number = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    by = [f"_k{i}" for i in range(len(keys))] or ["_k0"]
    named = [F.col(k).alias(b) for k, b in zip(keys, by)] or [F.lit(0).alias("_k0")]
    rows = df.select(*named, number.alias("_v"))
    for b in by:
        rows = rows.where(F.col(b).isNotNull())
    rows = stage(rows)
    asked = [_FACTS[fact]("_v").alias(f"_f_{fact}") for fact in facts]
    groups = rows.groupBy(*by).agg(F.count("_v").alias("_total"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), *asked)
    groups = stage(groups)
    present = rows.where(F.col("_v").isNotNull())
    cells = groups.where("_total > 0").select(*by, "_lo", "_hi", "_total", F.lit(0).cast("bigint").alias("_before"), F.col("_total").alias("_n"))
    # Neighbouring cells share no value, so a row lies in one cell of its group at most.
    within = F.col("_v").between(F.col("_lo"), F.col("_hi"))
    too_full = (F.col("_n") > cell_rows) & (F.col("_lo") < F.col("_hi"))
    cells = stage(cells)
    done = []
    while True:
        done.append(cells.where(~too_full))
        full = cells.where(too_full)
        if not full.limit(1).count():
            break
        # Halved, so that the distance of the ends cannot overflow.
        share = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        inside = present.join(full, by).where(within).withColumn("_bin", F.least(F.floor(share * bins), F.lit(bins - 1)))
        cell = [*by, "_lo", "_total", "_before"]
        counted = inside.groupBy(*cell, "_bin").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        run = Window.partitionBy(*by, "_lo").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_n").over(run), F.lit(0)))
        picked = counted.where(_holds(list(probs.values())))
        cells = stage(picked.select(*by, F.col("_low").alias("_lo"), F.col("_high").alias("_hi"), "_total", "_before", "_n"))
    ready = done[0]
    for more in done[1:]:
        ready = ready.unionByName(more)
    ready = stage(ready)

    spans = present.join(ready.drop("_n"), by).where(within).groupBy(*by, "_lo", "_v", "_before", "_total").agg(F.count(F.lit(1)).alias("_n"))
    inside = Window.partitionBy(*by, "_lo").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    measures = []
    for i, prob in enumerate(probs.values()):
        low, high, share = _wanted(F.col("_total"), prob)
        end = F.col("_before") + F.col("_n")
        at_low = F.max(F.when((F.col("_before") <= low) & (low < end), F.col("_v")))
        at_high = F.max(F.when((F.col("_before") <= high) & (high < end), F.col("_v")))
        # Weighted, so that the middle of two values is their mean to the last digit.
        measures.append((at_low * (1 - F.max(share)) + at_high * F.max(share)).alias(f"_q{i}"))
    found = spans.groupBy(*by).agg(*measures)
    out = groups.join(found, by, "left")
    back = [F.col(b).alias(k) for k, b in zip(keys, by)]
    cuts = [F.col(f"_q{i}").alias(name) for i, name in enumerate(probs)]
    return out.select(*back, *cuts, *[F.col(f"_f_{fact}").alias(name) for fact, name in facts.items()])


def _long(df: DataFrame, keys: Sequence[str], values: Mapping[str, str], dtype: str) -> DataFrame:
    """Columns as (output name, value) rows, so that all of them share each scan."""
    pairs = [F.struct(F.lit(o).alias("k"), F.col(c).cast(dtype).alias("v")) for o, c in values.items()]
    return df.select(*keys, F.explode(F.array(*pairs)).alias("_p")).select(
        *keys, F.col("_p.k").alias("_k"), F.col("_p.v").alias("_x")
    )


def medians(
    df: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, str],
    facts: Mapping[str, Mapping[str, str]] | None = None,
    cell_rows: int = CELL_ROWS,
    bins: int = BINS,
) -> DataFrame:
    """Exact medians of several columns, ``{output: column}``.

    ``facts`` adds facts of single columns, ``{output: {fact: name}}``. A group without any present value of a
    column has null there.
    """
    keys, facts = list(keys), dict(facts or {})
    used = {f: f"_{f}" for wanted in facts.values() for f in wanted}
    flat = quantiles(_long(df, keys, values, "double"), [*keys, "_k"], "_x", {"_m": 0.5}, used, cell_rows, bins)

    def pick(output: str, column: str) -> Column:
        return F.max(F.when(F.col("_k") == output, F.col(column)))

    measures = [pick(o, "_m").alias(o) for o in values]
    extra = [pick(o, f"_{f}").alias(n) for o, wanted in facts.items() for f, n in wanted.items()]
    return flat.groupBy(*keys).agg(*measures, *extra)


def summarize(df: DataFrame, keys: Sequence[str], value: str, median: str, mean: str, rows: str) -> DataFrame:
    """Median, mean and count of one measure per group, from the same passes."""
    out = quantiles(df, keys, value, {median: 0.5}, {"mean": mean, "count": rows})
    return out.select(*keys, median, mean, rows)


def modes(df: DataFrame, keys: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """Most frequent value of several columns per group, smallest value among ties.

    Values are counted before they are compared, so a frequent value is reduced on the map side and a group is never
    gathered. A group without a present value has null.
    """
    keys = list(keys)
    counted = _long(df, keys, values, "string").groupBy(*keys, "_k", "_x").agg(F.count(F.lit(1)).alias("n"))
    best = F.struct((-F.col("n")).alias("n"), F.col("_x").alias("v"))
    present = F.col("_x").isNotNull()
    return counted.groupBy(*keys).agg(
        *[F.min(F.when((F.col("_k") == o) & present, best)).getField("v").alias(o) for o in values]
    )


def value_counts(df: DataFrame, *names: str, count: str = "n") -> DataFrame:
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias(count))


def percentile_ranks(df: DataFrame, value: str, out: str) -> DataFrame:
    """Percentile rank (ties averaged, rank / n) of each present value over a whole table; missing ones keep null.

    Equal values are counted once, then dealt out in value order by Spark's range partitioning, which follows the
    data; a partition's rows are ranked in place and moved on by the rows of the partitions before it.
    """
    rows = df.select(F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double")).alias("_v"))
    counts = rows.where(F.col("_v").isNotNull()).groupBy("_v").agg(F.count(F.lit(1)).alias("_n"))
    dealt = stage(counts.repartitionByRange("_v").withColumn("_part", F.spark_partition_id()))
    # One row per partition.
    parts = dealt.groupBy("_part").agg(F.sum("_n").alias("_here"))
    order = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns(
        {"_before": F.coalesce(F.sum("_here").over(order), F.lit(0)), "_total": F.sum("_here").over(Window.partitionBy(F.lit(0)))}
    )
    upto = F.sum("_n").over(Window.partitionBy("_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = dealt.withColumn("_upto", upto).join(stage(parts), "_part").select(
        "_v", ((F.col("_before") + F.col("_upto") - F.col("_n") + (F.col("_n") + 1) / 2) / F.col("_total")).alias(out)
    )
    return df.join(ranked, df[value].cast("double") == ranked["_v"], "left").drop("_v")


def describe(df: DataFrame, value: str, probs: Mapping[str, float]) -> DataFrame:
    """One row: count, mean, sample deviation, min, chosen exact percentiles, max."""
    basics = df.agg(
        F.struct(
            F.count(value).alias("n"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )
    ).scalar()
    cut = quantiles(df, [], value, probs)
    return cut.withColumn("_b", basics).select("_b.n", "_b.mean", "_b.std", "_b.min", *probs, "_b.max")
