"""Mixing sources to target weights by exponential keys (Efraimidis and Spirakis).

A source's target is met by complete epochs first: as many whole passes as fit. What is left is a fractional pass:
every document draws an exponential key scaled by its quality weight, documents are taken in the order of their
keys, and a running sum of sizes stops at the budget.

No source is sorted whole. Keys are counted in even ranges between a source's own ends, combined on the map side; the
range that holds the budget's end is found from the ranges' sums and counted again between its own ends, until it holds
few rows. Only those are put in order. Rows of one key (repeated rows) are cut by their number in the same way, so the
last range is small however the keys are spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, number_rows, stage

WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE = 1.5
MOST_EPOCHS = 2.0
RANGES = 1024
IN_ORDER = 4096


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def quality_of(text: Column) -> Column:
    """A document's quality weight: the share of its characters that are no symbols, 0.05 at least."""
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>{}[]\\^~`@!", ""))
    return F.greatest(F.lit(0.05), F.coalesce(1 - symbols / F.greatest(F.length(text), F.lit(1)), F.lit(0.05)))


def uniform(doc_id: Column, text: Column, seed: int) -> Column:
    """A number strictly between 0 and 1 from the seed, the id and the text: reruns draw alike."""
    said = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit(""))))
    return (F.conv(F.substring(F.md5(said), 1, 13), 16, 10).cast("bigint") + 0.5) / float(1 << 52)


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, total_share: float = TOTAL_SHARE, most: float = MOST_EPOCHS
) -> DataFrame:
    """``source``, ``source_size``, ``target`` from (source, source_size), one row per source.

    Sources in code point order, null last, get the weights in turn and share ``total_share`` of all sizes. A target
    stops at ``most`` times its source; what is above goes to the others by weight until none is above. Ordered by
    size over weight, the sources that stop come first, so the level of the rest follows from two running sums.
    The windows run over one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("w", F.get(listed, (F.row_number().over(order) - 1) % len(weights)))
    rows = rows.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    filled = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    after = filled.rowsBetween(0, Window.unboundedFollowing)
    budget = F.sum("source_size").over(Window.partitionBy(F.lit(0))) * F.lit(float(total_share))
    # The level at which this source and those after it share what the ones before leave.
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    rows = rows.withColumn("level", level)
    free = F.when(F.col("cap") / F.col("w") > F.col("level"), F.col("level"))
    rows = rows.withColumn("held", F.max(free).over(Window.partitionBy(F.lit(0))))
    target = F.round(F.least(F.col("cap"), F.coalesce(F.col("held") * F.col("w"), F.col("cap"))), 6)
    return rows.select("source", "source_size", target.alias("target"))


def budget_ends(rows: DataFrame, plan: DataFrame, ranges: int = RANGES, in_order: int = IN_ORDER) -> DataFrame:
    """``plan`` with the range of each source that holds the end of its ``budget``: keys from ``low`` to ``high``, rows
    numbered from ``first`` to ``last``, and ``before``, the size ahead of them.

    Runs one pass over ``rows`` (source, size, key, __row) per level, for the sources alone whose range still holds more
    than ``in_order`` rows. Every level parts the least key of a range from its greatest, or the first row of one key
    from its last, so the passes end; two or three serve a thousand million rows a source.
    """
    held = rows.groupBy(F.col("source").alias("s")).agg(
        F.min("key").alias("low"), F.max("key").alias("high"),
        F.min("__row").alias("first"), F.max("__row").alias("last"), F.count(F.lit(1)).alias("held"),
    )
    same = F.col("s").eqNullSafe(F.col("source"))
    end = stage(plan.join(held, same).drop("s").withColumn("before", F.lit(0).cast("bigint")))
    found_at = ["low", "high", "first", "last", "held", "before"]
    full = F.col("held") > in_order
    while not end.where(full).isEmpty():
        ends = end.where(full).select(F.col("source").alias("s"), "budget", "low", "high", "first", "last", "before")
        inside = rows.join(ends, same).where(F.col("key").between(F.col("low"), F.col("high")) & F.col("__row").between(F.col("first"), F.col("last")))
        by_key = (F.col("key") - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0))
        by_row = (F.col("__row") - F.col("first")) / F.nullif((F.col("last") - F.col("first")).cast("double"), F.lit(0.0))
        at = F.least(F.floor(F.coalesce(by_key, by_row) * F.lit(float(ranges))), F.lit(ranges - 1))
        summed = inside.groupBy("s", at.cast("bigint").alias("at")).agg(
            F.sum("size").alias("size"), F.max("before").alias("start"), F.max("budget").alias("budget"),
            F.min("key").alias("low"), F.max("key").alias("high"),
            F.min("__row").alias("first"), F.max("__row").alias("last"), F.count(F.lit(1)).alias("held"),
        )
        run = Window.partitionBy("s").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        summed = summed.withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(run), F.lit(0)))
        # The last range that starts within the budget; the first one always does.
        opened = F.when(F.col("before") <= F.col("budget"), F.struct("at", *found_at))
        found = summed.groupBy("s").agg(F.max(opened).alias("e")).withColumn("new", F.lit(True))
        kept = [F.when(F.col("new"), F.col(f"e.{c}")).otherwise(F.col(c)).alias(c) for c in found_at]
        end = stage(end.join(found, same, "left").select(*plan.columns, *kept))
    return end


def mix_documents(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most: float = MOST_EPOCHS,
    quality: Column | None = None,
    seed: int = 17,
    ranges: int = RANGES,
    in_order: int = IN_ORDER,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``epochs`` (whole passes of
    its source), ``extra`` (whether the fractional pass takes it), ``taken`` (words taken, repeats counted) and the
    columns named in ``carry``.

    ``quality`` is a column expression over ``docs`` (positive; null counts as 0.05). A null text has size 0 and is
    never taken; a null source is a source of its own, the last. The document at the budget's end is taken if that
    brings its source nearer to the target. Documents with equal keys (repeated rows) follow each other in the order
    of their rows. Sources of size 0 have target 0. An empty table gives no rows. ``ranges`` and ``in_order`` say how
    the budget's end is looked for and change no result.
    """
    text = F.col("text").cast("string")
    u = uniform(F.col("doc_id"), text, seed)
    key = -F.log(u) / F.coalesce(quality if quality is not None else quality_of(text), F.lit(0.05))
    source = F.col("source").cast("string").alias("source")
    rows = docs.select("doc_id", source, words_in(text).alias("size"), key.alias("key"), *carry)
    rows = stage(rows.withColumn("__row", F.monotonically_increasing_id()))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = source_targets(sizes, weights, total_share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    plan = plan.withColumn("epochs", whole).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    ends = budget_ends(rows, plan, ranges, in_order).withColumnRenamed("source", "s").drop("held")
    rows = rows.join(ends, F.col("s").eqNullSafe(F.col("source"))).drop("s")
    # A range is of many keys, or of some rows of one key.
    earlier = (F.col("key") < F.col("low")) | ((F.col("key") == F.col("low")) & (F.col("low") == F.col("high")) & (F.col("__row") < F.col("first")))
    within = F.col("key").between(F.col("low"), F.col("high")) & F.col("__row").between(F.col("first"), F.col("last"))
    inside, outside = rows.where(within), rows.where(~within)
    order = Window.partitionBy("source").orderBy("key", "__row").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("before") + F.sum("size").over(order)
    inside = inside.withColumn("extra", upto - F.col("size") / 2 <= F.col("budget"))
    out = inside.unionByName(outside.withColumn("extra", earlier)).withColumn("extra", F.col("extra") & (F.col("size") > 0))
    taken = (F.col("epochs") + F.col("extra").cast("bigint")) * F.col("size")
    return out.select("doc_id", "source", "size", "source_size", "target", "epochs", "extra", taken.alias("taken"), *carry)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs``, with all its columns, as often as the mix takes it."""
    number = fresh(docs, "__number")
    rows = number_rows(docs, number)
    mixed = mix_documents(rows, carry=[number], **options)
    copies = fresh(rows, "__copies")
    times = (F.col("epochs") + F.col("extra").cast("bigint")).cast("int").alias(copies)
    plan = mixed.where("size > 0").select(number, times).where(F.col(copies) > 0)
    repeated = F.explode(F.sequence(F.lit(1), F.col(copies)))
    return rows.join(plan, number).withColumn(copies, repeated).select(*[F.col(f"`{c}`") for c in docs.columns])
