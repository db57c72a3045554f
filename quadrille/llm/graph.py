"""Connected classes from similarity links, without a pair for every two members of a group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Pivots that a round may compare with the rest of a bucket, and the comparisons per member it may come to: by
#: ``possible`` inside the join, so only what may be linked becomes a row. A dense group is settled by its first pivots
#: before more are tried.
PIVOTS = (2, 8, 32, 128, 512, 2048, 8192)
PAIRS_PER_MEMBER = 4096
#: Buckets up to this size may be compared whole in the first round; larger ones begin with the fewest pivots.
FEW = 8


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` of every node in ``edges`` (a, b; staged): the smallest node it is connected with.

    Labels move along links and jump to their label's label, so rounds grow with the logarithm of a chain's
    length. Every step is a join or a map-side combined minimum; no component is gathered anywhere.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        best = labels.join(near, labels["node"] == near["a"]).select("node", F.least("label", "near").alias("new"), "label")
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("beyond"))
        moved = stage(best.join(jump, "new").select("node", F.col("beyond").alias("now"), "label"))
        labels = moved.select("node", F.col("now").alias("label"))
        if not moved.where("now <> label").limit(1).count():
            return labels


def linked_classes(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    possible: Callable[[Column, Column], Column] | None = None,
    pivots: tuple[int, ...] = PIVOTS,
    pairs_per_member: int = PAIRS_PER_MEMBER,
    order: str = "node",
) -> DataFrame | None:
    """Classes (``node``, ``label``) of the links among nodes that share a bucket; null labels do not occur.

    ``members`` (staged) holds distinct (bucket, node, size) and ``order``, which says who is compared first, size being what ``possible`` needs to tell if a link can be; ``verify``
    takes staged pairs (a, b and others) and returns, with all columns, those that are truly linked. Each round compares the
    first nodes of every bucket, its pivots, with the later ones, then drops the pivots. Two nodes that are already
    known to be connected are not compared, and a bucket whose nodes all are is left out, so a group of n mutual
    copies costs some n comparisons, not n squared. Every two nodes of a bucket end up compared or connected: no link
    between classes is lost, and nothing is capped. Returns None if nothing is linked; unlinked nodes may be missing.
    """
    left = members.select("bucket", "node", "size", F.col(order).alias("place"), F.col("node").alias("label"))
    rest, classes = None, None
    while True:
        if rest is not None:
            known = rest
            if classes is not None:
                known = rest.join(classes, "node", "left").withColumn("label", F.coalesce("label", "node"))
            else:
                known = rest.withColumn("label", F.col("node"))
            mixed = known.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
            known = known.join(mixed.where("lo < hi").select("bucket"), "bucket")
            left = stage(known.select("bucket", "node", "size", "place", "label"))
        sizes = left.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        costs = [F.sum(F.col("n") * F.least(F.col("n"), F.lit(p))).alias(f"p{p}") for p in pivots]
        total = sizes.agg(F.sum("n").alias("members"), F.max("n").alias("largest"), *costs).first()
        if total["members"] is None:
            return classes
        many = pivots[0]
        if rest is not None or total["largest"] <= FEW:
            many = max([many, *[p for p in pivots if total[f"p{p}"] <= pairs_per_member * total["members"]]])
        first = Window.partitionBy("bucket").orderBy("place")
        heads = left.withColumn("__r", F.row_number().over(first)).where(F.col("__r") <= many)
        heads = heads.select("bucket", F.col("place").alias("pa"), F.col("node").alias("a"), F.col("size").alias("sa"), F.col("label").alias("la"))
        met = left.join(heads, "bucket").where("pa < place and la <> label")
        if possible is not None:
            met = met.where(possible(F.col("sa"), F.col("size")))
        pairs = stage(met.select("a", F.col("node").alias("b"), "la", F.col("label").alias("lb")).distinct())
        found = stage(verify(pairs).select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct())
        if found.limit(1).count():
            merged = components(found)
            if classes is None:
                classes = merged
            else:
                joined = merged.select(F.col("node").alias("label"), F.col("label").alias("now"))
                moved = classes.join(joined, "label", "left").select("node", F.coalesce("now", "label").alias("label"))
                classes = stage(moved.unionByName(merged.join(classes, "node", "left_anti")))
        if total["largest"] <= many + 1:
            return classes
        last = heads.groupBy("bucket").agg(F.max("pa").alias("last"))
        rest = left.join(last, "bucket").where("place > last").select("bucket", "node", "size", "place")
