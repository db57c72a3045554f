"""Exact dedup by distributed most-significant-digit radix partitioning.

Documents are split by their byte length and then by successive bytes from the front. A digit is a block
of bytes, eight times as wide at each level, so the number of levels grows with the logarithm of the
longest text among copies. After each level a group of one document is finished (it has no copy), a
group whose bytes have ended is finished (all its documents are equal), and only what remains carries
its unread bytes to the next level. Equality is decided on the bytes; no digest takes part.

A level is a count per (group, digit), combined on the map side, joined back to the rows. A group is a key,
never a list, so a group with a third of all rows costs a count; the join back is split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined_small, number_rows, stage, text_of

FIRST_DIGIT = 64
WIDENING = 8


#: First digits are 64 bytes, so this many of them may be broadcast (some 10 MB); wider digits never are.
BROADCAST_DIGITS = 100_000


def _split(rows: DataFrame, keys: list[str], broadcast: bool = False) -> DataFrame:
    """``rows`` with a new group number where the keys agree, null where a row is alone."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    groups = number_rows(counts.drop("__n"), "__group")
    return joined_small(rows, groups, keys, "left", BROADCAST_DIGITS if broadcast else 0)


def exact_groups(docs: DataFrame, first_digit: int = FIRST_DIGIT, widening: int = WIDENING) -> DataFrame:
    """Per row: ``doc_id``, ``__row`` (its number), ``text_sha256`` and ``__group``, null for a text without a copy."""
    data = F.encode(text_of("text"), "UTF-8")
    rows = docs.select(F.col("doc_id"), F.monotonically_increasing_id().alias("__row"), data.alias("__b"))
    rows = rows.select(
        "doc_id",
        "__row",
        "__b",
        F.sha2("__b", 256).alias("text_sha256"),
        F.octet_length("__b").alias("__size"),
        F.substring("__b", 1, first_digit).alias("__digit"),
    )
    split = _split(rows, ["__size", "__digit"], first_digit <= FIRST_DIGIT)
    rest = F.when(
        F.col("__group").isNotNull() & (F.col("__size") > first_digit), F.substring("__b", first_digit + 1, 2**31 - 1)
    )
    level = stage(split.select("doc_id", "__row", "text_sha256", "__group", rest.alias("__rest")))
    done = [level.where("__rest is null")]
    left = level.where("__rest is not null")
    width = first_digit
    while left.limit(1).count():
        width *= widening
        rows = left.withColumnRenamed("__group", "__above").withColumn("__digit", F.substring("__rest", 1, width))
        split = _split(rows, ["__above", "__digit"])
        rest = F.when(
            F.col("__group").isNotNull() & (F.octet_length("__rest") > width), F.substring("__rest", width + 1, 2**31 - 1)
        )
        level = stage(split.select("doc_id", "__row", "text_sha256", "__group", rest.alias("__rest")))
        # Groups of different levels must not share a number.
        level = level.withColumn("__level", F.lit(len(done)))
        done.append(level.where("__rest is null"))
        left = level.where("__rest is not null").drop("__level")
    out = done[0].withColumn("__level", F.lit(0))
    for part in done[1:]:
        out = out.unionByName(part)
    return out.drop("__rest")


def exact_dedup(docs: DataFrame, first_digit: int = FIRST_DIGIT, widening: int = WIDENING) -> DataFrame:
    """One row per document, dropped ones too: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when their bytes are. A null text counts as empty, and all empty texts form one group.
    Of equal texts the row with the largest ``doc_id`` stays; a null id is smaller than any, and of repeated
    ids one row stays. Only ``doc_id`` and ``text`` are read, so other columns cannot clash. An empty table
    gives no rows.
    """
    rows = exact_groups(docs, first_digit, widening)
    alone = rows.where("__group is null").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    copies = rows.where("__group is not null")
    key = ["__level", "__group"]
    best = copies.groupBy(*key).agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "__row")).alias("__keep")
    )
    grouped = copies.join(best, key).select(
        "doc_id",
        F.col("__keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("__row") == F.col("__keep.__row")).alias("kept"),
        "text_sha256",
    )
    return alone.unionByName(grouped)
