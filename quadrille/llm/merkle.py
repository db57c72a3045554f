"""Merkle manifest of a dataset: one tree per source, one tree over the sources, and a proof for every row.

Rows of a group stand in a fixed order and have a position in it. A node's run is the ``fanout`` consecutive positions
that it shares a parent with, its slot is its place in the run. In a window over the positions, the fixed-offset lags
and leads of the digest, masked by slot and by the length of the run, are a node's siblings; the row of slot 0, its
run's first child, hashes them to the parent.

Positions come from ranges: rows are dealt by range of (group, order, digest, row), numbered within a range, and the
counts per group and range, added up, say where each range begins. So no task holds a group. Climbing, one exchange
serves ``STOREY`` levels: a window partition is a block of ``fanout ** STOREY`` leaves, within which parents and
grandparents are leads at larger offsets. Descending, each node's siblings are put before those of its parent, which it
meets by (group, run): keys of ``fanout`` rows. The trees hold one row per node; nothing is gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

FANOUT = 16
#: Levels that one exchange serves when climbing.
STOREY = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts in a row."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    return digest(*[field(c) for c in columns])


def number_in_groups(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` (staged) with ``pos`` from 0 in the group and ``n``, the group's rows, written to the shared folder.

    ``group`` is never null. ``order`` should end with a column that tells all rows apart, so that no run of ties has to
    lie in one range.
    """
    keys = [F.col(c) for c in (group, *order)]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id())
    dealt = stage(dealt.withColumn("__range", F.shiftright("__at", 33)))
    counts = dealt.groupBy(group, "__range").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__held"))
    # One row per group and range: as many in a group as there are ranges at most.
    before = Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__begin", F.coalesce(F.sum("__held").over(before), F.lit(0)))
    counts = stage(counts.withColumn("n", F.sum("__held").over(Window.partitionBy(group))))
    placed = dealt.join(counts, [group, "__range"]).withColumn("pos", F.col("__begin") + F.col("__at") - F.col("__first"))
    return stage(placed.select(*rows.columns, "pos", "n"))


def siblings(hash_: Column, window, pos: Column, n: Column, fanout: int = FANOUT, step: int = 1) -> tuple[Column, Column]:
    """Digests of a node's run in front of it and behind it, each joined into one text.

    ``pos`` and ``n`` are the node's position and the nodes of its level. Along ``window`` the level's nodes stand
    ``step`` rows apart, and a window partition holds whole runs.
    """
    slot = F.pmod(pos, F.lit(fanout))
    none = F.lit("")
    left = [F.when(slot >= k, F.lag(hash_, k * step).over(window)).otherwise(none) for k in range(fanout - 1, 0, -1)]
    right = [
        F.when((slot + k < fanout) & (pos + k < n), F.lead(hash_, k * step).over(window)).otherwise(none) for k in range(1, fanout)
    ]
    return F.concat(*left), F.concat(*right)


def above(n: Column, fanout: int, levels: int = 1) -> Column:
    """How many nodes ``n`` nodes have ``levels`` levels higher."""
    return _div(n + (fanout**levels - 1), fanout**levels)


def _div(value: Column, by: int) -> Column:
    return F.shiftright(value, by.bit_length() - 1)


def climb(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """Tables (``grp``, ``pos``, ``n``, ``hash``) of levels 0 (``leaves``, staged), 1, 2 ... until every group has one node.

    A group that has one node already keeps it, unhashed, while others climb on.
    """
    if fanout & (fanout - 1) or fanout < 2:
        raise ValueError("fanout must be a power of two")
    levels = [leaves]
    largest = leaves.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        block = _div(F.col("pos"), fanout**STOREY)
        window = Window.partitionBy("grp", "__block").orderBy("pos")
        rows = levels[-1].select("grp", "pos", "n", "hash", block.alias("__block"))
        _, behind = siblings(F.col("hash"), window, F.col("pos"), F.col("n"), fanout)
        alone = F.col("n") == 1
        made = rows.withColumn("hash1", F.when(alone, F.col("hash")).otherwise(digest(F.col("hash"), behind)))
        made = made.where(F.pmod("pos", F.lit(fanout)) == 0)
        for level in range(1, STOREY):
            own, pos, n = F.col(f"hash{level}"), _div(F.col("pos"), fanout**level), above(F.col("n"), fanout, level)
            first = F.pmod("pos", F.lit(fanout ** (level + 1))) == 0
            _, behind = siblings(own, window, pos, n, fanout, fanout ** (level - 1))
            parent = F.when(n == 1, own).otherwise(digest(own, behind))
            made = made.withColumn(f"hash{level + 1}", F.when(first, parent))
        made = stage(made.select("grp", "pos", "n", *[f"hash{i}" for i in range(1, STOREY + 1)]))
        for level in range(1, STOREY + 1):
            node = made.where(F.pmod("pos", F.lit(fanout**level)) == 0)
            pos, n = _div(F.col("pos"), fanout**level), above(F.col("n"), fanout, level)
            levels.append(node.select("grp", pos.alias("pos"), n.alias("n"), F.col(f"hash{level}").alias("hash")))
            largest = -(-largest // fanout)
            if largest == 1:
                break
    return levels


def _with_steps(nodes: DataFrame, beyond: DataFrame | None, fanout: int) -> DataFrame:
    """``nodes`` of a level with ``steps``, the siblings (``l``, ``r``) at every level from theirs up.

    ``beyond`` has the ``steps`` of their parents (``grp``, ``pos``), and whatever else is to be handed down. Where a
    level is a single node there is no step.
    """
    window = Window.partitionBy("grp", "__run").orderBy("pos")
    rows = nodes.withColumn("__run", _div(F.col("pos"), fanout))
    left, right = siblings(F.col("hash"), window, F.col("pos"), F.col("n"), fanout)
    step = F.struct(left.alias("l"), right.alias("r"))
    rows = rows.withColumn("steps", F.filter(F.array(F.when(F.col("n") > 1, step)), F.isnotnull))
    if beyond is not None:
        parents = beyond.withColumnsRenamed({"pos": "__run", "steps": "__more"})
        rows = rows.join(parents, ["grp", "__run"]).withColumn("steps", F.concat("steps", "__more")).drop("__more")
    return rows.drop("__run")


def _descend(levels: list[DataFrame], beyond: DataFrame | None, fanout: int) -> DataFrame:
    """Level 0 with the steps from there up, ``beyond`` (as above, for the parents of the highest level) included."""
    for level in range(len(levels) - 1, 0, -1):
        handed = [c for c in (beyond.columns if beyond is not None else []) if c not in ("grp", "pos", "steps")]
        beyond = _with_steps(levels[level], beyond, fanout).select("grp", "pos", "steps", *handed)
        if (len(levels) - level) % STOREY == 0:
            beyond = stage(beyond)
    return _with_steps(levels[0], beyond, fanout)


def fold(hash_: Column, steps: Column) -> Column:
    """The root that a leaf's digest and the siblings along its path lead to."""
    return F.aggregate(steps, hash_, lambda h, s: digest(s["l"], h, s["r"]))


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    group: str = "source",
    order: str = "doc_id",
    fanout: int = FANOUT,
    tampered: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: its ``order`` column, ``group`` column, ``leaf``, ``subroot``, ``root``,
    ``steps`` (its siblings per level, from the leaf to the root) and ``claimed``.

    ``claimed`` is the leaf's digest with the columns that ``tampered`` names replaced by its expressions, such as the
    values of a copy under suspicion; without it, it is the leaf. ``fold(claimed, steps)`` is the root again only if
    nothing was changed. Null values have a digest of their own, apart from empty ones; a null group is a group, and
    stands first. Rows of one order value stand by digest; equal rows are leaves of their own, null order values first.
    A group of one row has its leaf as subroot, a single group has its subroot as root. Only ``columns`` are read, so
    others cannot clash; an empty table gives no rows and no root.
    """
    def changed(name: str) -> Column:
        return (tampered or {}).get(name, F.col(name))

    said = [F.col(order).alias("__order"), F.col(group).alias("__group")]
    # "" stands before every "+...", in whose order the bytes of the group decide.
    key = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))
    made = leaf([F.col(c) for c in columns])
    claim = leaf([changed(c) for c in columns]) if tampered else F.lit(None).cast("string")
    rows = docs.select(*said, key.alias("grp"), made.alias("hash"), claim.alias("claimed"), F.monotonically_increasing_id().alias("__row"))
    rows = rows.withColumn("claimed", F.nullif("claimed", "hash"))  # what was not changed takes no room
    leaves = number_in_groups(stage(rows), "grp", ["__order", "hash", "__row"])
    levels = climb(leaves, fanout)

    names = stage(levels[-1].select(F.lit("").alias("grp"), F.col("grp").alias("name"), "hash"))
    tops = climb(number_in_groups(names, "grp", ["name"]), fanout)
    top = tops[-1].select("hash").first()
    # A group's tree hangs under its leaf of the upper tree: position 0 of the level above the group's highest.
    ends = _descend(tops, None, fanout).select(F.col("name").alias("grp"), "steps", F.col("hash").alias("subroot"))
    ends = stage(ends.withColumn("pos", F.lit(0).cast("bigint")))
    found = _descend(levels, ends, fanout)
    return found.select(
        F.col("__order").alias(order),
        F.col("__group").alias(group),
        F.col("hash").alias("leaf"),
        "subroot",
        F.lit(top["hash"] if top else None).cast("string").alias("root"),
        "steps",
        F.coalesce("claimed", "hash").alias("claimed"),
    )


def audit(
    docs: DataFrame, tampered: dict[str, Column], columns: Sequence[str] = COLUMNS, group: str = "source", order: str = "doc_id"
) -> DataFrame:
    """The manifest's digests for every row, a digest of its proof, and whether the row as ``tampered`` has it still
    belongs to the dataset: ``folded_root`` is the root its digest leads to, ``verified`` whether that is the true one."""
    found = manifest(docs, columns, group, order, tampered=tampered)
    proof = F.sha2(F.array_join(F.transform("steps", lambda s: F.concat(s["l"], s["r"])), ""), 256)
    said = found.select(order, "leaf", "subroot", "root", proof.alias("proof_sha256"), fold(F.col("claimed"), F.col("steps")).alias("folded_root"))
    return said.withColumn("verified", F.col("folded_root") == F.col("root"))
