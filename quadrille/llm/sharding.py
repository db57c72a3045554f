"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size: it starts at an offset
and walks with a skip, both from a digest of its name. The shards take turns; at its turn a shard claims the
first slot of its order that is still free. The filled table gives shards almost equal numbers of slots,
and a shard that joins or leaves moves few slots beyond its own share.

Rows find their slot by a digest of their key. The table has a fixed, known size, is filled once (a walk
over its slots, independent of the data) and travels with the tasks as one constant, so placement is a lookup
in constant time without a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A prime well above a hundred times the number of shards keeps their shares within about one percent.
TABLE_SIZE = 65_537
#: The table is a broadcast constant: four bytes a slot, so 4 MB at most.
LARGEST_TABLE = 1 << 20


def _digest(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE, weights: Mapping[str, int] | None = None) -> list[int]:
    """Slot -> index of its shard. ``weights``: slots that a shard claims at each of its turns (1 if not given)."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names, one at least")
    if not _is_prime(size) or not len(shards) <= size <= LARGEST_TABLE:
        raise ValueError(f"the table size must be prime, from the number of shards up to {LARGEST_TABLE}")
    turns = [int((weights or {}).get(s, 1)) for s in shards]
    if min(turns) < 1:
        raise ValueError("a weight is a positive whole number")
    place = [_digest(f"offset:{s}") % size for s in shards]
    skip = [_digest(f"skip:{s}") % (size - 1) + 1 for s in shards]
    table = [-1] * size
    free = size
    while free:
        for i, claims in enumerate(turns):
            for _ in range(min(claims, free)):
                while table[place[i]] >= 0:
                    place[i] = (place[i] + skip[i]) % size
                table[place[i]] = i
                free -= 1
    return table


def slot_of(keys: Sequence[Column], size: int = TABLE_SIZE) -> Column:
    """The slot of a key: 60 bits of its md5, modulo the table. Parts are told apart, null from any text."""
    parts = [F.coalesce(F.concat(F.length(k.cast("string")).cast("string"), F.lit(":"), k.cast("string")), F.lit("-")) for k in keys]
    return F.pmod(F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast("bigint"), F.lit(size))


def assign_shards(
    df: DataFrame,
    keys: Sequence[str],
    shards: Sequence[str],
    size: int = TABLE_SIZE,
    weights: Mapping[str, int] | None = None,
    slot: str = "slot",
    shard: str = "shard",
) -> DataFrame:
    """``df`` with the slot and the shard name of every row.

    Rows with equal keys get the same shard; a null key is a key of its own and has one, too. Columns of ``df``
    called like the two new ones are replaced. No row is dropped or moved: there is no shuffle. An empty table
    stays empty. Bad shard lists raise before anything runs.
    """
    table = fill_table(shards, size, weights)
    lookup = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")
    names = F.array(*[F.lit(s) for s in shards])
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in {slot.lower(), shard.lower()}]
    placed = df.select(*kept, slot_of([F.col(f"`{k}`") for k in keys], size).alias(slot))
    return placed.withColumn(shard, F.get(names, F.get(lookup, F.col(slot).cast("int"))))


def write_shards(placed: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder per shard. Rows are dealt by shard and rebalanced by their bytes, so a large shard is written by as many
    tasks, into as many files, as it holds advisory partition sizes; small ones share a task. Null shard names go to
    Spark's folder for nulls, repeated rows are written each, an empty table leaves an empty folder."""
    placed.hint("rebalance", shard).write.partitionBy(shard).parquet(path)
