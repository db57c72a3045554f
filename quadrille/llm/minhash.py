"""Near-duplicate documents by SuperMinHash signatures, banding, verification on full sets and union-find.

SuperMinHash gives every shingle its own random permutation of the signature's slots and adds the step number to
its random value. Values of one signature are therefore correlated such that their estimate varies less than that
of independent hashes, and once every slot holds a value of an earlier step no later step can lower it: a document
of many shingles stops after one or two steps. All documents of a batch take their steps together.

Documents with equal shingle sets share one node, so a group of copies costs one row of a count. Nodes that share a
band are candidates. Where many share one, those with too few shingles that any other of a fitting size holds are left
out by a count; the rest are compared by pivots (``graph.linked_classes``), first by sketches that rule out what
cannot be linked, then on the full sets of shingles, without a pair for every two members of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, fresh, joined_small, number_rows, stage, text_of
from .graph import linked_classes
from .language_id import mix

WORDS = 5
THRESHOLD = 85
#: 16 bands of 4 rows: a pair at a similarity of 0.85 shares no band once in 140,000 times; at 0.8, once in 5,000.
BANDS, ROWS = 16, 4
CHUNK_WORDS = 150_000
SIZE_STEP = 1.02
SKETCH_BITS = 1024
#: Bands that more sets share are thinned by a count before sets are compared.
CROWD = 16

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)


class _WordHashes(dict):
    """Word -> 64-bit hash, of bounded size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(text: str, words: int, memo: _WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles. Fewer words than one shingle form a single one."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter((memo[w] for w in parts), np.uint64, len(parts))
    width = min(words, len(parts))
    count = len(parts) - width + 1
    out = np.full(count, np.uint64(width), np.uint64)
    for j in range(width):
        out = mix(out * _GOLD + hashed[j : j + count])
    return np.unique(out)


def signatures(elements: np.ndarray, owner: np.ndarray, documents: int, slots: int) -> np.ndarray:
    """SuperMinHash values, one row of ``slots`` per document: step number above, random value below."""
    best = np.full(documents * slots, np.iinfo(np.uint64).max, np.uint64)
    order = None
    for step in range(slots):
        drawn = mix(elements + np.uint64((step + 1) * int(_GOLD) % (1 << 64)))
        swap = (step + (((drawn & _LOW) * np.uint64(slots - step)) >> np.uint64(32))).astype(np.int64)
        value = (np.uint64(step) << np.uint64(32)) | (drawn >> np.uint64(32))
        if step:
            line = np.arange(len(elements))
            slot = order[line, swap].astype(np.int64)
            order[line, swap] = order[:, step]
            order[:, step] = slot
        else:
            slot = swap
        np.minimum.at(best, owner * slots + slot, value)
        # The next step's values are step + 1 at least: documents below that everywhere are done.
        open_ = best.reshape(documents, slots).max(axis=1) >= (np.uint64(step + 1) << np.uint64(32))
        left = open_[owner]
        if not left.any():
            break
        if step:
            order = order[left]
        else:
            order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (int(left.sum()), 1))
            line = np.arange(len(order))
            order[line, slot[left]] = 0
            order[:, 0] = slot[left]
        elements, owner = elements[left], owner[left]
    return best.reshape(documents, slots)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of every signature."""
    parts = signature.reshape(len(signature), bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]) * _GOLD
    for i in range(rows):
        out = mix(out + parts[:, :, i])
    return out


def _texts(batch: pa.RecordBatch, at: int, words: int, memo: _WordHashes) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Shingles of runs of rows whose texts are of bounded total length."""
    low, held, size = 0, [], 0
    for i, text in enumerate(batch.column(at).to_pylist()):
        held.append(shingle_hashes(text, words, memo))
        size += len(held[-1])
        if size > CHUNK_WORDS:
            yield low, held
            low, held, size = i + 1, [], 0
    if held:
        yield low, held


def sign(rows: DataFrame, words: int, bands: int, per_band: int) -> DataFrame:
    """``rows`` (``doc_id``, ``handle``, ``text``) as ``doc_id``, ``handle``, ``n_shingles``, ``set_key``, ``bands``."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, handle bigint, n_shingles bigint, set_key binary, bands array<bigint>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _WordHashes()
        for batch in batches:
            for low, held in _texts(batch, 2, words, memo):
                sizes = np.fromiter(map(len, held), np.int64, len(held))
                full = np.flatnonzero(sizes)
                keys: list[bytes | None] = [xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None for h in held]
                flat = np.zeros((0, bands), np.int64)
                if len(full):
                    owner = np.repeat(np.arange(len(full)), sizes[full])
                    signed = signatures(np.concatenate(held), owner, len(full), bands * per_band)
                    flat = band_keys(signed, bands, per_band).view(np.int64)
                ends = np.concatenate([[0], np.cumsum((sizes > 0) * bands)]).astype(np.int32)
                part = batch.slice(low, len(held))
                listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.reshape(-1), pa.int64()))
                columns = [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), listed]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "handle", "n_shingles", "set_key", "bands"])

    return bounded_batches(rows.select("doc_id", "handle", "text")).mapInArrow(work, schema)


def shingle_sets(rows: DataFrame, words: int) -> DataFrame:
    """``rows`` (``node``, ``set_key``, ``text``) as (``node``, ``shingles``, ``sketch``) where the text has that very set.

    The sketch has one bit per value of the shingles' lowest ten bits: a bit that another set's sketch lacks stands for
    a shingle that the other set lacks.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _WordHashes()
        for batch in batches:
            nodes, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for low, held in _texts(batch, 2, words, memo):
                same = [i for i, h in enumerate(held) if xxhash.xxh3_128_digest(h.tobytes()) == keys[low + i]]
                sets = [held[i] for i in same]
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
                bits = np.zeros((len(sets), SKETCH_BITS), bool)
                for row, held_ in zip(bits, sets):
                    row[(held_ % np.uint64(SKETCH_BITS)).astype(np.int64)] = True
                sketch = np.packbits(bits, axis=1).view(np.int64).reshape(-1)
                ends = np.arange(0, len(sketch) + 1, SKETCH_BITS // 64, dtype=np.int32)
                sketches = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sketch, pa.int64()))
                numbers = pa.array([nodes[low + i] for i in same], pa.int64())
                yield pa.RecordBatch.from_arrays([numbers, listed, sketches], names=["node", "shingles", "sketch"])

    schema = "node bigint, shingles array<bigint>, sketch array<bigint>"
    return bounded_batches(rows.select("node", "set_key", "text")).mapInArrow(work, schema)


def size_class(size: Column) -> Column:
    """Sets whose sizes differ by less than some two percent share a class."""
    return F.floor(F.log(size) / F.lit(math.log(SIZE_STEP))).cast("int")


def supported(sets: DataFrame, threshold: int) -> DataFrame:
    """The ``node`` of every set that may have a partner among ``sets``.

    Of two linked sets of sizes a and b, at least threshold / (100 + threshold) * (a + b) shingles are in both. A set
    with fewer shingles that any other set of a class holds has no partner there. This count per set and class, of
    keys only, leaves out what merely shares a passage or was rewritten too much, before any two sets are compared;
    it drops no link.
    """
    reach = math.ceil(math.log(100 / threshold) / math.log(SIZE_STEP)) + 1
    each = sets.select("node", F.size("shingles").alias("size"), size_class(F.size("shingles")).alias("class"), F.explode("shingles").alias("x"))
    holders = each.groupBy("x", "class").agg(F.count(F.lit(1)).alias("d"), F.min("size").alias("m"))
    # One entry per class that occurs: some fifty times the logarithm of the longest set, at most.
    holders = holders.groupBy("x").agg(F.collect_list(F.struct("class", "d", "m")).alias("held"), F.sum("d").alias("all"))

    def fits(h: Column) -> Column:
        return (F.abs(h["class"] - F.col("class")) <= reach) & ((h["d"] > 1) | (h["class"] != F.col("class")))

    # One row per shingle of a set that some other set of a fitting size holds, too.
    held = holders.where("all > 1").select(F.col("x").alias("y"), "held")
    met = each.join(held, (F.col("x") == F.col("y")) & F.exists("held", fits))
    met = met.select("node", "size", "class", F.explode(F.filter("held", fits)).alias("h"))
    shared = met.groupBy("node", "size", "class", F.col("h.class").alias("other")).agg(F.count(F.lit(1)).alias("n"), F.min("h.m").alias("m"))
    enough = shared.where((100 + threshold) * F.col("n") >= threshold * (F.col("size") + F.col("m")))
    return enough.select("node").distinct()


def handle_of(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, text)


def near_duplicates(
    docs: DataFrame, threshold: int = THRESHOLD, words: int = WORDS, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``, ``handle`` (a digest of id and text)
    and ``group`` (a number per component, which tells components apart that share a repeated id; null without words).

    A document's set holds its distinct shingles of ``words`` words (A-Z lower-cased); with fewer words, the whole
    sequence as one. Two documents are linked if 100 * intersection >= threshold * union. ``component_id`` is the
    smallest ``doc_id`` reachable (nulls are larger than any); a null or empty text, or one without words, is linked
    with nothing and keeps its own id. ``kept`` tells whether the id is the component's, so repeated rows of a kept
    id are all kept. Only ``doc_id`` and ``text`` are read. An empty table gives no rows.

    Sets are compared as 64-bit hashes of shingles, and equal sets recognised by 128 bits.
    """
    text = text_of("text")
    source = docs.select("doc_id", handle_of(F.col("doc_id"), text).alias("handle"), text.alias("text"))
    signed = stage(sign(source, words, bands, rows))
    full = signed.where("n_shingles > 0")
    # Bands follow from the set, so they can be grouped by; copies become one node.
    nodes = full.groupBy("set_key", "bands", F.col("n_shingles").alias("size")).agg(
        F.min("doc_id").alias("first_id"), F.min("handle").alias("handle")
    )
    nodes = number_rows(nodes, "node")
    spread = nodes.select("node", "size", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    members = stage(joined_small(spread, stage(shared.select("bucket")), ["bucket"]))
    # The sets of the nodes that meet others, read from the text again: all others never leave the scan.
    wanted = members.select("node").distinct().join(nodes.select("node", "set_key", "handle"), "node")
    wanted = stage(wanted)
    sets = joined_small(source.select("handle", "text"), wanted, ["handle"])
    sets = stage(shingle_sets(sets, words).dropDuplicates(["node"]))
    sized = sets.select("node", F.struct(F.size("shingles").alias("n"), "sketch").alias("size"))
    counted = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("crowd"))
    members = members.select("bucket", "node").join(counted, "bucket")
    # Who shares bands with most comes first: the text that others were copied from connects them all.
    weight = members.groupBy("node").agg(F.struct((-F.sum("crowd")).alias("w"), "node").alias("place"))
    members = stage(members.join(weight, "node").join(sized, "node"))
    crowded = members.where(F.col("crowd") > CROWD)
    if crowded.limit(1).count():
        able = supported(sets.join(crowded.select("node").distinct(), "node", "left_semi"), threshold)
        able = crowded.join(able, "node", "left_semi").select(*members.columns)
        members = stage(members.where(F.col("crowd") <= CROWD).unionByName(able))

    def verify(pairs: DataFrame) -> DataFrame:
        asked = stage(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
        there = joined_small(sets.select("node", "shingles"), asked, ["node"])
        near = pairs.join(there.select(F.col("node").alias("a"), F.col("shingles").alias("xa")), "a")
        near = near.join(there.select(F.col("node").alias("b"), F.col("shingles").alias("xb")), "b")
        near = near.withColumn("both", F.size(F.array_intersect("xa", "xb")))
        return near.where(100 * F.col("both") >= threshold * (F.size("xa") + F.size("xb") - F.col("both")))

    def possible(a: Column, b: Column) -> Column:
        """By the sizes, and by the shingles of each that the other's sketch lacks."""
        needed = threshold * (a["n"] + b["n"])
        alike = 100 * F.least(a["n"], b["n"]) >= threshold * F.greatest(a["n"], b["n"])
        for one, other in ((a, b), (b, a)):
            lacking = F.lit(0)
            for i in range(SKETCH_BITS // 64):
                lacking = lacking + F.bit_count(F.get(one["sketch"], i).bitwiseAND(F.bitwise_not(F.get(other["sketch"], i))))
            alike = alike & ((100 + threshold) * (one["n"] - lacking) >= needed)
        return alike

    classes = linked_classes(members, verify, possible, order="place")
    if classes is None:
        labelled = nodes.select("set_key", "first_id", F.col("node").alias("label"))
    else:
        labelled = nodes.join(classes, "node", "left").select("set_key", "first_id", F.coalesce("label", "node").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    found = labelled.join(smallest, "label").select("set_key", "component_id", "label")
    out = signed.drop("bands").join(found, "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "handle",
        F.col("label").alias("group"),
    )


def one_per_group(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, without near duplicates: one document of each group stays.

    Documents without words are linked with nothing and all stay.
    """
    found = near_duplicates(docs, **options)
    full = found.where("kept and n_shingles > 0")
    handle, empty = fresh(docs, "__handle"), fresh(docs, "__empty")
    chosen = full.groupBy("group").agg(F.min("handle").alias(handle)).select(handle, F.lit(False).alias(empty))
    wordless = found.where("n_shingles = 0").select(F.col("handle").alias(handle), F.lit(True).alias(empty))
    chosen = stage(chosen.unionByName(wordless).distinct())
    kept = joined_small(docs.withColumn(handle, handle_of(F.col("doc_id"), text_of("text"))), chosen, [handle])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return kept.where(~F.col(empty)).dropDuplicates([handle]).select(*columns).unionByName(kept.where(empty).select(*columns))
