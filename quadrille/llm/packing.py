"""Packing: best-fit decreasing into windows of a fixed number of tokens.

Documents are tokenised, ended by a separator and cut: an overlong document first gives full windows, each a
sequence of its own; its last piece and all shorter documents are packed by best fit, longest first. A segment
tree indexed by remaining capacity finds the tightest window that still takes a piece in a number of steps that
is the logarithm of the window size.

The pieces are dealt at random into groups of about ``group_pieces``, each packed by one task on numbers alone
(row, position, length). A group wastes at most what its few last windows leave open, so the padding is a fixed
share however many groups there are, and a group's memory is bounded whatever a document or source holds.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, fresh, stage, text_of

WINDOW = 1024
SEPARATOR = 0
GROUP_PIECES = 100_000


class CapacityTree:
    """Open windows by remaining capacity; finds the smallest capacity of at least a given size."""

    def __init__(self, window: int):
        self.leaves = 1
        while self.leaves < window + 1:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, which: int) -> None:
        self.open[capacity].append(which)
        node = self.leaves + capacity
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """The tightest window that holds ``size``, removed from the tree, with its capacity."""
        count, node = self.count, self.leaves + size
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not count[node]:
                    node += 1
        capacity = node - self.leaves
        which = self.open[capacity].pop()
        while node:
            count[node] -= 1
            node >>= 1
        return which, capacity


def best_fit(sizes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of every size (1..window), longest first, each into the tightest window."""
    where, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    tree, opened = CapacityTree(window), 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        found = tree.take(size)
        if found is None:
            which, capacity = opened, window
            opened += 1
        else:
            which, capacity = found
        where[i], offset[i] = which, window - capacity
        if capacity > size:
            tree.add(capacity - size, which)
    return where, offset


#: How the byte-level tokenizers split a text before they merge, and the characters whose classes that
#: needs and which all Unicode versions agree on. A text with any other character goes the slower way.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNUSUAL = r"[^\t\n\r -~\u00a1-\u017f\u2010-\u2027\u20ac]|<\|"


def byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """Merge ranks by bytes of a plain byte-level BPE file; None for any other kind of tokenizer.

    Such files write each byte as a character: printable ones as themselves, the others counted up from U+0100.
    """
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not spec.get("normalizer") and not model.get("dropout")
    plain = plain and not any(model.get(k) for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
    plain = plain and (before.get("type"), before.get("use_regex"), before.get("add_prefix_space")) == ("ByteLevel", True, False)
    vocab = model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [vocab.get("".join(p), -1) for p in pairs] if plain else []
    if not plain or made != sorted(made) or -1 in made:
        return None
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    special = {t["content"] for t in spec.get("added_tokens") or []}
    return {bytes(byte_of[c] for c in token): rank for token, rank in vocab.items() if token not in special}


class Encoder:
    """Token ids of whole texts by a tokenizer file, as little-endian 32-bit bytes.

    Byte-level BPE files are also read as ranks, which give the same ids several times faster; texts with unusual
    characters or the beginning of a special token, and all texts of other files, go through the tokenizer itself.
    """

    def __init__(self, path: str):
        import json
        import re

        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            ranks = byte_ranks(json.load(file))
        self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}) if ranks else None
        self.unusual = re.compile(UNUSUAL).search

    def encode(self, text: str) -> bytes:
        if self.fast is not None and not self.unusual(text):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per file and worker process."""
    return Encoder(path)


def narrowed(piece: bytes) -> bytes:
    """Ids as 16-bit numbers if all of them fit, else as they are."""
    ids = np.frombuffer(piece, "<u4")
    return ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else piece


def widened(ids: Column, length: Column) -> Column:
    """32-bit ids again; what was not narrowed has four bytes an id already."""
    wide = F.unhex(F.regexp_replace(F.hex(ids), "(....)", "$10000"))
    return F.when(F.octet_length(ids) == 2 * length, wide).otherwise(ids)


def cut_pieces(
    rows: DataFrame, tokenizer: str, window: int = WINDOW, separator: int = SEPARATOR, with_ids: bool = False
) -> DataFrame:
    """One row per piece of every (``__row``, ``doc_id``, ``text``): full windows, then the rest. ``ids`` are narrowed."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"`__row` bigint, doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
        + ", ids binary" * with_ids
    )
    end = np.asarray([separator], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(tokenizer)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                numbers, ids = part.column(0), part.column(1)
                origin, starts, lengths, sums, totals, raw = [], [], [], [], [], []
                for i, text in enumerate(part.column(2).to_pylist()):
                    data = made.encode(text) + end
                    total = len(data) // 4
                    for start in range(0, total, window):
                        piece = data[4 * start : 4 * (start + window)]
                        origin.append(i)
                        starts.append(start)
                        lengths.append(len(piece) // 4)
                        sums.append(zlib.crc32(piece))
                        totals.append(total)
                        if with_ids:
                            raw.append(narrowed(piece))
                columns = [numbers.take(pa.array(origin, pa.int64())), ids.take(pa.array(origin, pa.int64()))]
                columns += [pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)]
                columns += [pa.array(raw, pa.binary())] if with_ids else []
                names = ["__row", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

    return bounded_batches(rows.select("__row", "doc_id", "text")).mapInArrow(cut, schema)


def pack_pieces(pieces: DataFrame, window: int = WINDOW, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (staged, with ``__row``, ``start``, ``length``) with ``sequence_id`` and ``offset``.

    A full piece is a sequence of its own. The number of groups follows the counted pieces; a piece's group is a
    digest of its row number, so a rerun packs alike. The low bit of a sequence id tells the two kinds apart.
    """
    rest = pieces.where(F.col("length") < window)
    groups = max(1, -(-rest.count() // group_pieces))
    dealt = rest.select("__row", "length").withColumn("__group", F.pmod(F.xxhash64("__row"), F.lit(groups)))
    schema = "`__row` bigint, sequence_id bigint, offset bigint"

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("__row")
        where, offset = best_fit(group["length"].to_numpy(), window)
        number = (where * groups + int(group["__group"].iloc[0])) * 2
        return pd.DataFrame({"__row": group["__row"].to_numpy(), "sequence_id": number, "offset": offset})

    packed = dealt.groupBy("__group").applyInPandas(pack, schema)
    short = rest.join(packed, "__row")
    full = pieces.where(F.col("length") == window)
    full = full.withColumn("sequence_id", F.monotonically_increasing_id() * 2 + 1).withColumn("offset", F.lit(0).cast("bigint"))
    return short.select(*full.columns).unionByName(full)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    separator: int = SEPARATOR,
    group_pieces: int = GROUP_PIECES,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of every document: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id`` and ``offset`` in the sequence (and ``ids``, little-endian unsigned 32-bit, if asked for).

    ``tokenizer`` is the path of a tokenizer file that every executor has. A null or empty text is its separator
    alone. Every id lies in one piece; pieces of a sequence follow each other without a gap. Repeated rows are
    documents of their own. Other columns are not read, so their names cannot clash. An empty table gives no rows.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), F.col("doc_id"), text_of("text").alias("text"))
    pieces = stage(cut_pieces(rows, tokenizer, window, separator, with_ids))
    packed = pack_pieces(pieces, window, group_pieces).drop("__row")
    return packed.withColumn("ids", widened(F.col("ids"), F.col("length"))) if with_ids else packed


def sequences(packed: DataFrame, window: int = WINDOW, padding: int = SEPARATOR) -> DataFrame:
    """One row per sequence: ``sequence_id``, ``doc_ids``, ``used`` and ``ids``, padded to the window
    unless its length is a power of two. A group is at most one window of ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids", "length")))
    rows = packed.groupBy("sequence_id").agg(parts.alias(fresh(packed, "__parts")))
    held = F.col(fresh(packed, "__parts"))
    used = F.aggregate(held, F.lit(0).cast("bigint"), lambda n, p: n + p["length"])
    data = F.aggregate(held, F.lit(b""), lambda b, p: F.concat(b, p["ids"]))
    rows = rows.select("sequence_id", F.transform(held, lambda p: p["doc_id"]).alias("doc_ids"), used.alias("used"), data.alias("ids"))
    whole = (F.col("used") > 0) & (F.col("used").bitwiseAND(F.col("used") - 1) == 0)
    pad = F.unhex(F.repeat(F.hex(F.lit(padding.to_bytes(4, "little"))), (F.lit(window) - F.col("used")).cast("int")))
    return rows.withColumn("ids", F.when(whole, F.col("ids")).otherwise(F.concat("ids", pad)))
