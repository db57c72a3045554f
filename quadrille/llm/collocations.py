"""Collocation mining by stripes: phrases whose parts meet far more often than chance would have it.

Every prefix of one to four words keys an associative counter of the words that follow it, its stripe. A task counts
the stripes of its batch, merging is adding counts elementwise, and a merged stripe gives all that is asked about its
prefix: its frequent extensions, their total, and the largest one, which says whether the prefix is subsumed.

Stripes grow level by level. A phrase can only be frequent if its words but the last and its words but the first are,
so a level counts only where both are; what passed the last level is handed on as a bitmap of a fixed size, whose false
hits cost time and change nothing, as counts are exact and the bound is applied to them. The stripe of a very frequent
prefix is dealt into parts by the following word, by powers of two of the prefix's count, so that no task merges more
than about ``PART`` occurrences at once. The counts that the parts need travel as a table of a fixed size too.

Texts are cut into words by whole-array operations on their bytes: separators are all ASCII, so bytes are enough. Once
the frequent pairs are known, only the runs of words that are all joined by such pairs are looked at: every occurrence of
a longer frequent phrase lies in one. A task's stripes travel in blocks, as many as the words ask for, so a merge holds
about ``BLOCK`` occurrences and rows are few.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_UPPER, stage

LEAST = 100
LONGEST = 5
TOP = 2000
#: A shorter phrase goes if a longer one that holds it has at least this percentage of its occurrences.
SUBSUMED = 100
UNKNOWN = "und"
#: Bytes that end a piece of text, and bytes between words.
BREAKS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"
#: Bits of the bitmap that tells which phrases are frequent (16 MB), and slots of the table of parts (1 MB).
MAP_BITS = 27
HEAT_BITS = 20
#: Occurrences of a prefix that one part of its stripe holds, about.
PART = 200_000
#: Occurrences whose stripes are merged together, about.
BLOCK = 1 << 20
#: Bytes of text that a task works on at once; a longer text is worked on alone.
BATCH_BYTES = 12 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_DIGIT = np.uint64(0xD6E8FEB86659FD93)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    lower, kind = np.arange(256, dtype=np.uint8), np.zeros(256, np.uint8)
    lower[np.frombuffer(ASCII_UPPER.encode(), np.uint8)] = np.frombuffer(ASCII_LOWER.encode(), np.uint8)
    kind[np.frombuffer(SPACES, np.uint8)] = 1
    kind[np.frombuffer(BREAKS, np.uint8)] = 2
    return lower, kind


_LOWER, _KIND = _tables()


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array without nulls."""
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def cut_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """The lower-cased words of all texts, each word's text, and its piece (a number that differs between pieces)."""
    offsets, data = _buffers(texts)
    kind = _KIND[data]
    inside = kind == 0
    edge = np.empty(len(data), bool)  # a word's first byte: before it stands a separator or another text
    if len(data):
        edge[0] = True
        edge[1:] = ~inside[:-1]
        begins = offsets[:-1]
        edge[begins[begins < len(data)]] = True
    edge &= inside
    starts = np.flatnonzero(edge)
    held = _LOWER[data[inside]]
    at = np.flatnonzero(edge[inside])
    ends = np.append(at, len(held)).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(held)))
    text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, offsets)))
    # Breaks so far plus the text's number grow with either, so neighbours of one piece, and only they, agree.
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts] + text
    return words.dictionary_encode(), text, piece


def word_hashes(words: pa.Array) -> np.ndarray:
    """64 bits for every word, the same in every task: its bytes as digits of a number."""
    offsets, data = _buffers(words)
    if not len(data):
        return np.zeros(len(words), np.uint64)
    sizes = np.diff(offsets)
    digits = np.cumprod(np.full(int(sizes.max()), _DIGIT), dtype=np.uint64)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    total = np.concatenate([[np.uint64(0)], np.cumsum((data + np.uint64(1)) * digits[place], dtype=np.uint64)])
    return _mixed(total[offsets[1:]] - total[offsets[:-1]])


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(32))) * _MIX
    return value ^ (value >> np.uint64(29))


def phrase_hashes(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """64 bits for every phrase of a language from the hashes of its words in order."""
    return reduce(lambda h, w: _mixed(h * _MIX + w), words, _mixed(lang))


def _split_phrases(phrases: pa.Array) -> list[np.ndarray]:
    """Word hashes by place of phrases of equally many words."""
    words = pc.split_pattern(phrases, " ").flatten()
    coded = words.dictionary_encode()
    hashes = word_hashes(coded.dictionary)[coded.indices.to_numpy()]
    each = len(hashes) // max(1, len(phrases))
    return [hashes[i::each] for i in range(each)]


class Known:
    """What a level knows of the one before: a bitmap of frequent phrases and the parts of their stripes."""

    def __init__(self, bits: bytes, heat: bytes):
        self.bits, self.heat = bits, heat

    def frequent(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - MAP_BITS)
        return (np.frombuffer(self.bits, np.uint8)[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def parts(self, hashes: np.ndarray) -> np.ndarray:
        """Parts of a phrase's stripe; phrases that share a slot of the table share the larger number."""
        return np.left_shift(1, np.frombuffer(self.heat, np.uint8)[hashes & np.uint64((1 << HEAT_BITS) - 1)].astype(np.int64))


def learn(frequent: DataFrame, part: int = PART) -> Known:
    """``Known`` of a table (``lang``, ``phrase``, ``f``): its size is fixed whatever the table holds."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            hashes = phrase_hashes(word_hashes(langs.dictionary)[langs.indices.to_numpy()], _split_phrases(batch.column(1)))
            f = batch.column(2).to_numpy()
            power = np.ceil(np.log2(np.maximum(f / part, 1))).astype(np.int32)
            columns = [pa.array((hashes >> np.uint64(64 - MAP_BITS)).astype(np.int64)), pa.array((hashes & np.uint64((1 << HEAT_BITS) - 1)).astype(np.int64)), pa.array(power)]
            yield pa.RecordBatch.from_arrays(columns, names=["bit", "slot", "power"])

    placed = stage(frequent.select("lang", "phrase", "f").mapInArrow(place, "bit bigint, slot bigint, power int"))
    # 64 bits in a number: 2 ** 21 rows at most, and 2 ** 20 slots.
    words = placed.select("bit").distinct().groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.expr("1L"), F.col("bit").bitwiseAND(63).cast("int"))).alias("mask")
    ).toPandas()
    masks = np.zeros(1 << (MAP_BITS - 6), "<i8")
    masks[words["word"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64)
    heat = np.zeros(1 << HEAT_BITS, np.uint8)
    hot = placed.where("power > 0").groupBy("slot").agg(F.max("power").alias("power")).toPandas()
    heat[hot["slot"].to_numpy(np.int64)] = hot["power"].to_numpy(np.int64)
    return Known(masks.tobytes(), heat.tobytes())


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch (``lang``, ``text``) of about ``BATCH_BYTES`` of text each, whole texts in each."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < batch.num_rows:
        base = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, base + BATCH_BYTES, side="right")))
        yield batch.slice(low, high - low)
        low = high


def _counted(keys: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of columns of small non-negative integers, in order, and how often each occurs."""
    packed, sizes, folded = np.zeros(len(keys[0]), np.int64), [], []
    room = 1
    for key in keys:
        size = int(key.max()) + 1 if len(key) else 1
        if room * size >= 1 << 62:  # ranks of what is packed so far take its place
            ranks, packed = np.unique(packed, return_inverse=True)
            folded.append((ranks, sizes))
            room, sizes = len(ranks), []
        packed = packed * size + key
        room, sizes = room * size, [*sizes, size]
    packed.sort()
    new = np.ones(len(packed), bool)
    new[1:] = packed[1:] != packed[:-1]
    at = np.flatnonzero(new)
    counts, left, columns = np.diff(np.append(at, len(packed))), packed[at], []
    while True:
        for size in reversed(sizes):
            columns.append(left % size)
            left = left // size
        if not folded:
            return columns[::-1], counts
        ranks, sizes = folded.pop()
        left = ranks[left]


_COUNTS = "lang string, word string, f bigint"
#: A block of stripes: prefixes, one a line; the entries of each; all their words; how often each word follows.
_STRIPES = "lang string, block bigint, prefixes string, sizes binary, words string, counts binary"
_FREQUENT = "lang string, prefix string, word string, f bigint"


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words by language: the stripes of the empty prefix, of which a task returns each entry as a row."""
    for whole in batches:
        for batch in _slices(whole):
            langs = batch.column(0).dictionary_encode()
            words, text, _ = cut_words(batch.column(1))
            (lang, word), n = _counted([langs.indices.to_numpy()[text], words.indices.to_numpy()])
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(lang)), words.dictionary.take(pa.array(word)).cast(pa.string()), pa.array(n)], names=["lang", "word", "f"]
            )


def _joined(ends: np.ndarray, texts: pa.Array, by: str) -> pa.Array:
    """One text for every list of texts; the lists begin at ``ends`` but for the last, which is where all end."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), texts.cast(pa.string())), by)


def _packed(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    """One binary for every list of numbers."""
    offsets = pa.py_buffer((ends * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, offsets, pa.py_buffer(values)])


def _starts(columns: list[np.ndarray]) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


class _Words:
    """The words of a part of a batch as codes, with hashes, languages and pieces."""

    def __init__(self, batch: pa.RecordBatch):
        langs = batch.column(0).dictionary_encode()
        words, self.text, self.piece = cut_words(batch.column(1))
        self.langs, self.words = langs.dictionary, words.dictionary
        self.codes, self.lang = words.indices.to_numpy(), langs.indices.to_numpy()[self.text]
        self.hashes = word_hashes(self.words)
        self.of_lang = word_hashes(self.langs)

    def phrases(self, m: int) -> np.ndarray:
        """Hashes of the ``m`` words from every place that has so many behind it."""
        n = len(self.codes) - m + 1
        return phrase_hashes(self.of_lang[self.lang[:n]], [self.hashes[self.codes[i : n + i]] for i in range(m)])


def _stripes(level: int, known: Known, blocks: int):
    """Counts the stripes of prefixes of ``level - 1`` words, of what may be frequent, in every part of a batch."""
    m = level - 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in _slices(whole)):
            cut = _Words(batch)
            n = len(cut.codes) - m
            if n <= 0:
                continue
            shorter = cut.phrases(m)
            often = known.frequent(shorter)
            at = np.flatnonzero((cut.piece[:n] == cut.piece[m:]) & often[:-1] & often[1:])
            if not len(at):
                continue
            prefix, last = shorter[at], cut.codes[at + m]
            part = _mixed(cut.hashes[last]) % known.parts(prefix).astype(np.uint64)
            block = (_mixed(prefix + part * _MIX) % np.uint64(blocks)).astype(np.int64)
            keys, counts = _counted([cut.lang[at], block, *[cut.codes[at + i] for i in range(m)], last])
            stripe, row = _starts(keys[:-1]), _starts(keys[:2])
            text_of = [cut.words.take(pa.array(k[stripe])) for k in keys[2:-1]]
            prefixes = pc.binary_join_element_wise(*text_of, pa.scalar(" ", pa.large_string()))
            ends, by_stripe = np.append(row, len(counts)), np.append(np.searchsorted(stripe, row), len(stripe))
            columns = [
                cut.langs.take(pa.array(keys[0][row])),
                pa.array(keys[1][row]),
                _joined(by_stripe, prefixes, "\n"),
                _packed(by_stripe, np.diff(np.append(stripe, len(counts))).astype("<i4")),
                _joined(ends, cut.words.take(pa.array(keys[-1])), " "),
                _packed(ends, counts.astype("<i8")),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "block", "prefixes", "sizes", "words", "counts"])

    return count


def _merge(least: int):
    """Adds the equal stripes of a block elementwise; returns the entries that are frequent."""

    def numbers(column: pa.ChunkedArray, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), kind)

    def run(block: pa.Table) -> pa.Table:
        prefixes = pc.list_flatten(pc.split_pattern(block.column("prefixes"), "\n")).combine_chunks().dictionary_encode()
        words = pc.list_flatten(pc.split_pattern(block.column("words"), " ")).combine_chunks().dictionary_encode()
        prefix = np.repeat(prefixes.indices.to_numpy(), numbers(block.column("sizes"), "<i4")).astype(np.int64)
        key, n = prefix * len(words.dictionary) + words.indices.to_numpy(), numbers(block.column("counts"), "<i8")
        order = np.argsort(key, kind="stable")
        key = key[order]
        at = _starts([key])
        total = np.add.reduceat(n[order], at)
        keep = total >= least
        prefix, word = np.divmod(key[at][keep], len(words.dictionary))
        lang = pa.array([block.column("lang")[0].as_py()] * len(word), pa.string())
        return pa.table([lang, prefixes.dictionary.take(pa.array(prefix)), words.dictionary.take(pa.array(word)), pa.array(total[keep])], names=["lang", "prefix", "word", "f"])

    return run


def _runs(known: Known):
    """Texts cut down to the runs of three words and more that are joined by frequent pairs, one a line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in _slices(whole)):
            cut = _Words(batch)
            n = len(cut.codes)
            if n < 3:
                continue
            joined = np.zeros(n + 1, bool)  # whether a word is joined with the one before, in three words at least
            joined[1:n] = (cut.piece[:-1] == cut.piece[1:]) & known.frequent(cut.phrases(2))
            joined[1:n] &= joined[: n - 1] | joined[2:]
            kept = np.flatnonzero(joined[:-1] | joined[1:])
            between = pa.array(["\n", " "], pa.large_string()).take(pa.array(joined[kept].astype(np.int8)))
            tokens = pc.binary_join_element_wise(between, cut.words.take(pa.array(cut.codes[kept])), pa.scalar("", pa.large_string()))
            text = cut.text[kept]
            at = _starts([text]) if len(text) else text
            texts = _joined(np.append(at, len(text)), tokens, "")
            yield pa.RecordBatch.from_arrays([cut.langs.take(pa.array(cut.lang[kept[at]])), texts], names=["lang", "text"])

    return run


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, part: int = PART) -> tuple[list[DataFrame], DataFrame]:
    """Staged tables (``lang``, ``prefix``, ``word``, ``f``) of the phrases of 1, 2 ... words with at least ``least``
    occurrences, and all words per language (``lang``, ``n``). ``docs`` has ``lang`` (not null) and ``text`` (not null)."""
    texts = docs.select("lang", "text")
    counted = texts.mapInArrow(_word_counts, _COUNTS).groupBy("lang", "word").agg(F.sum("f").alias("f"))
    counted = counted.groupBy("lang", F.when(F.col("f") >= least, F.col("word")).alias("word")).agg(F.sum("f").alias("f"))
    counted = stage(counted)
    totals = stage(counted.groupBy("lang").agg(F.sum("f").alias("n")))
    levels = [counted.where("word is not null").select("lang", F.lit("").alias("prefix"), "word", "f")]
    blocks = 1 + (totals.agg(F.sum("n")).first()[0] or 0) // BLOCK
    for level in range(2, longest + 1):
        before = with_phrase(levels[-1])
        if not before.limit(1).count():
            break
        known = learn(before, part)
        if level == 3:
            texts = stage(texts.mapInArrow(_runs(known), "lang string, text string"))
        stripes = texts.mapInArrow(_stripes(level, known, blocks), _STRIPES)
        levels.append(stage(stripes.groupBy("lang", "block").applyInArrow(_merge(least), _FREQUENT)))
    return levels, totals


def with_phrase(frequent: DataFrame) -> DataFrame:
    phrase = F.when(F.col("prefix") == "", F.col("word")).otherwise(F.concat_ws(" ", "prefix", "word"))
    return frequent.select("lang", phrase.alias("phrase"), "f", "prefix", "word")


def _without_first(phrase: Column) -> Column:
    return F.regexp_replace(phrase, "^[^ ]* ", "")


def mine_phrases(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    subsumed: int = SUBSUMED,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """The ``top`` phrases of every language by score: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Phrases are two to ``longest`` neighbouring words of a piece of text (no punctuation or line end between them) that
    occur ``a >= least`` times in the language. Of the cuts into a first and a second part, which occur ``l`` and ``r``
    times, the one with the lowest ``floor(1000 * a * n / (l * r))`` counts, ``n`` being all words of the language; of
    equal ones the earliest. A phrase inside a longer one with at least ``subsumed`` percent of its occurrences is left
    out. By score, then by ``a``, then by phrase. Null texts are empty, a null language is ``und``; rows of documents
    repeated count again, and only the two columns are read. Without a frequent word there are no rows.
    """
    own = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    levels, totals = frequent_phrases(own, least, longest)
    named = [with_phrase(x) for x in levels]
    if len(named) == 1:
        named.append(named[0].limit(0))
    every = reduce(DataFrame.unionByName, named[:-1] if len(named) > 2 else named[:1]).select("lang", "phrase", "f")
    candidates = reduce(DataFrame.unionByName, named[1:])
    # The longest phrase around one has at most the occurrences of the one that is longer by a word, so those decide:
    # the largest entry of the phrase's own stripe, and the largest among the stripes of its extensions to the left.
    longer = reduce(DataFrame.unionByName, named[2:]) if len(named) > 2 else named[1].limit(0)
    around = longer.select("lang", F.col("prefix").alias("phrase"), "f").unionByName(
        longer.select("lang", _without_first(F.col("phrase")).alias("phrase"), "f")
    )
    around = around.groupBy("lang", "phrase").agg(F.max("f").alias("beyond"))
    kept = candidates.select("lang", "phrase", F.col("f").alias("a")).join(around, ["lang", "phrase"], "left")
    kept = kept.where(F.col("beyond").isNull() | (100 * F.col("beyond") < subsumed * F.col("a"))).drop("beyond")
    kept = stage(kept.join(totals, "lang"))

    words = F.split("phrase", " ")
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k"))
    cuts = cuts.withColumns({"__first": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "), "__rest": F.array_join(F.slice(words, F.col("k") + 1, F.size(words)), " ")})
    cuts = cuts.join(every.select("lang", F.col("phrase").alias("__first"), F.col("f").alias("l")), ["lang", "__first"])
    cuts = cuts.join(every.select("lang", F.col("phrase").alias("__rest"), F.col("f").alias("r")), ["lang", "__rest"])
    # 38 digits hold the products; the quotient fits 64 bits, as a is at most l and at most r.
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r", "n")}
    cuts = cuts.withColumns({"__over": wide["a"] * wide["n"] * F.lit(1000).cast("decimal(4,0)"), "__under": wide["l"] * wide["r"]})
    cuts = cuts.withColumn("score", F.expr("__over div __under"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    ranked = best.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = ranked.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
