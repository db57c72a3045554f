"""Language identification with bit-sliced Bloom filters of character n-grams.

Every language has a Bloom filter of its typical n-grams. The filters are bit-sliced: one table of slots, each
slot a mask with one bit per language, so a lookup ANDs the few slots of an n-gram and returns all languages that
contain it at once. A text's hits are counted per language; the count is corrected for the share of lookups that
a filter of that fill answers by chance, and the largest corrected share decides.

Fitting reads a sample of labelled rows of about ``docs_per_language`` documents per language (a documented bound;
the sample is drawn by a digest of the text). Prediction reads every row and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import bounded_batches

GRAM = 4
HASHES = 4
SLOTS = 1 << 19
#: Documents per language that the fit reads, about; and n-grams that a language's filter holds, at most.
DOCS_PER_LANGUAGE = 3_000
GRAMS_PER_LANGUAGE = 30_000
#: An n-gram belongs to a language if this share of its documents holds it, and if that is no small part of
#: its share in the language where it is most common (foreign lines in a document are no evidence).
LEAST_SHARE = 0.004
RELATIVE_SHARE = 0.25
UNKNOWN = "und"
#: Texts are judged in runs of about so many characters; n-grams of the sample are counted in runs of about so many.
CHUNK_CHARS = 1 << 17
CHUNK_GRAMS = 1 << 21

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_letters: np.ndarray | None = None


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def text_grams(texts: list[str], gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all texts, the text each belongs to, and whether each text has a letter.

    Texts are lower-cased; every character that is no letter counts as a space. N-grams with two neighbouring
    spaces are left out, so only letters and single word ends count.
    """
    folded = [f" {t.lower()} " for t in texts]
    sizes = np.fromiter(map(len, folded), np.int64, len(folded))
    points = np.frombuffer("".join(folded).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[points]
    ends = np.cumsum(sizes)
    has_letter = np.add.reduceat(letter.astype(np.int32), ends - sizes) > 0 if len(sizes) else np.zeros(0, bool)
    if len(points) < gram:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), has_letter
    points = np.where(letter, points, np.uint32(32)).astype(np.uint64)
    count = len(points) - gram + 1
    hashed = np.zeros(count, np.uint64)
    good = np.ones(count, bool)
    for j in range(gram):
        hashed = (hashed ^ points[j : j + count]) * _MULTIPLY
        hashed ^= hashed >> np.uint64(29)
        if j:
            good &= letter[j - 1 : j - 1 + count] | letter[j : j + count]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    # A text ends and the next begins with a space, so an n-gram across both is left out, too.
    good &= owner[:count] == owner[gram - 1 :]
    return mix(hashed[good]), owner[:count][good], has_letter


@dataclass
class Model:
    """``table``: slot -> words of language bits; ``chance``: share of lookups that each filter answers by chance."""

    languages: list[str]
    table: np.ndarray
    chance: np.ndarray
    gram: int
    hashes: int

    def hits(self, grams: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.table) - 1)
        step = (grams >> np.uint64(32)) | np.uint64(1)
        found = self.table[(grams & mask).astype(np.int64)]
        for i in range(1, self.hashes):
            found = found & self.table[((grams + np.uint64(i) * step) & mask).astype(np.int64)]
        return found

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        grams, owner, has_letter = text_grams(texts, self.gram)
        total = np.bincount(owner, minlength=len(texts)).astype(float)
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        found = self.hits(grams)
        shares = np.zeros((len(texts), len(self.languages)))
        for i in range(len(self.languages)):
            bit = (found[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            count = np.bincount(owner, weights=bit, minlength=len(texts))
            share = count / np.maximum(total, 1)
            shares[:, i] = np.clip((share - self.chance[i]) / (1 - self.chance[i]), 0, 1)
        best = shares.argmax(axis=1)
        said = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, has_letter)]
        scores = np.where(has_letter, shares[np.arange(len(texts)), best], 0.0)
        return said, scores.tolist()


def build_model(
    languages: list[str], grams: dict[str, np.ndarray], gram: int = GRAM, slots: int = SLOTS, hashes: int = HASHES
) -> Model:
    """Bit-sliced filters of each language's n-gram hashes. ``languages`` come in the order that breaks ties."""
    if slots & (slots - 1):
        raise ValueError("slots must be a power of two")
    table = np.zeros((slots, -(-max(1, len(languages)) // 64)), np.uint64)
    chance = np.zeros(len(languages))
    mask = np.uint64(slots - 1)
    for i, language in enumerate(languages):
        held = grams.get(language, np.zeros(0, np.uint64))
        step = (held >> np.uint64(32)) | np.uint64(1)
        places = np.unique(np.concatenate([((held + np.uint64(j) * step) & mask) for j in range(hashes)]).astype(np.int64))
        table[places, i // 64] |= np.uint64(1) << np.uint64(i % 64)
        chance[i] = (len(places) / slots) ** hashes
    return Model(languages, table, chance, gram, hashes)


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    gram: int = GRAM,
    slots: int = SLOTS,
    hashes: int = HASHES,
    docs_per_language: int = DOCS_PER_LANGUAGE,
    grams_per_language: int = GRAMS_PER_LANGUAGE,
    least_share: float = LEAST_SHARE,
    relative_share: float = RELATIVE_SHARE,
) -> Model:
    """A model from the rows of ``labelled`` whose text and language are not null.

    Copies of a text in a language are one document: they neither fill the sample nor weigh in its shares.
    What reaches the driver is the list of languages and at most ``grams_per_language`` hashes of each.
    """
    spark = labelled.sparkSession
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.withColumns({"h1": F.xxhash64(F.lit(1), "text"), "h2": F.xxhash64(F.lit(2), "text")})
    distinct = rows.groupBy("lang", "h1", "h2").agg(F.lit(1).alias("x"))
    counts = {r["lang"]: r["n"] for r in distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts, key=lambda k: (-counts[k], k))
    if not languages:
        return build_model([], {}, gram, slots, hashes)
    share = F.create_map(*[F.lit(v) for k in languages for v in (k, min(1.0, docs_per_language / counts[k]))])
    drawn = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(drawn < F.element_at(share, F.col("lang")))
    sample = sample.groupBy("lang", "h1", "h2").agg(F.min("text").alias("text")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                hashes_, docs = np.unique(np.concatenate(parts), return_counts=True)
                # One row with a null hash says how many documents were read.
                names = pa.repeat(pa.scalar(name, pa.string()), len(hashes_) + 1)
                grams_ = pa.array(np.concatenate([[0], hashes_.view(np.int64)]), mask=np.arange(len(hashes_) + 1) == 0)
                numbers = pa.array(np.concatenate([[len(parts)], docs]), pa.int64())
                yield pa.RecordBatch.from_arrays([names, grams_, numbers], names=["lang", "gram", "docs"])

        for batch in batches:
            for name, one in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(name, []).append(np.unique(text_grams([one], gram)[0]))
                size += len(held[name][-1])
                if size >= CHUNK_GRAMS:
                    yield from counted()
                    held.clear()
                    size = 0
        yield from counted()

    spread = sample.repartition(max(1, spark.sparkContext.defaultParallelism))
    seen = bounded_batches(spread).mapInArrow(count, "lang string, gram bigint, docs bigint").groupBy("lang", "gram").agg(F.sum("docs").alias("docs"))
    read = {r["lang"]: r["docs"] for r in seen.where("gram is null").collect()}
    whole = F.create_map(*[F.lit(v) for k in languages for v in (k, float(max(1, read.get(k, 0))))])
    # Below the least share no gram is chosen, nor can it outweigh one that is: what is left is small.
    part = (F.col("docs") / F.element_at(whole, F.col("lang"))).alias("share")
    common = seen.where("gram is not null").select("lang", "gram", part).where(F.col("share") >= least_share)
    by_gram = common.groupBy("gram").agg(F.max("share").alias("most"))
    chosen = common.join(by_gram, "gram").where(F.col("share") >= relative_share * F.col("most"))
    best: dict[str, np.ndarray] = {}
    for name in languages:
        top = chosen.where(F.col("lang") == name).orderBy(F.desc("share"), "gram").limit(grams_per_language)
        best[name] = np.asarray([r["gram"] for r in top.select("gram").collect()], np.int64).view(np.uint64)
    return build_model(languages, best, gram, slots, hashes)


def _chunks(texts: list[str | None]) -> Iterator[list[str]]:
    """Lists of texts of bounded total length, so that arrays stay small whatever a batch holds."""
    chunk: list[str] = []
    size = 0
    for text in texts:
        chunk.append(text or "")
        size += len(chunk[-1])
        if size >= CHUNK_CHARS:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def predict(df: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred", score: str = "score", drop_text: bool = False) -> DataFrame:
    """``df`` with the predicted language and its score (0 to 1) of every row.

    ``und`` with score 0 where the text is null or has no letter. A text with letters but without an n-gram, or
    one that no filter knows, gets the most frequent language with score 0. Repeated rows are judged alike; columns
    of ``df`` called like the two new ones are replaced. An empty table stays empty.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c.lower() not in {pred.lower(), score.lower()} and (c != text or not drop_text)]
    # A text that is kept as it is travels once.
    at = kept.index(text) if text in kept and df.schema[text].dataType == StringType() else len(kept)
    apart = [F.col(f"`{text}`").cast("string").alias("__text")] * (at == len(kept))
    source = df.select(*[F.col(f"`{c}`") for c in kept], *apart)
    schema = df.select(*[F.col(f"`{c}`") for c in kept], F.lit(None).cast("string").alias(pred), F.lit(None).cast("double").alias(score)).schema

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            said: list[str] = []
            scores: list[float] = []
            for chunk in _chunks(batch.column(at).to_pylist()):
                languages, values = known.predict(chunk)
                said += languages
                scores += values
            columns = [*batch.columns[: len(kept)], pa.array(said, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, pred, score])

    return bounded_batches(source).mapInArrow(judge, schema)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``lang_pred``, ``score``.

    Learns from text and language of the documents that are not held out (nor without an id) alone.
    """
    rows = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = fit(rows.where(~F.col("held_out") & F.col("doc_id").isNotNull()), **options)
    return predict(rows.select("doc_id", "held_out", "text"), model, drop_text=True)
