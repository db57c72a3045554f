"""A training-data pipeline in five stages over ``documents``.

1. Language ID: documents without a letter, or that no language's filter knows well enough, go.
2. Line dedup: lines that copy an earlier line, but for an edit or two, go; a document that would lose all its lines
   stays whole for the next stage.
3. Near dedup: of documents with the same or nearly the same text, one stays.
4. Mixing: sources meet their target weights, whole passes first, then a fractional one.
5. Packing: the mix as pieces of sequences of 1024 tokens.

Each stage works on all that its predecessor kept, written as Parquet and read again. What a stage stages for itself is
read by its result until that is written; the next stage, which reads the written result, removes it when it begins.

Documents may have null values in any column, texts may be empty, very long or repeated, other columns may have any
name and are kept by all stages but the last; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm.common import fresh
from quadrille.llm.language_id import UNKNOWN, fit, predict
from quadrille.llm.line_dedup import drop_line_copies
from quadrille.llm.minhash import one_per_group
from quadrille.llm.mixing import mixed_documents
from quadrille.llm.packing import pack_documents
from quadrille.llm.queries import tokenizer_path
from quadrille.session import recorded, remove, stage

#: A document whose best language holds a smaller share of its n-grams is no text in a learned language.
LEAST_SCORE = 0.3
#: At a similarity of 0.8 a pair shares none of 24 bands once in 310,000 times, of the 16 that are laid out for 0.85, once in 4,600.
NEAR_BANDS = 24


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The working tables of an application's last stage.
_working: dict[str, list[str]] = {}


def _tidy(step: Stage) -> Stage:
    """``step``, which first removes the working tables of the stage before it, unless its input still reads one."""

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        session = docs.sparkSession
        application = session.sparkContext.applicationId
        before = _working.pop(application, [])
        read = docs.inputFiles()
        still = [p for p in before if any(p.rpartition("/")[2] in file for file in read)]
        remove(session, [p for p in before if p not in still])
        with recorded() as paths:
            result = step(spark, docs, sf_dir)
        _working[application] = still + paths
        return result

    return run_step


@_tidy
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language. Without any labelled text only those without a letter go."""
    model = fit(docs)
    if not model.languages:
        return docs.where(F.rlike(F.coalesce("text", F.lit("")), F.lit(r"\p{L}")))
    pred, score = fresh(docs, "__pred"), fresh(docs, "__score")
    judged = predict(docs, model, pred=pred, score=score)
    kept = judged.where((F.col(pred) != UNKNOWN) & (F.col(score) >= LEAST_SCORE))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


@_tidy
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without lines that copy an earlier one."""
    return drop_line_copies(docs)


@_tidy
def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, a similarity of 0.8 or more)."""
    return one_per_group(docs, threshold=80, bands=NEAR_BANDS)


@_tidy
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


@_tidy
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents of the mix, with their token ids, in sequences."""
    return pack_documents(docs, tokenizer_path(), with_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Language filters and token ids are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of a folder. A stage's written result is removed once the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), []
    for _, step in STAGES[:-1]:
        found = step(spark, docs, sf_dir)
        with recorded() as written:
            docs = stage(found)
        remove(spark, before)
        before = written
    return STAGES[-1][1](spark, docs, sf_dir)
