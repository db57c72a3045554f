"""Quality rules with risk-controlled thresholds.

A document's measures say how unlike good text it is; a rule rejects what is more unlike than a cutoff. Good labelled
documents are split by a digest of their id. A quarter gives each measure of a stratum (language) its scale: a value's
rank is the number of them below it, and a document's score is the largest of its ranks. On the others, which had no
part in the score, the cutoff is chosen so that at most a share ``risk`` of the stratum's good documents lies beyond it,
with the wanted confidence. The bound is exact: with n documents, k of them may lie beyond if a binomial variable of n
draws at that share is k or less with a probability of at most ``delta`` divided by the number of strata tested.

Strata are tested if they are large enough for any cutoff, which their size alone decides: the largest number j such
that j strata have (1 - risk) ** n <= delta / j. At a risk of 1 % and a confidence of 95 % one stratum needs 299 good
documents, four need 436 each. Smaller strata never reject.

Measures are rounded to a grid before they are compared or counted, so the holdout is summarised as counts per stratum
and value; those tables, not the documents, are what scales and cutoffs are read from.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import joined_small, stage

#: Fixed value: the symbols that are counted.
SYMBOLS = "#*$%&|<>"
#: Measures of which large values speak against a document: shares of its words or lines, on a grid of thousandths.
MEASURES = ("symbol_share", "repeat_share", "dup_line_share", "capital_share")
GRID = 1000
RISK = 0.01
DELTA = 0.05
LEAST_WORDS = 50
#: First digits of the id's digest of the documents that give the scale.
SCALE_DIGITS = "0123"
#: Strata whose scales (four arrays of ``GRID`` + 1 numbers each) may be broadcast: 8 MB.
BROADCAST_STRATA = 256
BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SPACES = bytes([0x20, *range(0x09, 0x0E)])
_NOT_SPACES = bytes(b for b in range(256) if b not in _SPACES)
_NOT_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS.encode())


def repeated_words(words: list[bytes]) -> int:
    """Words covered by windows of three that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, end = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + 3 - max(end, i)
            end = i + 3
    return covered


def measure(text: str) -> tuple[int, int, int, int, int, int, int]:
    """``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, lines with a word, capitals."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip(_SPACES)]
    spaces = len(data.translate(None, _NOT_SPACES))
    symbols = len(data.translate(None, _NOT_SYMBOLS))
    capitals = sum(1 for w in words if w.isupper())
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines), capitals


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with the base columns, ``n_lines`` and the measures in grid steps."""
    kept = [c for c in docs.columns if c != text]
    new = [*BASE_COLUMNS, "n_lines", *MEASURES]
    rows = docs.select(*kept, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    schema = docs.select(*kept, *[F.lit(0).cast("bigint").alias(n) for n in new]).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[int]] = [[] for _ in new]
            for one in batch.column(batch.num_columns - 1):
                n, chars, symbols, dup, repeat, lines, capitals = measure(one.as_py())
                values = [n, chars, symbols, dup, repeat, lines]
                values += [GRID * symbols // max(1, chars), GRID * repeat // max(1, n), GRID * dup // max(1, lines), GRID * capitals // max(1, n)]
                for column, value in zip(columns, values):
                    column.append(value)
            arrays = [*batch.columns[:-1], *[pa.array(c, pa.int64()) for c in columns]]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *new])

    return rows.mapInArrow(work, schema)


def most_rejected(n: int, risk: float, delta: float) -> int:
    """The largest k with P(Binomial(n, risk) <= k) <= delta, or -1 if there is none."""
    total, k = 0.0, -1
    while k < n:
        i = k + 1
        total += math.exp(
            math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(risk) + (n - i) * math.log1p(-risk)
        )
        if total > delta:
            break
        k = i
    return k


def _scales(good: DataFrame) -> DataFrame:
    """Per ``stratum``, an array ``scale_<measure>``: at v + 1, the documents whose measure is below v."""
    pair = [F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES]
    long = good.select("stratum", F.explode(F.array(*pair)).alias("p")).select("stratum", "p.*")
    counts = long.groupBy("stratum", "measure", "value").agg(F.count(F.lit(1)).alias("n"))
    grid = counts.select("stratum", "measure").distinct().select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(GRID).cast("bigint"))).alias("value"))
    # GRID + 1 rows a stratum and measure.
    lower = Window.partitionBy("stratum", "measure").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("below")
    rows = grid.join(counts, ["stratum", "measure", "value"], "left").select("stratum", "measure", "value", below)
    whole = F.transform(F.sort_array(F.collect_list(F.struct("value", "below"))), lambda x: x["below"])
    arrays = rows.groupBy("stratum", "measure").agg(whole.alias("scale"))
    return arrays.groupBy("stratum").agg(*[F.first(F.when(F.col("measure") == m, F.col("scale")), True).alias(f"scale_{m}") for m in MEASURES])


def _rank(measure_: str) -> Column:
    return F.element_at(F.col(f"scale_{measure_}"), F.col(measure_).cast("int") + 1)


def _scored(rows: DataFrame, scales: DataFrame) -> DataFrame:
    """``rows`` with ``score``, their largest rank; null in a stratum without a scale."""
    with_scale = joined_small(rows, scales, ["stratum"], "left", BROADCAST_STRATA)
    return with_scale.withColumn("score", F.greatest(*[_rank(m) for m in MEASURES]))


def strata_tested(sizes: DataFrame, risk: float, delta: float) -> int:
    """The largest j such that j strata (``n``) are large enough for a cutoff at a confidence of 1 - ``delta`` / j."""

    def enough(j: int) -> bool:
        return sizes.where(F.col("n") * math.log1p(-risk) <= math.log(delta / j)).count() >= j

    low, high = 0, sizes.count()
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if enough(middle) else (low, middle - 1)
    return low


def fit_cutoffs(good: DataFrame, scales: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """``stratum`` and ``cutoff`` of the strata that are large enough, from measured good documents that had no part in
    ``scales``. A document is rejected if its score is larger; with a confidence of 1 - ``delta``, all strata at once lose
    at most a share ``risk`` of their good documents."""
    counts = _scored(good, scales).where("score is not null").groupBy("stratum", "score").agg(F.count(F.lit(1)).alias("held"))
    # As many rows a stratum as its scales have steps, at most.
    down = Window.partitionBy("stratum").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns({"above": F.coalesce(F.sum("held").over(down), F.lit(0)), "n": F.sum("held").over(Window.partitionBy("stratum"))})
    counts = stage(counts)
    sizes = stage(counts.select("stratum", "n").distinct())
    tests = max(1, strata_tested(sizes, risk, delta))

    @F.pandas_udf("bigint")
    def most(n: pd.Series) -> pd.Series:
        return n.map(lambda x: most_rejected(int(x), risk, delta / tests))

    allowed = sizes.select("stratum", most("n").alias("most"))
    # The smallest score with no more good documents above it than allowed.
    return counts.join(allowed, "stratum").where("above <= most").groupBy("stratum").agg(F.min("score").alias("cutoff"))


def judge_quality(
    docs: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    risk: float = RISK,
    delta: float = DELTA,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """One row per document: ``doc_id``, the base columns, ``base_failed``, ``kept`` and ``reasons`` (the rules it failed).

    ``labels`` (``doc_id``, ``quality``) marks good documents with 1; those that fail the base rules are left out of the
    holdout, as the method never sees them. A null text has no words. A null stratum is a stratum of its own. A stratum
    without labelled good documents, or with too few for the bound, has no cutoff: its documents are kept unless the
    base rules fail. Repeated rows are judged each, those of a labelled id are labelled too. An empty table gives no
    rows, without labels only the base rules hold.
    """
    key = F.coalesce(F.concat(F.lit("+"), F.col(stratum).cast("string")), F.lit(""))
    rows = stage(measured(docs.select("doc_id", key.alias("stratum"), "text")))
    rows = rows.withColumn("base_failed", (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    marked = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    good = stage(rows.where(~F.col("base_failed")).join(marked, "doc_id", "left_semi").select("doc_id", "stratum", *MEASURES))
    scale_part = F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 1).isin(*SCALE_DIGITS)
    scales = stage(_scales(good.where(scale_part)))
    cutoffs = fit_cutoffs(good.where(~scale_part), scales, risk, delta)
    judged = _scored(rows, stage(scales.join(cutoffs, "stratum")))
    reasons = F.array_compact(F.array(*[F.when(_rank(m) > F.col("cutoff"), F.lit(m)) for m in MEASURES]))
    out = judged.withColumn("reasons", F.array_join(reasons, ","))
    return out.select(
        "doc_id", *BASE_COLUMNS, "base_failed", (~F.col("base_failed") & (F.col("reasons") == "")).alias("kept"), "reasons"
    )
